"""V2/V3 on hand-built station context and readings (cases of SURVEY §5 / FIXTURES §2)."""

import datetime as dt

import pytest

from gaugework.plans.views import station_split, stations_overview

AS_OF = "2023-02-06 14:00:00"
T0 = dt.datetime(2023, 2, 6, 12, 0)

CTX_COLS = ("rloi_id int, telemetry_id string, wiski_id string, station_type string, agency_name string, "
            "area string, catchment string, status string, region string, x_coord_actual int, y_coord_actual int, "
            "por_max_value double, percentile_5 double, percentile_95 double, "
            "d_por_max_value double, d_percentile_5 double, d_percentile_95 double")


def ctx_row(rloi, stype, status="Active", por=5.0, p5=3.0, p95=0.1):
    return (rloi, f"T{rloi}", f"W{rloi}", stype, f"A{rloi}", "area", "catch", status, "North East", 400000, 300000,
            por, p5, p95, por + 1, p5 + 1, p95 + 1)


def series(rloi, qualifier, latest, previous, n_prev=4, parameter="Water Level", units="mAOD", start_id=0,
           error=False):
    """One header and readings: n_prev earlier readings at ``previous`` then the latest."""
    pid = rloi * 100 + start_id
    parent = (pid, rloi, parameter, units, qualifier)
    vals = []
    for i in range(n_prev):
        ts = T0 - dt.timedelta(minutes=15 * (n_prev - i))
        vals.append((pid * 100 + i, pid, previous, previous, ts, False))
    vals.append((pid * 100 + 99, pid, latest, latest, T0, error))
    return parent, vals


CASES = [
    # rloi, type, qualifier, latest, previous, expected trend
    (1001, "S", "Stage", 1.458, 1.556, "falling"),
    (1009, "S", "Stage", 0.066, 0.066, "steady"),
    (1046, "S", "Stage", 0.288, 0.276, "rising"),
    (9214, "C", "Tidal Level", 1.192, 1.215, "falling"),
    (3287, "S", "Stage", 0.312, 0.312, "steady"),
    (1006, "S", "Stage", 0.441, 0.44, "steady"),
    (7226, "S", "Stage", 0.18, 0.18, "steady"),
]


@pytest.fixture(scope="module")
def overview(spark):
    ctx = [ctx_row(r, t) for r, t, *_ in CASES] + [ctx_row(9137, "G"), ctx_row(2116, "M"),
                                                   ctx_row(9302, "S", status="Suspended"), ctx_row(5555, "S"),
                                                   ctx_row(5556, "C"), ctx_row(4444, "S", por=0.5)]
    parents, values = [], []
    for rloi, _, q, latest, prev, _ in CASES:
        p, v = series(rloi, q, latest, prev)
        parents.append(p)
        values += v
    # crest tapping rows with higher values must be ignored (7226)
    p, v = series(7226, "Crest Tapping", 9.0, 1.0, start_id=1)
    parents.append(p)
    values += v
    # groundwater single reading; suspended rising; multi-gauge both directions
    for args in [(9137, "Groundwater", 44.097, None, 0), (9302, "Stage", 78.8, 70.0, 4),
                 (2116, "Downstream Stage", -0.432, -0.431, 4), (2116, "Stage", 0.106, 0.106, 4)]:
        p, v = series(args[0], args[1], args[2], args[3], n_prev=args[4], start_id=len(parents))
        parents.append(p)
        values += v
    # dropped series: deg units, height qualifier, null qualifier
    for q, units in [("Stage", "deg C"), ("Stage Height", "m"), (None, "m")]:
        p, v = series(4444, q, 9.0, 9.0, start_id=len(parents), units=units)
        parents.append(p)
        values += v
    # breach on 4444 (por 0.5): a good reading above, and an error reading far above
    p, v = series(4444, "Stage", 0.7, 0.2, start_id=len(parents))
    parents.append(p)
    values += v
    # station 5556 coastal with no readings; 5555 two upstream qualifiers
    for q in ("Stage", "Stage 2"):
        p, v = series(5555, q, 1.0, 1.0, start_id=len(parents))
        parents.append(p)
        values += v
    ctx_df = spark.createDataFrame(ctx, CTX_COLS)
    par = spark.createDataFrame(parents, "telemetry_value_parent_id long, rloi_id int, parameter string, units string, qualifier string")
    val = spark.createDataFrame(values, "telemetry_value_id long, telemetry_value_parent_id long, value double, "
                                        "processed_value double, value_timestamp timestamp, error boolean")
    fs = spark.createDataFrame([(1001,), (1001,)], "rloi_id int")
    split = station_split(ctx_df)
    out = stations_overview(split, par, val, fs, AS_OF)
    return {(r.rloi_id, r.direction, r.qualifier): r for r in out.collect()}


@pytest.mark.parametrize("rloi,stype,q,latest,prev,expected", CASES)
def test_trend_cases(overview, rloi, stype, q, latest, prev, expected):
    assert overview[(rloi, "u", q)].trend == expected


def test_crest_tapping_ignored(overview):
    assert (7226, "u", "Crest Tapping") not in overview


def test_groundwater_single_reading_is_steady(overview):
    assert overview[(9137, "u", "Groundwater")].trend == "steady"


def test_multi_gauge_both_directions(overview):
    assert overview[(2116, "d", "Downstream Stage")].trend == "steady"
    assert overview[(2116, "d", "Downstream Stage")].processed_value == -0.432
    assert overview[(2116, "u", "Stage")].trend == "steady"


def test_suspended_station_kept(overview):
    assert overview[(9302, "u", "Stage")].trend == "rising"


def test_two_upstream_qualifiers_fan_out(overview):
    assert {k for k in overview if k[0] == 5555} == {(5555, "u", "Stage"), (5555, "u", "Stage 2")}


def test_station_without_readings_kept(overview):
    r = overview[(5556, "u", None)]
    assert r.trend is None and r.at_risk is False and r.level == ""


def test_dropped_series_and_breach(overview):
    rows = [v for k, v in overview.items() if k[0] == 4444]
    assert [r.qualifier for r in rows] == ["Stage"]
    assert rows[0].por_max_breached is True


def test_forecast_flag_no_fanout(overview):
    assert overview[(1001, "u", "Stage")].forecast is True
    assert overview[(1009, "u", "Stage")].forecast is False
    assert sum(1 for k in overview if k[0] == 1001) == 1


def test_level_and_risk(overview):
    r = overview[(9302, "u", "Stage")]  # 78.8 ≥ p5 3.0
    assert r.at_risk is True and r.level == "high"
    c = overview[(9214, "u", "Tidal Level")]
    assert c.level == ""


def test_age_seconds(overview):
    assert overview[(1001, "u", "Stage")].age_seconds == 7200.0
