"""Composite views V1, V4–V12 and the L22 refresh on hand-built domain tables."""

import json

import pytest
from pyspark.sql import functions as F

from fixtures import AS_OF, CONTEXT_SCHEMA, PARENT_SCHEMA, VALUE_SCHEMA, context_rows, rainfall, readings
from gaugework.functions import geo
from gaugework.plans import views
from gaugework.plans.refresh import refresh

GEOM = "geom array<array<array<struct<lon:double,lat:double>>>>"


def square(x0, y0, h):
    return [{"lon": float(x), "lat": float(y)} for x, y in
            [(x0 - h, y0 - h), (x0 + h, y0 - h), (x0 + h, y0 + h), (x0 - h, y0 + h), (x0 - h, y0 - h)]]


@pytest.fixture(scope="module")
def tables(spark):
    parents, values = readings()
    g, rp, rv = rainfall()
    return {
        "telemetry_context": spark.createDataFrame(context_rows(), CONTEXT_SCHEMA),
        "time_series_region_lkp": spark.createDataFrame([(1, "EA North East", "North East"), (8, "EA Wales", "Wales")],
                                                        "id int, region_name string, context_region_name string"),
        "sls_telemetry_value_parent": spark.createDataFrame(parents + rp, PARENT_SCHEMA),
        "sls_telemetry_value": spark.createDataFrame(values + rv, VALUE_SCHEMA),
        "sls_telemetry_station": spark.createDataFrame(g, "telemetry_station_id long, station_reference string, region string, "
                                                          "station_name string, ngr string, easting int, northing int"),
        "ffoi_station": spark.createDataFrame([(1, 1), (2, 2)], "ffoi_station_id long, rloi_id int"),
        "river": spark.createDataFrame([("tyne", "River Tyne", "River Tyne (NE)")], "id string, name string, qualified_name string"),
        "river_stations": spark.createDataFrame([("tyne", 1, 10), ("tyne", 2, 20), ("tyne", 3, 20), ("tyne", 99, 15),
                                                 ("tyne", 9, 40)], "river_id string, rloi_id int, rank int"),
    }


@pytest.fixture(scope="module")
def built(spark, tables):
    split = views.station_split(tables["telemetry_context"])
    overview = views.stations_overview(split, tables["sls_telemetry_value_parent"], tables["sls_telemetry_value"],
                                       tables["ffoi_station"], AS_OF)
    rain = views.rainfall_stations(tables["sls_telemetry_station"], tables["sls_telemetry_value_parent"],
                                   tables["sls_telemetry_value"])
    rivers = views.rivers(split, overview, tables["river_stations"], tables["river"], tables["telemetry_context"])
    return {"split": split, "overview": overview, "rain": rain, "rivers": rivers}


def test_station_context(tables):
    rows = views.station_context(tables["telemetry_context"], tables["time_series_region_lkp"]).collect()
    assert len(rows) == 9 and {r.time_series_region for r in rows} == {"EA North East", "EA Wales"}
    r = rows[0]
    assert json.loads(r.coordinates)["type"] == "Point" and 54.9 < r.lat < 55.1 and -1.7 < r.lon < -1.5


def test_rainfall_totals(built):
    rain = {r.station_reference: r for r in built["rain"].collect()}
    assert set(rain) == {"R1", "R2"}  # 'rainfall' (lower case) is not 'Rainfall'
    r1 = rain["R1"]
    assert r1.telemetry_value_parent_id == 1002 and r1.value == 1.0
    assert (r1.day_total, r1.six_hr_total, r1.one_hr_total) == (4.0, 3.0, 2.0)  # NaN ignored, strict lower bound
    assert r1.type == "R" and rain["R2"].day_total == 0.0


def test_rivers_view(built):
    rows = built["rivers"].collect()
    by = {}
    for r in rows:
        by.setdefault((r.rloi_id, r.qualifier), []).append(r)
    assert (7, "u") not in by and (8, "u") not in by  # Wales outside kept catchments, closed
    one = by[(1, "u")]
    assert {r.down for r in one} == {2, 3} and all(r.rank == 1 and r.view_rank == 1 for r in one)
    assert by[(2, "u")][0].rank == 2 and by[(9, "u")][0].rank == 4 and by[(9, "u")][0].up is None
    assert by[(4, "u")][0].river_id == "Sea Levels" and by[(5, "u")][0].river_id == "Groundwater Levels"
    assert by[(6, "u")][0].river_id == "Brook" and by[(6, "u")][0].view_rank == 4
    assert {r.qualifier for r in rows if r.rloi_id == 3} == {"u", "d"}
    ids = sorted(r.id for r in rows)
    assert ids == list(range(1, len(rows) + 1))
    first = min(rows, key=lambda r: r.id)
    assert first.view_rank == 1 and first.rank == 1


def test_stations_list(built):
    lst = views.stations_list(built["rivers"], built["rain"]).collect()
    rain = [r for r in lst if r.station_type == "R"]
    assert [(r.river_id, r.view_rank, r.trend, r.status) for r in rain] == [("rainfall-North East", 5, "n/a", "Active")]
    # UNION is distinct over the listed columns, which include up/down: every river row stays
    assert len(lst) == built["rivers"].count() + 1
    r1 = [r for r in lst if r.station_type == "R"][0]
    assert (r1.river_name, r1.telemetry_id, r1.agency_name, r1.value_erred, r1.day_total) == (
        "Rainfall North East", "R1", "Rain One", False, 4.0)
    assert sorted(r.id for r in lst) == list(range(1, len(lst) + 1))


def test_station_readings_json(spark, built, tables):
    out = {(r.rloi_id, r.direction): json.loads(r.json) for r in views.station_readings(
        built["split"], tables["sls_telemetry_value_parent"], tables["sls_telemetry_value"], AS_OF).collect()}
    one = out[(1, "u")]
    assert len(one) == 6 and one[0]["ts"] == "2023-02-06T14:00Z" and set(one[0]) == {"ts", "_", "err"}
    assert all(x["_"] != 9.9 for x in one)  # header older than five days
    assert len(out[(9, "u")]) == 4  # readings before the status date are hidden
    assert (3, "d") in out and (4, "d") not in out
    ep = views.station_readings(built["split"], tables["sls_telemetry_value_parent"], tables["sls_telemetry_value"],
                                AS_OF, ts_format="epoch").filter("rloi_id = 1").first()
    assert json.loads(ep.json)[0]["ts"] == 1675692000000
    lb = views.station_readings(built["split"], tables["sls_telemetry_value_parent"], tables["sls_telemetry_value"],
                                AS_OF, ts_format="label").filter("rloi_id = 1").first()
    labels = [x["label"] for x in json.loads(lb.json)]
    assert labels[0] == "" and labels[2] == "12:00pm"  # 14:00 GMT is not a 6-hour mark; 12:00 is


def test_readings_with_context(tables):
    out = {r.rloi_id: r for r in views.station_readings_with_context(
        tables["telemetry_context"], tables["sls_telemetry_value_parent"], tables["sls_telemetry_value"]).collect()}
    assert out[3].direction == "u" and out[4].direction == "u" and out[8].labels is not None
    labels = out[1].labels
    assert out[1].por_max_values[0] == 3.0 and len(out[1].processed_values) == 7  # context limits; all headers
    assert labels[0].endswith("am") or labels[0].endswith("pm")
    assert labels[0].count(" ") == 3 and labels[-1].count(" ") == 3  # first and last forced to the full form
    assert out[9].processed_values is not None and len(out[9].processed_values) == 4  # status date
    down = {r.rloi_id: r for r in views.station_readings_with_context(
        tables["telemetry_context"], tables["sls_telemetry_value_parent"], tables["sls_telemetry_value"], prefer="d").collect()}
    assert down[3].direction == "d" and down[3].por_max_values[0] == 3.5 and down[1].direction == "u"


def test_warnings_with_area_and_legacy(spark):
    fwis = spark.createDataFrame([(1, "AAA1 ", 3), (2, "WWW1", 2), (3, "NONE", 1)], "id long, ta_code string, severity_value int")
    alert = spark.createDataFrame([(10, "AAA1", [[square(0, 0, 1), square(0.5, 0, 0.25)]])], f"gid int, fws_tacode string, {GEOM}")
    warn = spark.createDataFrame([(20, "WWW1  ", [[square(5, 5, 1)]])], f"gid int, fws_tacode string, {GEOM}")
    out = {r.id: r for r in views.warnings_with_area(fwis, alert, warn).collect()}
    assert set(out) == {1, 2} and out[1].area_type == "a" and out[2].area_type == "w"
    assert abs(out[1].st_centroid.lon + 0.125 / 3.75) < 1e-12 and out[2].st_centroid.lon == 5.0
    cur = spark.createDataFrame([("AAA1", 7, "about", "r", "ar", "1", "Flood alert", 2, 5, "t1", "t2", "t3", "River high")],
                                "fwa_code string, fwa_key int, description string, region string, area string, tidal string, severity string, "
                                "severity_value int, warning_key int, time_raised string, severity_changed string, rim_changed string, rim string")
    dialled = [x.withColumn("qdial", F.lit("0345")) for x in (alert, warn)]
    leg = views.legacy_warnings(cur, *dialled)
    assert {"severity", "flood_type", "message"} <= set(leg.columns)
    row = leg.first()
    assert (row.fwa_code, row.fwa_key, row.description, row.area_floodline_quickdial_id, row.region, row.area, row.flood_type, row.severity_description,
            row.severity, row.warning_key, row.raised, row.severity_changed, row.message_changed, row.message) == (
        "AAA1", 7, "about", "0345", "r", "ar", "1", "Flood alert", 2, 5, "t1", "t2", "t3", "River high")
    assert len(row.geom) == 1 and abs(row.st_centroid.lon + 0.125 / 3.75) < 1e-12
    assert views.warnings_with_area(fwis.unionByName(fwis), alert, warn).count() == 2  # distinct, as the UNION


def test_impacts_serve_their_names_and_coordinates(spark):
    impact = spark.createDataFrame([(9, 1, 1.25, "short", "2000", "May", (-1.5, 52.25))],
                                   "id long, rloi_id int, value double, short_name string, obs_flood_year string, obs_flood_month string, geom struct<lon:double,lat:double>")
    ctx = spark.createDataFrame([(1, "River", "Place", "Active")], "rloi_id int, wiski_river_name string, agency_name string, status string")
    ov = spark.createDataFrame([(1, "u", 1.5, "T1", 3)], "rloi_id int, direction string, processed_value double, telemetry_id string, value_timestamp int")
    fm = spark.createDataFrame([("T1", 2.0)], "telemetry_id string, value double")
    row = views.impacts(impact, ctx, ov, fm, spark.createDataFrame([(1,)], "rloi_id int")).first()
    assert (row.shortname, row.obsfloodyear, row.obsfloodmonth, row.coordinates, row.gauge, row.telemetryactive, row.forecastactive) == (
        "short", "2000", "May", '{"type":"Point","coordinates":[-1.5,52.25]}', "River at Place", True, True)


def test_forecast_thresholds(spark):
    fs = spark.createDataFrame([(1, 100)], "ffoi_station_id long, rloi_id int")
    th = spark.createDataFrame([(1, "W1", 2.0), (1, "A1", 1.5), (1, "X9", 0.5)], "ffoi_station_id long, fwis_code string, value double")
    alert = spark.createDataFrame([(10, "A1", "Alert One")], "gid int, fws_tacode string, ta_name string")
    warn = spark.createDataFrame([(20, "W1", "Warning One")], "gid int, fws_tacode string, ta_name string")
    fwis = spark.createDataFrame([("W1", 2)], "ta_code string, severity_value int")
    r = views.forecast_thresholds(fs, th, alert, warn, fwis).first()
    items = json.loads(r.json)
    assert [(i["fwis_code"], i["fwa_type"], i["fwa_severity"]) for i in items] == [
        ("X9", "", -1), ("A1", "a", -1), ("W1", "w", 2)]
    assert items[1]["fwa_name"] == "Alert One" and items[0]["fwa_name"] is None


def test_station_areas_full_and_incremental(spark, tables):
    ctx = tables["telemetry_context"]
    p = geo.with_lonlat(ctx.filter("rloi_id = 1"), "x_coord_actual", "y_coord_actual").first()
    alert = spark.createDataFrame([("NEAR", [[square(p.lon, p.lat, 0.01)]]), ("FAR", [[square(-3.0, 52.0, 0.01)]])],
                                  f"fws_tacode string, {GEOM}")
    warn = spark.createDataFrame([("WNEAR", [[square(p.lon + 0.05, p.lat, 0.01)]])], f"fws_tacode string, {GEOM}")
    full = {(r.rloi_id, r.fws_tacode) for r in views.station_areas(ctx, alert, warn).collect()}
    assert (1, "NEAR") in full and (1, "WNEAR") in full and not any(a == "FAR" for _, a in full)
    done = spark.createDataFrame([(1,)], "rloi_id int")
    inc = {(r.rloi_id, r.fws_tacode) for r in views.station_areas_missing(ctx, done, alert, warn).collect()}
    assert not any(k == 1 or k == 7 for k, _ in inc)  # done and Welsh stations are skipped
    assert (2, "NEAR") in inc


def test_refresh_writes_views_in_order(spark, tables, tmp_dir):
    paths = refresh(spark, tables, tmp_dir, "v1", AS_OF)
    assert list(paths) == ["station_context", "station_split", "stations_overview", "rainfall_stations", "rivers",
                           "stations_list"]
    assert spark.read.parquet(paths["stations_list"]).count() > 0


def test_refresh_of_a_subset_reads_the_served_version(spark, tables, tmp_dir):
    import pytest

    from gaugework.plans.refresh import current
    context = {"telemetry_context": tables["telemetry_context"]}
    refresh(spark, context, tmp_dir, "v1", AS_OF, ["station_split"])
    with pytest.raises(ValueError):  # its view is not served and its tables are not given
        refresh(spark, context, tmp_dir, "v1", AS_OF, ["rivers"])
    with pytest.raises(ValueError):
        refresh(spark, tables, tmp_dir, "v1", AS_OF, ["no such view"])
    rest = {k: v for k, v in tables.items() if k != "telemetry_context"}
    paths = refresh(spark, rest, tmp_dir, "v2", AS_OF, ["stations_overview"])  # the split comes from v1
    assert list(paths) == ["stations_overview"] and current(spark, tmp_dir, "stations_overview").count() > 0
    bad = dict(context, telemetry_context=tables["telemetry_context"].drop("x_coord_actual"))
    with pytest.raises(Exception):
        refresh(spark, bad, tmp_dir, "v3", AS_OF, ["station_split"])
    assert current(spark, tmp_dir, "station_split").inputFiles()[0].count("/v1/") == 1


def test_impacts_without_readings_are_not_joined_by_a_null_key(spark):
    # gauge 1 has no reading: its impacts once went to the one task of the null telemetry_id
    impact = spark.createDataFrame([(1, 1, 2.0), (2, 1, 3.0), (3, 2, 2.0), (4, None, 2.0)], "id int, rloi_id int, value double")
    ctx = spark.createDataFrame([(1, "Active", "A", "x"), (2, "Active", "B", "y"), (2, "Active", "C", "z"), (None, "Active", "D", "w")],
                                "rloi_id int, status string, wiski_river_name string, agency_name string")
    ov = spark.createDataFrame([(2, "u", 10, 2.5, "t2"), (None, "u", 10, 9.0, None)],
                               "rloi_id int, direction string, value_timestamp int, processed_value double, telemetry_id string")
    fm = spark.createDataFrame([("t2", 1.0), ("t2", 4.0), (None, 5.0)], "telemetry_id string, value double")
    df = views.impacts(impact, ctx, ov, fm, spark.createDataFrame([(2,), (2,)], "rloi_id int"))
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().apply(0)
    assert "_cid" in plan.condition().get().toString() and "rloi_id" in plan.condition().get().toString()
    got = sorted((r.impactid, r.gauge, r.telemetrylatest, r.forecastmax, r.telemetryactive, r.forecastactive) for r in df.collect()
                 if r.impactid == 3)
    assert got == [(3, g, 2.5, f, True, f > 2) for g in ("B at y", "C at z") for f in (1.0, 4.0)]
    assert sorted((r.impactid, r.telemetrylatest, r.forecastmax) for r in df.collect() if r.impactid != 3) == [(1, None, None), (2, None, None)]


def test_equal_warnings_are_joined_once_and_repeated(spark, monkeypatch):
    from gaugework.operators import arrays
    monkeypatch.setattr(arrays, "REPEAT_BLOCK", 4)
    th = spark.createDataFrame([(1, "A", 1.0), (1, "A", 1.0), (2, "B", 2.0), (3, None, 3.0)], "rloi_id int, fwis_code string, value double")
    area = spark.createDataFrame([(7, "A", "alert a")], "gid int, fws_tacode string, ta_name string")
    fwis = spark.createDataFrame([("A", 2)] * 9 + [("A", 1)] * 4 + [("A", None), (None, 3)], "ta_code string, severity_value int")
    df = views.threshold_rows(th, area, area.limit(0), fwis)
    got = [(r.rloi_id, r.fwa_name, r.fwa_type, r.fwa_severity) for r in df.collect()]
    a = [(1, "alert a", "a", s) for s in [-1] + [1] * 4 + [2] * 9 for _ in range(2)]
    assert df.columns == ["rloi_id", "fwis_code", "value", "fwa_name", "fwa_type", "fwa_severity"]
    assert sorted(map(str, got)) == sorted(map(str, a + [(2, None, "", -1), (3, None, "", -1)]))
    assert "_n" in df._jdf.queryExecution().optimizedPlan().toString()  # the number of equal warnings, not the warnings


def test_thresholds_of_one_row_group_are_repeated_by_all_tasks(spark, tmp_dir):
    """One row group is one task, into however many splits its file is cut: what it becomes is made by all."""
    from gaugework.plans.q_views import q_threshold_lookup
    n, cut = 4000, "spark.sql.files.maxPartitionBytes"
    spark.range(n).selectExpr("id o_orderkey", "id % 50 o_custkey", "CAST(id AS double) o_totalprice").coalesce(1).write.parquet(f"{tmp_dir}/orders.parquet")
    spark.range(600).selectExpr("id s_suppkey", "CAST(id % 7 AS int) s_nationkey").write.parquet(f"{tmp_dir}/supplier.parquet")
    spark.range(50).selectExpr("id p_partkey", "concat('Brand#', CAST(id % 25 + 1 AS string)) p_brand").write.parquet(f"{tmp_dir}/part.parquet")
    spark.conf.set(cut, "1024")
    try:
        df = q_threshold_lookup(spark, tmp_dir)
        made = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset(cut)
    warnings = {f"Brand#{c + 1}": sum(1 for s in range(600) if s % 30 == c and s % 2) for c in range(30)}
    assert sum(made) == sum(max(warnings[f"Brand#{k % 28 + 1}"], 1) for k in range(n))
    assert max(made) * 4 < sum(made)
