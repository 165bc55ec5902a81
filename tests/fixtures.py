"""Hand-built domain tables (FIXTURES.md §2–§7) shared by the view tests."""

import datetime as dt

AS_OF = "2023-02-06 14:00:00"
NOW = dt.datetime(2023, 2, 6, 14, 0)

CONTEXT_SCHEMA = ("telemetry_id string, wiski_id string, rloi_id int, station_type string, post_process boolean, "
                  "subtract double, region string, area string, catchment string, agency_name string, "
                  "external_name string, wiski_river_name string, x_coord_actual int, y_coord_actual int, "
                  "status string, status_date timestamp, por_max_value double, d_por_max_value double, "
                  "percentile_5 double, d_percentile_5 double, percentile_95 double, d_percentile_95 double")


def context_rows():
    def row(rloi, stype, region="North East", catchment="Tyne", status="Active", status_date=None, river="Tyne",
            x=425000, y=565000):
        return (f"T{rloi}", f"W{rloi}", rloi, stype, False, None, region, "Area", catchment, f"Agency {rloi}",
                f"Ext {rloi}", river, x, y, status, status_date, 3.0, 3.5, 2.0, 2.5, 0.5, 0.6)
    return [row(1, "S"), row(2, "S"), row(3, "M"), row(4, "C", river=None), row(5, "G", river=None),
            row(6, "S", river="Brook"), row(7, "S", region="Wales", catchment="Other"),
            row(8, "S", status="Closed"), row(9, "S", status_date=NOW - dt.timedelta(hours=3))]


PARENT_SCHEMA = ("telemetry_value_parent_id long, rloi_id int, station string, region string, parameter string, "
                 "qualifier string, units string, start_timestamp timestamp, end_timestamp timestamp, "
                 "data_type string, period string")
VALUE_SCHEMA = ("telemetry_value_id long, telemetry_value_parent_id long, value double, processed_value double, "
                "value_timestamp timestamp, error boolean")


def readings():
    parents, values = [], []
    pid = 0
    for rloi, q in [(1, "Stage"), (2, "Stage"), (3, "Stage"), (3, "Downstream Stage"), (4, "Tidal Level"),
                    (5, "Groundwater"), (6, "Stage"), (7, "Stage"), (8, "Stage"), (9, "Stage")]:
        pid += 1
        parents.append((pid, rloi, f"T{rloi}", "EA North East", "Water Level", q, "mAOD",
                        NOW - dt.timedelta(days=1), NOW, None, None))
        for i in range(6):
            ts = NOW - dt.timedelta(hours=5 - i)
            v = 1.0 + rloi / 10 + i * 0.01
            values.append((pid * 100 + i, pid, v, v, ts, False))
    # an old header (more than five days ago) whose readings must not be served
    pid += 1
    parents.append((pid, 1, "T1", "EA North East", "Water Level", "Stage", "mAOD", NOW - dt.timedelta(days=6),
                    NOW - dt.timedelta(days=6), None, None))
    values.append((pid * 100, pid, 9.9, 9.9, NOW - dt.timedelta(days=6), False))
    return parents, values


def rainfall():
    gauges = [(1, "R1", "North East", "Rain One", "NZ1", 425000, 565000),
              (2, "R2", "Wales", "Rain Two", "SN1", 250000, 250000),
              (3, "R3", "North East", "Rain Three", "NZ2", 426000, 566000)]
    parents = [(1001, None, "R1", "North East", "Rainfall", None, "mm", NOW - dt.timedelta(days=2), NOW - dt.timedelta(hours=1), "Total", "15 min"),
               (1002, None, "R1", "North East", "Rainfall", None, "mm", NOW - dt.timedelta(days=1), NOW, "Total", "15 min"),
               (1003, None, "R2", "Wales", "Rainfall", None, "mm", NOW - dt.timedelta(days=1), NOW, "Total", "15 min"),
               (1004, None, "R3", "North East", "rainfall", None, "mm", NOW - dt.timedelta(days=1), NOW, "Total", "15 min")]
    values = []
    # Readings across both headers; latest at NOW
    for i, hrs in enumerate([30, 20, 5.5, 0.5, 0]):
        pidv = 1001 if hrs > 10 else 1002
        values.append((50000 + i, pidv, 1.0, 1.0, NOW - dt.timedelta(hours=hrs), False))
    values.append((50100, 1002, float("nan"), float("nan"), NOW - dt.timedelta(hours=2), False))
    values.append((50200, 1003, 0.0, 0.0, NOW, False))
    values.append((50300, 1004, 5.0, 5.0, NOW, False))
    return gauges, parents, values
