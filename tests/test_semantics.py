"""SURVEY §2.11 items not covered elsewhere, each named."""

import datetime as dt

from pyspark.sql import functions as F

from gaugework.operators.ranking import trailing_mean
from gaugework.plans import views
from gaugework.sources.readings import clean_readings

T0 = dt.datetime(2023, 2, 6, 12, 0)


def test_item_2_no_readings(spark):
    """V9 (set-based JSON) has no row for a station without readings; V10 keeps the station
    with NULL arrays (left join from the context, like the reference's NULL array_agg)."""
    ctx = spark.createDataFrame([(1, "S", None, 1.0, 1.0, 1.0, 1.0), (2, "S", None, 1.0, 1.0, 1.0, 1.0)],
                                "rloi_id int, station_type string, status_date timestamp, por_max_value double, "
                                "d_por_max_value double, percentile_5 double, d_percentile_5 double")
    parents = spark.createDataFrame([(10, 1, "Water Level", "Stage", "m", T0 - dt.timedelta(hours=1))],
                                    "telemetry_value_parent_id long, rloi_id int, parameter string, qualifier string, "
                                    "units string, start_timestamp timestamp")
    values = spark.createDataFrame([(100, 10, 1.0, 1.0, T0, False)],
                                   "telemetry_value_id long, telemetry_value_parent_id long, value double, "
                                   "processed_value double, value_timestamp timestamp, error boolean")
    v10 = {r.rloi_id: r for r in views.station_readings_with_context(ctx, parents, values).collect()}
    assert v10[1].processed_values == [1.0] and v10[2].processed_values is None
    split = ctx.withColumn("qualifier", F.lit("u"))
    v9 = {r.rloi_id for r in views.station_readings(split, parents, values, "2023-02-06 14:00:00").collect()}
    assert v9 == {1}


def test_item_4_impacts_pick_latest_upstream(spark):
    impact = spark.createDataFrame([(1, 7, 1.0)], "id long, rloi_id int, value double")
    ctx = spark.createDataFrame([(7, "Active", "River", "Gauge")], "rloi_id int, status string, wiski_river_name string, agency_name string")
    overview = spark.createDataFrame(
        [(7, "u", "A", T0, 1, 0.5, "t7"), (7, "u", "B", T0 + dt.timedelta(minutes=15), 2, 1.5, "t7"),
         (7, "d", "C", T0 + dt.timedelta(hours=1), 3, 9.0, "t7")],
        "rloi_id int, direction string, qualifier string, ts timestamp, event_id int, processed_value double, telemetry_id string")
    fm = spark.createDataFrame([("t7", 2.0)], "telemetry_id string, value double")
    fs = spark.createDataFrame([(7,)], "rloi_id int")
    overview = overview.withColumnRenamed("ts", "value_timestamp").drop("event_id")
    r = views.impacts(impact, ctx, overview, fm, fs).first()
    # the downstream row is newer but never used; the newest upstream row wins
    assert (r.telemetrylatest, r.telemetryactive, r.forecastactive, r.gauge) == (1.5, True, True, "River at Gauge")


def test_item_6_equal_timestamps_break_on_id(spark):
    rows = [(1, "q", T0, 5, 9.0), (1, "q", T0, 4, 1.0)] + [(1, "q", T0 - dt.timedelta(minutes=i), 10 + i, 1.0)
                                                          for i in range(1, 4)]
    df = spark.createDataFrame(rows, "k int, q string, ts timestamp, id int, v double")
    r = trailing_mean(df, ["k", "q"], "ts", "id", "v").first()
    assert r.id == 5 and r.v == 9.0 and float(r.previous_value) == 1.0  # id 4 is the older of the tie


def test_item_11_null_station_type(spark):
    df = spark.createDataFrame([(-0.5, False, None, None), (-0.5, False, None, "C"), (0.5, False, None, None)],
                               "value double, post_process boolean, subtract double, station_type string")
    rows = [(r.processed_value, r.error) for r in clean_readings(df).collect()]
    # negative with NULL type: processed kept but error NULL (the NOT NULL check sets it aside)
    assert rows == [(-0.5, None), (-0.5, False), (0.5, False)]  # NULL AND false is false


def test_null_reading_is_never_at_risk_and_never_breaches(spark):
    from pyspark.sql import functions as F

    from gaugework.functions.levels import at_risk
    from gaugework.operators.windows import breaches
    df = spark.createDataFrame([(1, None, False, -0.5), (2, 0.0, False, -0.5)], "k int, v double, err boolean, lim double")
    got = {r.k: r.risk for r in df.select("k", at_risk("v", "err", "lim").alias("risk"), F.lit(1)).collect()}
    assert got == {1: False, 2: True}
    assert [r.k for r in breaches(df.select("k", "lim"), df.select("k", "v", "err"), ["k"], "lim", "v", "err").collect()] == [2]


def test_repeated_points_and_areas_keep_their_pair(spark):
    from gaugework.operators.proximity import within_distance
    from gaugework.operators.spatial import centroid
    square = [[(0.0, 50.0), (0.4, 50.0), (0.4, 50.4), (0.0, 50.4), (0.0, 50.0)]]
    geom = "array<array<array<struct<lon:double,lat:double>>>>"
    areas = spark.createDataFrame([("a", [square]), ("a", [square]), ("one", [[[(0.2, 50.2)]]])], f"area_id string, geom {geom}")
    points = spark.createDataFrame([(1, 0.2, 50.2), (1, 0.2, 50.2)], "id int, lon double, lat double")
    assert [(r.id, r.area_id) for r in within_distance(points, areas).collect()] == [(1, "a")]
    assert centroid(areas.filter("area_id = 'one'"), "geom").first()["centroid"] is None


def test_null_group_is_ranked(spark):
    from pyspark.sql import functions as F

    from gaugework.operators.ranking import group_rank
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5), (None, 3), ("b", 1)], "g string, r int")
    got = sorted((str(r.g), r.r, r.rank) for r in group_rank(df, "g", F.col("r").asc_nulls_last()).collect())
    assert got == [("None", 3, 1), ("None", 5, 2), ("a", 1, 1), ("a", 2, 2), ("b", 1, 1)]
