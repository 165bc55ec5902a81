"""Hot keys (one key holding a third of the rows) against brute force, and the sinks:
L18 threshold CSV, L19 snapshot/restore, T2 forecast stream."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from gaugework.operators.ranking import latest_per_key, top_k_per_key
from gaugework.operators.skew import salted_join
from gaugework.operators.tables import cleared, restore, snapshot
from gaugework.operators.windows import breaches, trailing_totals
from gaugework.sources.thresholds import CSV_COLUMNS, write_thresholds
from gaugework.streaming.jobs import stream_forecasts


def hot_rows(n=3000, seed=3):
    rnd = random.Random(seed)
    t0 = dt.datetime(2023, 2, 6)
    rows = []
    for i in range(n):
        k = 0 if i % 3 == 0 else rnd.randint(1, 60)  # key 0 holds a third of all rows
        rows.append((k, i, t0 + dt.timedelta(minutes=rnd.randint(0, 4000)), round(rnd.uniform(0, 10), 2)))
    return rows


def test_hot_key_latest_topk_totals(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k int, id int, ts timestamp, v double").repartition(7)
    latest = {r.k: r.id for r in latest_per_key(df, "k", "ts", "id").collect()}
    top = {}
    for r in top_k_per_key(df, "k", "ts", "id", k=5).collect():
        top.setdefault(r.k, set()).add(r.id)
    tot = {r.k: r for r in trailing_totals(df, "k", "ts", "v").collect()}
    for k in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == k], key=lambda r: (r[2], r[1]), reverse=True)
        assert latest[k] == mine[0][1]
        assert top[k] == {r[1] for r in mine[:5]}
        last = mine[0][2]
        day = sum(r[3] for r in mine if r[2] > last - dt.timedelta(hours=24))
        one = [r[3] for r in mine if r[2] > last - dt.timedelta(hours=1)]
        assert abs(tot[k].day_total - day) < 1e-6
        assert abs((tot[k].one_hr_total or 0) - sum(one)) < 1e-6


def test_salted_join_keeps_every_row_once(spark):
    big = spark.createDataFrame([(0 if i % 3 == 0 else i % 40, i) for i in range(3000)], "k int, id int")
    per_key = spark.createDataFrame([(k, k * 10) for k in range(40)], "k int, stat int")
    out = salted_join(big, per_key, ["k"], buckets=8)
    assert out.count() == 3000 and out.select("id").distinct().count() == 3000
    assert out.filter(F.col("stat") != F.col("k") * 10).count() == 0


def test_breach_on_hot_key(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k int, id int, ts timestamp, v double")
    lim = spark.createDataFrame([(k, 9.9) for k in range(61)], "k int, lim double")
    got = {r.k for r in breaches(lim, df, ["k"], "lim", "v").collect()}
    assert got == {r[0] for r in rows if r[3] > 9.9}


def test_threshold_csv_sink(spark, tmp_dir):
    df = spark.createDataFrame([(2116, "033WAF309", "A", "d", 1.3, "FW RES FAL")],
                               "station_id long, fwis_code string, fwis_type string, direction string, value double, "
                               "threshold_type string")
    path = os.path.join(tmp_dir, "thresholds")
    write_thresholds(df, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == CSV_COLUMNS and back.first().fwis_code == "033WAF309"


def test_snapshot_restore_appends(spark, tmp_dir):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    paths = snapshot({"telemetry_context": t}, tmp_dir, "2023-02-06")
    live = {"telemetry_context": spark.createDataFrame([(3, "c")], "id int, v string")}
    appended = restore(spark, paths, live)["telemetry_context"]
    assert sorted(r.id for r in appended.collect()) == [1, 2, 3]  # the reference's restore appends
    replaced = restore(spark, paths, live, append=False)["telemetry_context"]
    assert sorted(r.id for r in replaced.collect()) == [1, 2]
    assert cleared(t).count() == 0 and cleared(t).columns == t.columns


def test_forecast_stream(spark, tmp_dir):
    from test_ingest import FORECAST
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    os.makedirs(src)
    with open(os.path.join(src, "ffoi-1.xml"), "w") as fh:
        fh.write(FORECAST)
    ctx = spark.createDataFrame([("W1", 11)], "wiski_id string, rloi_id int")
    stream_forecasts(spark, src, ck, out, ctx).awaitTermination()
    rows = spark.read.parquet(f"{out}/forecasts").collect()
    assert [(r.station_reference, r.rloi_id) for r in rows] == [("W1", 11)]


def test_group_rank_matches_window_rank_on_a_hot_group(spark):
    from pyspark.sql import Window

    from gaugework.operators.ranking import group_rank
    rnd = random.Random(11)
    rows = [(0 if i % 3 == 0 else rnd.randint(1, 30), rnd.choice([None] + list(range(0, 400))), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "g int, r int, id int").repartition(5)
    mine = {x.id: x.rank for x in group_rank(df, "g", F.col("r").asc_nulls_last()).collect()}
    plain = {x.id: x.rank for x in group_rank(df, "g", F.col("r").asc_nulls_last()).collect()}
    assert mine == plain
    ref = {x.id: x.rk for x in df.withColumn("rk", F.rank().over(
        Window.partitionBy("g").orderBy(F.col("r").asc_nulls_last()))).collect()}
    assert mine == ref
