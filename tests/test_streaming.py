"""T1 incremental file ingest (L6) and T3 latest-five state, including replay safety."""

import json
import os
import shutil

from pyspark.sql import functions as F

from gaugework.streaming.jobs import latest_state, stream_latest, stream_readings, update_latest
from test_ingest import context, lookup, reading_doc


def write_doc(folder, name, value, t):
    with open(os.path.join(folder, name), "w") as fh:
        json.dump(reading_doc("T1", "EA North East", [("Stage", [(value, "2023-02-06", t)])]), fh)


def test_reading_stream_processes_each_file_once(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    os.makedirs(src)
    write_doc(src, "a.json", "1.0", "10:00:00")
    write_doc(src, "b.json", "2.0", "10:15:00")
    stream_readings(spark, src, ck, out, context(spark), lookup(spark), max_files=1).awaitTermination()
    first = spark.read.parquet(f"{out}/values").count()
    assert first == 2  # two micro-batches of one file each
    write_doc(src, "c.json", "3.0", "10:30:00")
    stream_readings(spark, src, ck, out, context(spark), lookup(spark), max_files=1).awaitTermination()
    vals = sorted(r.value for r in spark.read.parquet(f"{out}/values").collect())
    assert vals == [1.0, 2.0, 3.0]  # a and b were not read again


def test_update_latest_keeps_top_k_and_is_idempotent(spark):
    rows = [(1, "q", i, i * 10, float(i)) for i in range(8)]
    df = spark.createDataFrame(rows, "k int, q string, id int, ts int, v double")
    s1 = update_latest(df.filter("id < 4"), None, ["k", "q"], "ts", "id", k=5)
    s2 = update_latest(df.filter("id >= 4"), s1, ["k", "q"], "ts", "id", k=5)
    assert sorted(r.id for r in s2.collect()) == [3, 4, 5, 6, 7]
    again = update_latest(df.filter("id >= 4"), s2, ["k", "q"], "ts", "id", k=5)  # replayed batch
    assert sorted(r.id for r in again.collect()) == [3, 4, 5, 6, 7]
    late = update_latest(spark.createDataFrame([(1, "q", 99, 5, 0.0)], "k int, q string, id int, ts int, v double"),
                         s2, ["k", "q"], "ts", "id", k=5)  # a late, old reading does not displace newer ones
    assert sorted(r.id for r in late.collect()) == [3, 4, 5, 6, 7]


def test_stream_latest_state_versions(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    df = spark.createDataFrame([(1, "q", i, i, float(i)) for i in range(12)], "k int, q string, id int, ts int, v double")
    df.filter("id < 6").write.parquet(f"{src}/p1")
    shutil.move(f"{src}/p1", f"{src}_stage1")
    os.makedirs(src, exist_ok=True)
    for f in os.listdir(f"{src}_stage1"):
        if f.endswith(".parquet"):
            shutil.copy(os.path.join(f"{src}_stage1", f), os.path.join(src, "a-" + f))
    stream = spark.readStream.schema(df.schema).parquet(src)
    root = os.path.join(tmp_dir, "state")
    stream_latest(spark, stream, f"{root}/ck", root, ["k", "q"], "ts", "id").awaitTermination()
    df.filter("id >= 6").coalesce(1).write.parquet(f"{src}_stage2")
    for f in os.listdir(f"{src}_stage2"):
        if f.endswith(".parquet"):
            shutil.copy(os.path.join(f"{src}_stage2", f), os.path.join(src, "b-" + f))
    stream_latest(spark, spark.readStream.schema(df.schema).parquet(src), f"{root}/ck", root,
                  ["k", "q"], "ts", "id").awaitTermination()
    st = latest_state(spark, root, f"{root}/ck")
    assert sorted(r.id for r in st.collect()) == [7, 8, 9, 10, 11]
    assert st.agg(F.count("*")).first()[0] == 5


def test_stream_output_is_date_partitioned_and_pruned(spark, tmp_dir):
    import contextlib
    import io

    from gaugework.plans import views
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    os.makedirs(src)
    write_doc(src, "a.json", "1.0", "10:00:00")
    stream_readings(spark, src, ck, out, context(spark), lookup(spark)).awaitTermination()
    parents = spark.read.parquet(f"{out}/parents")
    assert "start_date" in parents.columns
    split = spark.createDataFrame([(1, "u", None)], "rloi_id int, qualifier string, status_date timestamp")
    df = views.station_readings(split, parents, spark.read.parquet(f"{out}/values"), "2023-02-07 00:00:00")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    assert "PartitionFilters: [isnotnull(start_date" in buf.getvalue()
    assert df.count() == 1
