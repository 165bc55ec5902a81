"""W5/J5 neighbours with ties and gaps, F8 labels, W7 ids, S2 union, table maintenance."""

from pyspark.sql import functions as F

from gaugework.functions.predicates import anti, in_scope, is_wales, river_labels
from gaugework.operators.ranking import latest_per_key, rank_neighbours, top_k_per_key, with_ordered_id
from gaugework.operators.sets import split_directions, union_shapes
from gaugework.operators.tables import (apply_changes, cascade_delete, check_columns, check_unique, retain,
                                        shift_to_now, sync_table)


def test_rank_neighbours_ties_and_gaps(spark):
    rs = spark.createDataFrame([("r1", 1, 10), ("r1", 2, 20), ("r1", 3, 20), ("r1", 4, 40), ("r2", 7, 5),
                                ("r1", 5, None)], "river_id string, rloi_id int, rank int")
    out = {(r.river_id, r.rloi_id): r for r in rank_neighbours(rs, "river_id", "rank", "rloi_id").collect()}
    assert out[("r1", 1)].calc_rank == 1 and out[("r1", 1)].up_rloi_id is None
    # two stations tie at position 2, next is 4: station 1 has two downstream neighbours
    downs = [r.down_rloi_id for r in rank_neighbours(rs, "river_id", "rank", "rloi_id").collect()
             if r.rloi_id == 1]
    assert sorted(downs) == [2, 3]
    assert out[("r1", 4)].calc_rank == 4 and out[("r1", 4)].up_rloi_id is None  # gap: no position 3
    assert out[("r1", 5)].calc_rank == 5  # NULL rank sorts last (Postgres ASC)
    assert out[("r2", 7)].calc_rank == 1


def test_river_labels_ladder(spark):
    df = spark.createDataFrame([(1, "S", "R1", "River One", "raw"), (2, "C", None, None, "raw"),
                                (3, "G", None, None, "raw"), (4, "S", None, None, "Raw Name")],
                               "rloi_id int, station_type string, river_id string, river_name string, wiski_river_name string")
    out = {r.rloi_id: r for r in river_labels(df).collect()}
    assert (out[1].river_id, out[1].navigable, out[1].view_rank) == ("R1", True, 1)
    assert (out[2].river_id, out[2].river_name, out[2].view_rank) == ("Sea Levels", "Sea Levels", 2)
    assert (out[3].river_id, out[3].view_rank) == ("Groundwater Levels", 3)
    assert (out[4].river_id, out[4].navigable, out[4].view_rank) == ("Raw Name", False, 4)
    assert river_labels(df, orphan_prefix="orphaned-").filter("rloi_id = 4").first().river_id == "orphaned-Raw Name"


def test_scope_and_wales(spark):
    df = spark.createDataFrame([(1, "Active", "Wales", "Wye"), (2, "Active", "wales", "Other"), (3, "closed", "X", "Y"),
                                (4, "Active", None, "Dee"), (5, None, "X", "Y"), (4162, "Active", "North", "c")],
                               "rloi_id int, status string, region string, catchment string")
    kept = sorted(r.rloi_id for r in df.filter(in_scope()).collect())
    assert kept == [1, 4, 4162]  # NULL region passes only by catchment (4 is in Dee)
    wales = {r.rloi_id: r.w for r in df.select("rloi_id", is_wales().alias("w")).collect()}
    assert wales[1] and wales[2] and wales[4162] and not wales[3]


def test_ordered_id_dense_and_total(spark):
    df = spark.range(0, 5000).select((F.col("id") % 7).alias("g"), F.col("id")).repartition(13)
    ids = with_ordered_id(df, [F.col("g").asc(), F.col("id").desc()], name="rn").orderBy("rn").collect()
    assert [r.rn for r in ids] == list(range(1, 5001))
    expected = sorted(((r.g, -r.id) for r in df.collect()))
    assert [(r.g, -r.id) for r in ids] == expected


def test_latest_per_key_null_timestamp_wins_like_desc_nulls_first(spark):
    df = spark.createDataFrame([(1, None, 1, 5.0), (1, 3, 2, 6.0), (2, 1, 3, 7.0), (2, 1, 4, 8.0)],
                               "k int, ts int, id int, v double")
    out = {r.k: r for r in latest_per_key(df, "k", "ts", "id").collect()}
    assert out[1].v == 5.0 and out[2].v == 8.0


def test_top_k_keeps_ties(spark):
    df = spark.createDataFrame([(1, 3), (1, 3), (1, 2), (1, 1)], "k int, ts int")
    assert top_k_per_key(df, "k", "ts", None, k=1).count() == 2


def test_split_directions(spark):
    df = spark.createDataFrame([(1, "M", 1.0, 2.0), (2, "S", 3.0, 4.0)],
                               "rloi_id int, station_type string, percentile_5 double, d_percentile_5 double")
    out = {(r.rloi_id, r.qualifier): r.percentile_5 for r in split_directions(df).collect()}
    assert out == {(1, "u"): 1.0, (1, "d"): 2.0, (2, "u"): 3.0}


def test_union_shapes_pads_and_dedupes(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(1, 2.0), (1, 2.0)], "id int, b double")
    out = union_shapes(a, b)
    assert out.count() == 2 and set(out.columns) == {"id", "a", "b"}
    assert union_shapes(a, b, distinct=False).count() == 3


def test_sync_table(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    inc = spark.createDataFrame([(2, "B"), (3, "c"), (4, "d")], "k int, v string")
    out = {r.k: (r.v, r.change) for r in sync_table(cur, inc, ["k"], with_change=True).collect()}
    assert out == {1: ("a", "delete"), 2: ("B", "update"), 3: ("c", "same"), 4: ("d", "insert")}
    assert sorted(r.k for r in sync_table(cur, inc, ["k"]).collect()) == [2, 3, 4]
    assert sorted(r.k for r in sync_table(cur, inc, ["k"], delete_missing=False).collect()) == [1, 2, 3, 4]


def test_apply_changes_and_cascade(spark):
    base = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "id int, value double")
    out = apply_changes(base, spark.createDataFrame([(2, 9.0), (4, 4.0)], "id int, value double"),
                        spark.createDataFrame([(3,)], "id int"), ["id"])
    assert sorted((r.id, r.value) for r in out.collect()) == [(1, 1.0), (2, 9.0), (4, 4.0)]
    child = spark.createDataFrame([(1, "t1"), (3, "t3")], "id int, code string")
    assert [r.code for r in cascade_delete(out, child, ["id"]).collect()] == ["t1"]


def test_anti_null_semantics(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    other = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r.k for r in anti(df, other, ["k"]).collect()] == [2]
    assert anti(df, other, ["k"], null_keys="sql_not_in").count() == 0  # §2.11 item 9


def test_retain_boundary_and_shift(spark):
    df = spark.createDataFrame([(1, "2023-02-06 13:00:00"), (2, "2023-02-06 12:59:59")], "id int, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    kept = retain(df, "ts", 3600, "2023-02-06 14:00:00")
    assert [r.id for r in kept.collect()] == [1]
    shifted = shift_to_now(df, ["ts"], df, "ts", "2023-02-06 14:00:00")
    assert str(shifted.agg(F.max("ts")).first()[0]) == "2023-02-06 14:00:00"


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert [(r.k, r.n) for r in check_unique(df, ["k"]).collect()] == [(1, 2)]
    assert check_columns(df, present=["k", "x"], absent=["v"]) == ["missing column x", "unexpected column v"]
