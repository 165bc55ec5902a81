"""Per-key ranking primitives: A1, A2, W1, W2, W3, W5, W6, W7, J5, O1, O4.

Scale notes
-----------
* ``latest_per_key`` is an aggregate (``max_by`` over a struct sort key), so Spark does a
  map-side partial aggregate: a key holding a third of the rows is reduced to one row per
  map task before the shuffle.
* ``top_k_per_key`` filters ``rank() <= k`` right after the window; Catalyst inserts a
  partial ``WindowGroupLimit`` before the exchange, so hot keys ship at most k rows (plus
  ties) per map task.
* ``with_ordered_id`` numbers rows without a single-partition window: range-sort, count
  rows per sorted partition, turn counts into offsets (one row per partition, a proven
  size bound, broadcast), add the in-partition position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.functions.numeric import exact, is_nan


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _sort_key(order: str | Sequence[str], tiebreak: str | Sequence[str] | None) -> Column:
    """Struct whose maximum is the row Postgres puts first under ``ORDER BY … DESC``
    (DESC puts NULLs first, so a NULL order value ranks as the latest)."""
    parts: list[Column] = []
    for c in _cols(order) + (_cols(tiebreak) if tiebreak else []):
        parts += [F.col(c).isNull(), F.col(c)]
    return F.struct(*parts)


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
                   tiebreak: str | Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest (order, tiebreak), like ``DISTINCT ON``."""
    keys = _cols(keys)
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), _sort_key(order, tiebreak)).alias("_latest"))
    return picked.select(*keys, *[F.col("_latest")[c].alias(c) for c in rest])


def latest_ts_per_key(df: DataFrame, keys: str | Sequence[str], ts: str, name: str = "latest_ts") -> DataFrame:
    """A2: ``max(ts)`` per key as its own small table (join it back rather than a window over
    every row, so a hot key is pre-aggregated map-side)."""
    return df.groupBy(*_cols(keys)).agg(F.max(ts).alias(name))


def ranked(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
           tiebreak: str | Sequence[str] | None = None, name: str = "rank",
           ascending: bool = False, dense: bool = False) -> DataFrame:
    """Add ``rank()`` over key ordered by (order, tiebreak). Descending uses NULLS FIRST and
    ascending NULLS LAST, the Postgres defaults."""
    cols = _cols(order) + (_cols(tiebreak) if tiebreak else [])
    ords = [F.col(c).asc_nulls_last() if ascending else F.col(c).desc_nulls_first() for c in cols]
    w = Window.partitionBy(*_cols(keys)).orderBy(*ords)
    fn = F.dense_rank() if dense else F.rank()
    return df.withColumn(name, fn.over(w))


def top_k_per_key(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
                  tiebreak: str | Sequence[str] | None = None, k: int = 5,
                  name: str = "rank") -> DataFrame:
    """Rows with ``rank() <= k`` per key, newest first. Ties at the cut are all kept
    (rank semantics); with a unique tiebreak this is exactly k rows."""
    return ranked(df, keys, order, tiebreak, name).filter(F.col(name) <= k)


def trailing_mean(df: DataFrame, keys: str | Sequence[str], order: str, tiebreak: str | None,
                  value: str, n: int = 4, k: int | None = None) -> DataFrame:
    """Per key, the latest row plus the mean of the ``n`` rows before it.

    Computed on the top ``n+1`` rows only (the reference's own optimisation), as one
    aggregate over ranks 2..n+1. The mean is exact DECIMAL over non-NaN values with a
    separate ``previous_is_nan`` flag: Postgres' avg is NaN as soon as one input is NaN.
    Output: keys, every input column of the latest row, ``previous_value`` (decimal),
    ``previous_is_nan`` and ``previous_count``.
    """
    keys = _cols(keys)
    top = top_k_per_key(df, keys, order, tiebreak, k=k or n + 1, name="_rk")
    rest = [c for c in df.columns if c not in keys]
    older = F.col("_rk") > 1
    agg = top.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(-F.col("_rk"))).alias("_latest"),
        F.avg(F.when(older, exact(value))).alias("previous_value"),
        F.max(F.when(older, is_nan(value))).alias("previous_is_nan"),
        F.count(F.when(older, F.lit(1))).alias("previous_count"),
    )
    return agg.select(*keys, *[F.col("_latest")[c].alias(c) for c in rest],
                      "previous_value", "previous_is_nan", "previous_count")


def lag_value(df: DataFrame, keys: str | Sequence[str], order: str, tiebreak: str | None,
              value: str, name: str = "previous_value") -> DataFrame:
    """The latest row per key and the value of the row just before it (the older trend
    rule). Works on the top-2 rows only, so the window never sorts a whole hot key."""
    keys = _cols(keys)
    top = top_k_per_key(df, keys, order, tiebreak, k=2, name="_rk")
    rest = [c for c in df.columns if c not in keys]
    agg = top.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(-F.col("_rk"))).alias("_latest"),
        F.first(F.when(F.col("_rk") == 2, F.col(value)), ignorenulls=True).alias(name),
    )
    return agg.select(*keys, *[F.col("_latest")[c].alias(c) for c in rest], name)


def group_rank(df: DataFrame, group: str, order: Column, name: str = "rank") -> DataFrame:
    """``rank()`` over ``partitionBy(group).orderBy(order)`` without putting a whole group in
    one task. Rows of a NULL group are one group, as in the window.

    The rows are range-partitioned on (group, order); equal keys always land in the same
    range partition, so ties never straddle a boundary. Each row gets its rank inside its
    (group, partition) slice, plus the number of rows of its group in earlier partitions (a
    running sum over a table with one row per (group, partition), at most groups + partitions
    rows). A group holding a third of the rows is thus spread over many range partitions.

    The range-partitioned slices are checkpointed (reliably, to ``spark.checkpoint.dir``):
    a range partitioner samples its bounds per planned exchange, so two branches planned
    separately could cut different ranges; reading one checkpoint makes both see the same
    slices, also after an executor is lost."""
    from gaugework.session import cut_lineage

    n = df.sparkSession.sparkContext.defaultParallelism
    n = max(n, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", str(n))))
    parts = df.repartitionByRange(n, F.col(group).asc_nulls_last(), order).withColumn("_pid", F.spark_partition_id())
    parts = cut_lineage(parts)
    local = parts.withColumn("_lr", F.rank().over(Window.partitionBy(group, "_pid").orderBy(order)))
    counts = parts.groupBy(group, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.partitionBy(group).orderBy("_pid")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    offsets = offsets.select(F.col(group).alias("_og"), F.col("_pid").alias("_op"), "_off")
    out = local.join(offsets, F.col(group).eqNullSafe(F.col("_og")) & (F.col("_pid") == F.col("_op")))
    return out.withColumn(name, (F.col("_off") + F.col("_lr")).cast("int")).drop("_pid", "_lr", "_off", "_og", "_op")


def rank_neighbours(df: DataFrame, group: str, rank: str, node: str | Sequence[str],
                    carry: Sequence[str] = (), name: str = "calc_rank") -> DataFrame:
    """W5 + J5: position along a group (``rank()`` over the raw rank, NULLS LAST) and the
    node(s) one position up (calc_rank − 1) and down (calc_rank + 1).

    Neighbours are equi-joins on (group, calc_rank ± 1), not lag/lead: tied ranks share a
    position, the next position is skipped, so a neighbour can fan out or be missing,
    exactly like the reference's self join. The position comes from ``group_rank`` (no
    single-task group) and the joins are on (group, position), which spreads a long group
    over many tasks."""
    nodes = _cols(node)
    base = group_rank(df, group, F.col(rank).asc_nulls_last(), name)
    nb = base.select(F.col(group).alias("_g"), F.col(name).alias("_r"),
                     *[F.col(c).alias(f"_n_{c}") for c in nodes + list(carry)])
    up = nb.select("_g", (F.col("_r") + 1).alias("_r"),
                   *[F.col(f"_n_{c}").alias(f"up_{c}") for c in nodes + list(carry)])
    down = nb.select("_g", (F.col("_r") - 1).alias("_r"),
                     *[F.col(f"_n_{c}").alias(f"down_{c}") for c in nodes + list(carry)])
    out = (base.join(up, (base[group] == up["_g"]) & (base[name] == up["_r"]), "left")
           .drop("_g", "_r"))
    out = (out.join(down, (out[group] == down["_g"]) & (out[name] == down["_r"]), "left")
           .drop("_g", "_r"))
    return out


def with_ordered_id(df: DataFrame, order: Sequence[Column], name: str = "id") -> DataFrame:
    """``row_number()`` over a total order without funnelling rows into one partition.

    ``order`` must be a total order (end it with a unique key) so the numbering is
    deterministic if a lost partition is recomputed. Plan: range-partitioned sort; per
    partition row counts (one row per partition, bounded by the partition count, hence a
    safe broadcast); running offsets; id = offset + position in partition.
    """
    from gaugework.session import cut_lineage

    sorted_df = df.sort(*order).withColumn("_pid", F.spark_partition_id())
    # position inside the partition, from the id Spark assigns in partition order
    sorted_df = sorted_df.withColumn("_mid", F.monotonically_increasing_id())
    sorted_df = cut_lineage(sorted_df)  # fix partition contents before counting
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    offsets = counts.withColumn(
        "_off", F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = offsets.select("_pid", F.coalesce("_off", F.lit(0)).alias("_off"), "_m0")
    out = sorted_df.join(F.broadcast(offsets), "_pid")
    out = out.withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_m0") + 1).cast("bigint"))
    return out.drop("_pid", "_mid", "_off", "_m0")
