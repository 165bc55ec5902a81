"""Table maintenance on immutable Parquet snapshots: L9/J16 sync, L11 change sets and
cascade, L19 snapshot/restore, L20 retention, L21 time shift, Q1 checks, A7 audit.

Nothing here overwrites the path it reads: callers write the returned frame to a new
version folder (``write_version``) and switch readers to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sync_table(current: DataFrame, incoming: DataFrame, key: Sequence[str], delete_missing: bool = True,
               with_change: bool = False) -> DataFrame:
    """Update matching keys on all columns, insert new keys, delete keys missing
    from ``incoming`` (when ``delete_missing``). One full outer join on the key (both sides
    hash-partitioned by it); ``change`` is insert / update / same / delete."""
    key = list(key)
    cols = [c for c in incoming.columns if c not in key]
    cur = current.select(*key, F.struct(*[F.col(c) for c in cols]).alias("_old"))
    inc = incoming.select(*key, F.struct(*[F.col(c) for c in cols]).alias("_new"))
    j = cur.join(inc, key, "full_outer")
    change = (F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete")
              .when(F.col("_old").eqNullSafe(F.col("_new")), "same").otherwise("update"))
    j = j.withColumn("change", change)
    if delete_missing and not with_change:
        j = j.filter(F.col("change") != "delete")
    row = F.when(F.col("change") == "delete", F.col("_old")).otherwise(F.col("_new"))
    if not delete_missing:
        row = F.coalesce(F.col("_new"), F.col("_old"))
    out = j.select(*key, *[row[c].alias(c) for c in cols], "change")
    return out if with_change else out.drop("change")


def apply_changes(base: DataFrame, upserts: DataFrame | None = None, deletes: DataFrame | None = None,
                  key: Sequence[str] = ("id",)) -> DataFrame:
    """Delete keys in ``deletes``, then replace/insert rows of ``upserts`` (anti join +
    union, no global sort)."""
    key = list(key)
    out = base
    if deletes is not None:
        out = out.join(deletes.select(*key).distinct(), key, "left_anti")
    if upserts is not None:
        out = out.join(upserts.select(*key).distinct(), key, "left_anti").unionByName(upserts.select(*base.columns))
    return out


def cascade_delete(parent: DataFrame, child: DataFrame, fk: Sequence[str], pk: Sequence[str] | None = None) -> DataFrame:
    """Children whose parent still exists (semi join)."""
    pk = list(pk or fk)
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(pk, fk)])
    return child.join(p, list(fk), "left_semi")


def retain(df: DataFrame, ts: str, seconds: int, as_of: str) -> DataFrame:
    """Keep rows imported at or after as_of − seconds (the delete is strict ``<``)."""
    lim = F.lit(as_of).cast(df.schema[ts].dataType) - F.make_dt_interval(secs=F.lit(seconds))
    return df.filter(F.col(ts) >= lim)


def shift_to_now(df: DataFrame, ts_cols: Sequence[str], anchor: DataFrame, anchor_ts: str, as_of: str) -> DataFrame:
    """Move every timestamp by as_of − max(anchor_ts). The maximum is a one-row
    aggregate used as a scalar subquery (no cross join, no driver round trip)."""
    mx = anchor.agg(F.max(anchor_ts)).scalar()
    delta = F.lit(as_of).cast(anchor.schema[anchor_ts].dataType) - mx
    out = df
    for c in ts_cols:
        out = out.withColumn(c, F.col(c) + delta)
    return out


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q1: keys that occur more than once, with their count (empty = unique)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_columns(df: DataFrame, present: Sequence[str] = (), absent: Sequence[str] = ()) -> list[str]:
    """Q1 schema contract (metadata only, no job): list of violations."""
    cols = set(df.columns)
    return ([f"missing column {c}" for c in present if c not in cols]
            + [f"unexpected column {c}" for c in absent if c in cols])


def count_audit(**tables: DataFrame) -> DataFrame:
    """One row per named table with its row count."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_version(df: DataFrame, root: str, version: str, mode: str = "errorifexists",
                  partition_by: Sequence[str] = ()) -> str:
    """Write a snapshot to ``root/version`` (never over the input)."""
    path = f"{root.rstrip('/')}/{version}"
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def snapshot(tables: dict[str, DataFrame], root: str, version: str) -> dict[str, str]:
    """L19 backup: copy each table to a versioned folder."""
    return {name: write_version(df, f"{root.rstrip('/')}/{name}", version) for name, df in tables.items()}


def restore(spark, paths: dict[str, str], current: dict[str, DataFrame] | None = None,
            append: bool = True) -> dict[str, DataFrame]:
    """L19 restore: the reference appends the backup to the live table; ``append=False``
    replaces instead."""
    out = {}
    for name, path in paths.items():
        b = spark.read.parquet(path)
        out[name] = current[name].unionByName(b) if (append and current and name in current) else b
    return out


def cleared(df: DataFrame) -> DataFrame:
    """L19 clear: an empty table with the same schema."""
    return df.limit(0)


def recent_partition_filter(ts: str, as_of: str, days: int) -> Column:
    """Partition-prunable form of F6 when tables are partitioned by date(imported)."""
    return F.col(ts) >= F.date_sub(F.lit(as_of).cast("date"), days)
