"""Trailing totals (A2, A3, A3b), record breach (J3, A4), existence flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.functions.numeric import nullif_nan

HOURS_NAMES = {24: "day_total", 6: "six_hr_total", 1: "one_hr_total"}


#: Rows of cut times (three a key by default) that are broadcast at most, after a count.
BROADCAST_ROWS = 500_000


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys where NULL equals NULL; ``right`` names them ``_k_<key>``, dropped afterwards."""
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(right[f"_k_{k}"])
    return left.join(right, on, how).drop(*[f"_k_{k}" for k in keys])


def trailing_totals(df: DataFrame, keys: str | Sequence[str], ts: str, value: str,
                    hours: Sequence[int] = (24, 6, 1), anchor: str = "latest",
                    as_of: str | None = None, names: Sequence[str] | None = None) -> DataFrame:
    """Sum of non-NaN ``value`` over (anchor − h, anchor] for each h, per key; rows of a NULL key are
    one key. An all-NaN window gives NULL.

    ``anchor='latest'`` (A3): each key's own newest timestamp. Two levels, so that no raw row is
    shuffled:

    1. ``groupBy(key, hour)`` sums and newest timestamps, pre-aggregated by the map tasks: a key
       that holds a third of all rows moves one row per hour and task. The table is stored.
    2. A window consists of whole hours and one cut hour at its start (the newest reading ends
       it). Whole hours are sums of step 1. Of the cut hours, one row per key and window says which
       hour and from when; the raw rows meet them where they are read, through a broadcast if at
       most ``BROADCAST_ROWS`` such rows were counted, else through a join of the raw rows of
       cut hours only.

    ``anchor='as_of'`` (A3b): a fixed clock; a filter and one aggregate."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    names = list(names) if names else [HOURS_NAMES.get(h, f"total_{h}h") for h in hours]
    base = df.select(*keys, F.col(ts).alias("_ts"), nullif_nan(value).alias("_v"))
    if anchor == "as_of":
        if as_of is None:
            raise ValueError("anchor='as_of' needs as_of")
        now = F.lit(as_of).cast(df.schema[ts].dataType)
        rows = base.filter(F.col("_ts") > now - F.expr(f"INTERVAL {max(hours)} HOURS"))
        return rows.groupBy(*keys).agg(*[
            F.sum(F.when(F.col("_ts") > now - F.expr(f"INTERVAL {h} HOURS"), F.col("_v"))).alias(n) for h, n in zip(hours, names)])
    if anchor != "latest":
        raise ValueError(anchor)
    from gaugework.session import snapshot

    hour = F.date_trunc("hour", "_ts").cast(df.schema[ts].dataType)
    by_hour = snapshot(base.withColumn("_hour", hour).groupBy(*keys, "_hour").agg(F.sum("_v").alias("_v"), F.max("_ts").alias("_newest")))
    latest = by_hour.groupBy(*keys).agg(F.max("_newest").alias("latest_ts"))
    cuts = F.array(*[F.struct(F.lit(i).alias("_i"), (F.col("latest_ts") - F.expr(f"INTERVAL {h} HOURS")).alias("_after")) for i, h in enumerate(hours)])
    cut = latest.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.explode(cuts).alias("_c")).select(
        *[f"_k_{k}" for k in keys], "_c.*").withColumn("_ts", F.col("_after")).withColumn("_cut", hour).drop("_ts")

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[F.sum(F.when(F.col("_i") == i, F.col("_v"))).alias(n) for i, n in enumerate(names)])

    whole = _null_safe(by_hour.select(*keys, "_hour", "_v"), cut, keys).filter(F.col("_hour") > F.col("_cut"))
    cut = cut.withColumnRenamed("_cut", "_k__hour")
    few = cut.count() <= BROADCAST_ROWS
    edge = _null_safe(base.withColumn("_hour", hour), F.broadcast(cut) if few else cut, [*keys, "_hour"]).filter(F.col("_ts") > F.col("_after"))
    every = latest.select(*keys, "latest_ts", *[F.lit(None).cast("double").alias(n) for n in names])
    parts = [totals(x).withColumn("latest_ts", F.lit(None).cast(df.schema[ts].dataType)) for x in (whole, edge)]
    return every.unionByName(parts[0]).unionByName(parts[1]).groupBy(*keys).agg(
        F.max("latest_ts").alias("latest_ts"), *[F.sum(n).alias(n) for n in names])


def breaches(limits: DataFrame, readings: DataFrame, on: Sequence[str], limit: str, value: str,
             error: str | None = None) -> DataFrame:
    """J3 + A4: distinct keys whose readings exceed the key's limit (non-error, neither
    NULL nor NaN, ``value > limit``). Readings are pre-aggregated to one max per key before the
    join, so the join never sees more than one row per key from the big side."""
    ok = F.col(value).isNotNull() & ~F.isnan(F.col(value))
    if error:
        ok = ok & ~F.col(error)
    peak = (readings.filter(ok).groupBy(*on)
            .agg(F.max(value).alias("_peak")))
    lim = limits.select(*on, limit).filter(F.col(limit).isNotNull())
    return (lim.join(peak, list(on)).filter(F.col("_peak") > F.col(limit))
            .select(*on).distinct())


def flag_exists(df: DataFrame, other: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """Boolean column, true when ``other`` has the key. ``other`` is reduced to distinct
    keys first, so a repeated key never fans ``df`` out (the reference would)."""
    keys = other.select(*on).distinct().withColumn(name, F.lit(True))
    return df.join(keys, list(on), "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))
