"""Ordered per-key arrays and JSON: A5, A6, O3, O6, X12.

Grouping into one array per key is the *feature* here (the reference returns one JSON
document per station), so callers bound the group first (five-day window, one
conversation). Sorting uses ``array_sort`` on the collected structs, which keeps the sort
inside the aggregate's task instead of a separate global sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sorted_structs(order: Sequence[str], fields: Sequence[str | Column], descending: bool) -> Column:
    # the flag puts NULLs last when ascending and first when descending, as in the reference
    items = F.struct(*[x for i, o in enumerate(order) for x in (F.col(o).isNull().alias(f"_n{i}"), F.col(o).alias(f"_o{i}"))],
                     F.struct(*[F.col(f) if isinstance(f, str) else f for f in fields]).alias("_v"))
    # wrapping the row in a struct keeps NULL fields (collect_list drops only NULL elements)
    return F.sort_array(F.collect_list(items), asc=not descending)


def ordered_json(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 fields: Sequence[str | Column], out: str = "json", descending: bool = True) -> DataFrame:
    """One JSON array of objects per key, ordered by ``order`` (newest first by
    default). NULL fields are written as ``null`` (``array_to_json`` keeps them)."""
    arr = _sorted_structs(order, fields, descending)
    return df.groupBy(*keys).agg(
        F.to_json(F.transform(arr, lambda x: x["_v"]), {"ignoreNullFields": "false"}).alias(out))


def parallel_arrays(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    fields: Sequence[str], descending: bool = False) -> DataFrame:
    """Per key, one array per field, all in the same order."""
    arr = _sorted_structs(order, fields, descending)
    agg = df.groupBy(*keys).agg(arr.alias("_arr"))
    def field(f: str):
        return lambda x: x["_v"][f]
    return agg.select(*keys, *[F.transform("_arr", field(f)).alias(f"{f}s") for f in fields])


#: Rows that one array makes at most in ``repeated``.
REPEAT_BLOCK = 1024


def repeated(df: DataFrame, times: Column) -> DataFrame:
    """Every row ``times`` (1 or more) times, in blocks, so that no array grows with ``times``."""
    blocks = df.withColumn("_left", times.cast("long")).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_left") - 1) / REPEAT_BLOCK))).alias("_block"))
    here = F.least(F.lit(REPEAT_BLOCK), F.col("_left") - F.col("_block") * REPEAT_BLOCK).cast("int")
    return blocks.select("*", F.explode(F.sequence(F.lit(1), here)).alias("_copy")).drop("_left", "_block", "_copy")
