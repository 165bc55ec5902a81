"""Direction split (V2, S1) and padded unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: the per-direction measures a multi-gauge
# ('M') station carries twice, the downstream copy under a 'd_' prefix.
SPLIT_MEASURES = [
    "stage_datum", "period_of_record", "por_max_value", "date_por_max", "highest_level",
    "date_highest_level", "por_min_value", "date_por_min", "percentile_5", "percentile_95",
    "comments",
]


def split_directions(df: DataFrame, type_col: str = "station_type", multi: str = "M",
                     prefix: str = "d_", measures: Sequence[str] = tuple(SPLIT_MEASURES),
                     name: str = "qualifier") -> DataFrame:
    """V2: every station once as 'u'; stations of type ``multi`` again as 'd' with the
    prefixed measures in place of the plain ones. The two halves are disjoint by ``name``,
    so a plain union-all (no shuffle) replaces the reference's UNION."""
    measures = [m for m in measures if m in df.columns]
    prefixed = [f"{prefix}{m}" for m in measures if f"{prefix}{m}" in df.columns]
    base_cols = [c for c in df.columns if c not in prefixed]
    up = df.select(*base_cols).withColumn(name, F.lit("u"))
    down = (df.filter(F.col(type_col) == multi)
            .select(*[F.col(f"{prefix}{c}").alias(c) if c in measures and f"{prefix}{c}" in df.columns
                      else F.col(c) for c in base_cols])
            .withColumn(name, F.lit("d")))
    return up.unionByName(down)


def union_shapes(*dfs: DataFrame, distinct: bool = True) -> DataFrame:
    """Union by name with missing columns padded as typed NULLs; ``distinct``
    gives SQL UNION, otherwise UNION ALL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out.distinct() if distinct else out
