"""Skew-safe join-back of a per-key table onto a large table.

Several operators compute a per-key statistic (latest timestamp, limit, …) and then need it on
every row of that key. A plain equi-join puts every row of a hot key in one reduce task. Here
the large side gets a deterministic salt (hash of the row, so a recomputed partition gets the
same salt) and the per-key side, one row per key, is replicated once per salt value. The
replicated side grows by ``buckets`` × keys, never with the row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT_CONF = "gaugework.skew.saltBuckets"
DEFAULT_BUCKETS = 16


def salt_buckets(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(SALT_CONF, str(DEFAULT_BUCKETS)))


def salted_join(big: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner",
                buckets: int | None = None) -> DataFrame:
    """Join ``per_key`` (unique on ``keys``) onto ``big`` spreading each key over
    ``buckets`` tasks. Output has ``big``'s columns plus ``per_key``'s non-key columns."""
    n = buckets or salt_buckets(big)
    keys = list(keys)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(n)))
    rep = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    return salted.join(rep, keys + ["_salt"], how).drop("_salt")
