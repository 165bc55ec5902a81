"""The driver-facing query set: each entry runs a gaugework operator over the given test

Role mapping used throughout: a *reading* is an ``events`` row (station = user_id,
qualifier = event_type, timestamp = ts, value id = event_id, value = value); a *header /
value pair* is orders / lineitem; a *station master* is supplier with nation ⋈ region as the
region lookup; a *river* is an order (rank = l_linenumber, station = l_suppkey).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugework.session import balanced, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Fixed clock used by the as-of queries (the events table spans January 2024).
AS_OF = "2024-01-31 00:00:00"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def t(spark: SparkSession, sf_dir: str, name: str, balance: bool = False) -> DataFrame:
    """A test table; ``balance`` spreads it over the cores before CPU-heavy per-row work."""
    df = read_table(spark, sf_dir, name)
    return balanced(df) if balance else df

