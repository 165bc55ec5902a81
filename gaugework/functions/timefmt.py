"""Timestamp text forms: ISO minutes (X7), epoch millis (X8), chart labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.functions.numeric import col_

CHART_ZONE = "Europe/London"


def iso_minutes(ts: str | Column) -> Column:
    """``to_char(ts,'YYYY-MM-DD"T"HH24:MIZ')`` in UTC with a literal Z."""
    return F.date_format(col_(ts), "yyyy-MM-dd'T'HH:mm'Z'")


def epoch_millis(ts: str | Column) -> Column:
    """``extract(epoch from ts) * 1000`` as BIGINT milliseconds (sub-millisecond parts are
    floored; feed timestamps are whole minutes, so the reference's fraction is always 0)."""
    return F.unix_millis(col_(ts).cast("timestamp"))


def _local(ts: str | Column, zone: str) -> Column:
    return F.from_utc_timestamp(col_(ts).cast("timestamp"), zone)


def full_label(ts: str | Column, zone: str = CHART_ZONE) -> Column:
    """'DD FMMonth YYYY FMHH12:MIam', e.g. '22 May 2015 12:00am'."""
    loc = _local(ts, zone)
    return F.concat(F.date_format(loc, "dd MMMM yyyy h:mm"), F.lower(F.date_format(loc, "a")))


def short_label(ts: str | Column, zone: str = CHART_ZONE) -> Column:
    """'FMHH12:MIam', e.g. '6:00pm'."""
    loc = _local(ts, zone)
    return F.concat(F.date_format(loc, "h:mm"), F.lower(F.date_format(loc, "a")))


def chart_label(ts: str | Column, zone: str = CHART_ZONE) -> Column:
    """Local midnight → full label; minute 0 and hour divisible by 6 → short; else ''."""
    loc = _local(ts, zone)
    h, m = F.hour(loc), F.minute(loc)
    return (F.when((h == 0) & (m == 0), full_label(ts, zone))
            .when((h % 6 == 0) & (m == 0), short_label(ts, zone))
            .otherwise(F.lit("")))


def with_chart_labels(df: DataFrame, keys: list[str], ts: str, name: str = "label",
                      zone: str = CHART_ZONE) -> DataFrame:
    """Chart labels where the first and last reading of each key always get the full
    form. First/last are an aggregate (min/max ts per key, partial-aggregated map-side)
    joined back with the salted join, not a sorted window over every row of the key."""
    from gaugework.operators.skew import salted_join

    ends = df.groupBy(*keys).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    out = salted_join(df, ends, keys)
    edge = (F.col(ts) == F.col("_first")) | (F.col(ts) == F.col("_last"))
    return (out.withColumn(name, F.when(edge, full_label(ts, zone)).otherwise(chart_label(ts, zone)))
            .drop("_first", "_last"))
