"""Row predicates and derived keys F1–F8, F13, F14 as Column builders (all JVM-side)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.functions.numeric import col_

# Fixed values that must equal the reference's.
WELSH_KEPT_CATCHMENTS = ["Dee", "Severn Uplands", "Wye"]
WELSH_BORDER_STATIONS = [4162, 4170, 4173, 4174, 4176]
THRESHOLD_TYPES = ["FW ACT FW", "FW ACTCON FW", "FW RES FW", "FW ACT FAL", "FW ACTCON FAL", "FW RES FAL"]


def water_level(parameter: str | Column = "parameter", units: str | Column = "units",
                qualifier: str | Column = "qualifier") -> Column:
    """lower(parameter)='water level', units without 'deg', qualifier without 'height' and
    not 'crest tapping'. NULL qualifier makes it NULL, so the row is filtered out."""
    q = F.lower(col_(qualifier))
    return ((F.lower(col_(parameter)) == "water level")
            & ~F.lower(col_(units)).like("%deg%")
            & ~q.like("%height%")
            & (q != "crest tapping"))


def direction(qualifier: str | Column = "qualifier", marker: str = "downstream") -> Column:
    """'d' when lower(qualifier) contains the marker, else 'u'; NULL stays NULL. Joining
    on this derived key replaces the reference's OR-join with an equi-join."""
    q = F.lower(col_(qualifier))
    return F.when(q.isNull(), F.lit(None).cast("string")).when(q.contains(marker), "d").otherwise("u")


def derive_direction(df: DataFrame, qualifier: str = "qualifier", name: str = "direction",
                     marker: str = "downstream") -> DataFrame:
    """F2 as a DataFrame step: add the derived direction column."""
    return df.withColumn(name, direction(qualifier, marker))


def in_scope(status: str | Column = "status", region: str | Column = "region",
             catchment: str | Column = "catchment") -> Column:
    """not closed, and outside Wales or in one of the kept Welsh catchments."""
    return ((F.lower(col_(status)) != "closed")
            & ((F.lower(col_(region)) != "wales") | col_(catchment).isin(WELSH_KEPT_CATCHMENTS)))


def is_wales(region: str | Column = "region", station: str | Column = "rloi_id",
             border: Sequence[int] = tuple(WELSH_BORDER_STATIONS)) -> Column:
    """F4."""
    return (F.lower(col_(region)) == "wales") | col_(station).isin(list(border))


def after_status_date(ts: str | Column, status_date: str | Column) -> Column:
    """F5."""
    return col_(status_date).isNull() | (col_(ts) >= col_(status_date))


def recent(ts: str | Column, as_of: str, days: int = 5) -> Column:
    """strictly newer than as_of − days."""
    c = col_(ts)
    return c > F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {days} DAYS")


def in_bbox(lon: str | Column, lat: str | Column, west: float, south: float, east: float,
            north: float) -> Column:
    """strictly inside (ST_Contains excludes the boundary)."""
    x, y = col_(lon), col_(lat)
    return (x > west) & (x < east) & (y > south) & (y < north)


def in_list(c: str | Column, values: Iterable, negate: bool = False) -> Column:
    """F14 for literal lists."""
    cond = col_(c).isin(list(values))
    return ~cond if negate else cond


def semi(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """F14/J15 ``IN (subquery)``."""
    return df.join(other.select(*on), list(on), "left_semi")


def anti(df: DataFrame, other: DataFrame, on: Sequence[str], null_keys: str = "ignore") -> DataFrame:
    """F14/J14 ``LEFT JOIN … IS NULL`` / ``NOT IN``.

    ``null_keys='ignore'`` (default) drops NULL keys from ``other`` first. With
    ``null_keys='sql_not_in'`` a single NULL key in ``other`` empties the result, the SQL rule
    (§2.11 item 9), checked with an uncorrelated EXISTS subquery rather than a cross join."""
    o = other.select(*on)
    not_null = F.lit(True)
    for c in on:
        not_null = not_null & F.col(c).isNotNull()
    out = df.join(o.filter(not_null), list(on), "left_anti")
    if null_keys == "sql_not_in":
        out = out.filter(~o.filter(~not_null).exists())
    return out


def river_labels(df: DataFrame, station_type: str = "station_type", river_id: str = "river_id",
                 river_name: str = "river_name", raw_name: str = "wiski_river_name",
                 orphan_prefix: str = "") -> DataFrame:
    """F8: adds/overwrites (river_id, river_name, navigable, view_rank).

    On a river → the river's id/name, navigable, rank 1; else coastal 'C' → 'Sea Levels' 2;
    groundwater 'G' → 'Groundwater Levels' 3; otherwise the station's raw river name, rank 4
    (``orphan_prefix`` reproduces an older release that prefixed the id with 'orphaned-')."""
    t = F.col(station_type)
    rid, rname = F.col(river_id), F.col(river_name)
    raw = F.col(raw_name)
    raw_id = F.concat(F.lit(orphan_prefix), raw) if orphan_prefix else raw

    def ladder(on_river: Column, river_value: Column, other: Column) -> Column:
        return (F.when(on_river, river_value).when(t == "C", "Sea Levels")
                .when(t == "G", "Groundwater Levels").otherwise(other))

    return df.select(
        *[c for c in df.columns if c not in (river_id, river_name, "navigable", "view_rank")],
        ladder(rid.isNotNull(), rid.cast("string"), raw_id).alias(river_id),
        ladder(rname.isNotNull(), rname, raw).alias(river_name),
        rname.isNotNull().alias("navigable"),
        F.when(rid.isNotNull(), 1).when(t == "C", 2).when(t == "G", 3).otherwise(4).alias("view_rank"),
    )
