"""Materialise the served views in dependency order.

Each view is written to ``root/<view>/<version>``, and a one-line file ``root/<view>/CURRENT`` names the version
that readers take. The line is replaced only when the new version is complete, so a failed run leaves
the last one served. A view that others read is read back from its written version, which also cuts the
lineage. A view in a partial run reads the views it needs from this run or else from their current version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gaugework.operators.tables import write_version
from gaugework.plans import views

#: view → (builder, inputs). Inputs name raw tables, earlier views or ``@as_of``.
PLAN: dict[str, tuple[Callable[..., DataFrame], list[str]]] = {
    "station_context": (views.station_context, ["telemetry_context", "time_series_region_lkp"]),
    "station_split": (views.station_split, ["telemetry_context"]),
    "stations_overview": (views.stations_overview, ["station_split", "sls_telemetry_value_parent", "sls_telemetry_value", "ffoi_station", "@as_of"]),
    "rainfall_stations": (views.rainfall_stations, ["sls_telemetry_station", "sls_telemetry_value_parent", "sls_telemetry_value"]),
    "rivers": (views.rivers, ["station_split", "stations_overview", "river_stations", "river", "telemetry_context"]),
    "stations_list": (views.stations_list, ["rivers", "rainfall_stations"]),
    "impacts": (views.impacts, ["impact", "telemetry_context", "stations_overview", "ffoi_max", "ffoi_station"]),
    "warnings_with_area": (views.warnings_with_area, ["fwis", "flood_alert_area", "flood_warning_area"]),
    "station_ta_8km": (views.station_areas, ["telemetry_context", "flood_alert_area", "flood_warning_area"]),
    "forecast_thresholds": (views.forecast_thresholds, ["ffoi_station", "ffoi_station_threshold", "flood_alert_area", "flood_warning_area", "fwis"]),
}
ORDER = list(PLAN)


def _pointer(spark: SparkSession, root: str, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}/CURRENT")
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _serve(spark: SparkSession, root: str, name: str, version: str) -> None:
    path, files = _pointer(spark, root, name)
    out = files.create(path, True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()


def current(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The served version of a view; None before its first."""
    path, files = _pointer(spark, root, name)
    if not files.exists(path):
        return None
    version = spark.read.text(path.toString()).first()["value"]
    return spark.read.parquet(f"{root.rstrip('/')}/{name}/{version}")


def refresh(spark: SparkSession, tables: dict[str, DataFrame], root: str, version: str, as_of: str,
            names: list[str] | None = None) -> dict[str, str]:
    """Build ``names`` in dependency order and return their written paths. Without ``names``, every view whose raw tables
    are in ``tables``. An unknown name, or an input that is neither a table, nor built here, nor served, is an error
    before anything is written."""
    if unknown := set(names or ()) - set(ORDER):
        raise ValueError(f"no such views: {sorted(unknown)}")
    chosen: list[str] = []
    for name in ORDER:
        missing = [i for i in PLAN[name][1] if i != "@as_of" and i not in tables and i not in chosen
                   and not (i in PLAN and current(spark, root, i) is not None)]
        if not missing and (names is None or name in names):
            chosen.append(name)
        elif missing and names and name in names:
            raise ValueError(f"{name} needs {missing}")
    done: dict[str, DataFrame] = {}
    paths: dict[str, str] = {}
    for name in chosen:
        build, inputs = PLAN[name]
        args = [as_of if i == "@as_of" else done[i] if i in done else tables[i] if i in tables else current(spark, root, i) for i in inputs]
        paths[name] = write_version(build(*args), f"{root.rstrip('/')}/{name}", version, mode="overwrite")
        _serve(spark, root, name, version)
        done[name] = spark.read.parquet(paths[name])
    return paths
