"""Warning-threshold payloads: L15 flatten, L16 minima, L17 fetch list and reject policy,
L18 CSV sink, V13 display flags.

A payload is one JSON document per station (an array of station objects).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.functions.predicates import THRESHOLD_TYPES

S = T.StringType()
THRESHOLD = T.StructType([T.StructField("ThresholdType", S), T.StructField("Level", T.DoubleType()),
                          T.StructField("FloodWarningArea", S)])
SERIES = T.StructType([T.StructField("Parameter", S), T.StructField("qualifier", S), T.StructField("Unit", S),
                       T.StructField("DisplayTimeSeries", T.BooleanType()),
                       T.StructField("Thresholds", T.ArrayType(THRESHOLD))])
STATION = T.StructType([T.StructField("RLOIid", S), T.StructField("wiskiID", S), T.StructField("telemetryID", S),
                        T.StructField("Name", S), T.StructField("TimeSeriesMetaData", T.ArrayType(SERIES))])
PAYLOAD = T.ArrayType(STATION)

CSV_COLUMNS = ["station_id", "fwis_code", "fwis_type", "direction", "value"]


def parse_payload(df: DataFrame, text: str = "json") -> DataFrame:
    """From a JSON text column to one row per station object; a document that does not
    parse as an array of stations is kept aside as ``_corrupt`` (L17 policy: log, skip); an
    empty array is one row without a station, not corrupt.

    Good rows and rejects come from this one parse: the mark travels inside the exploded array. As
    a column of its own it would be a function of the parse, and a filter on it would be pushed
    below the generator and parse every document again."""
    station = T.StructType([T.StructField("station", STATION), T.StructField("bad", T.BooleanType())])
    stations = F.transform(F.from_json(F.col(text), PAYLOAD), lambda s: F.struct(s.alias("station"), F.lit(False).alias("bad")))
    unparsed = F.array(F.struct(F.lit(None).cast(STATION).alias("station"), F.lit(True).alias("bad")))
    parsed = df.select("*", F.posexplode_outer(F.coalesce(stations, unparsed).cast(T.ArrayType(station))).alias("_station_pos", "_s"))
    marked = parsed.select(*df.columns, "_station_pos", F.col("_s.station").alias("_station"), F.coalesce("_s.bad", F.lit(False)).alias("_corrupt"))
    return marked


def bad_documents(parsed: DataFrame) -> DataFrame:
    """L17 rejects: the rows of ``parse_payload`` whose document does not parse as an array of stations
    (NULL included), as they came. An empty array is valid and has no rows anywhere."""
    return parsed.filter("_corrupt").drop("_station_pos", "_station", "_corrupt")


def explode_series(payload: DataFrame, text: str = "json") -> DataFrame:
    """One row per time series with its position, for series-level flags."""
    st = parse_payload(payload, text).filter(~F.col("_corrupt"))
    s = st.select(F.col("_station.RLOIid").try_cast("long").alias("station_id"), "_station_pos",
                  F.posexplode_outer("_station.TimeSeriesMetaData").alias("_series_pos", "_series")) \
        .filter(F.col("_series_pos").isNotNull())
    return s.select("station_id", "_station_pos", "_series_pos", F.col("_series.Parameter").alias("parameter"),
                    F.col("_series.qualifier").alias("qualifier"),
                    F.col("_series.DisplayTimeSeries").alias("display_time_series"),
                    F.when(F.col("_series.qualifier") == "Downstream Stage", "d").otherwise("u").alias("direction"),
                    F.col("_series.Thresholds").alias("thresholds"))


def parse_thresholds(payload: DataFrame, text: str = "json", with_rejects: bool = False):
    """Skip 'Flow' series (a missing Parameter is kept, JS ``!==``), keep the six
    included threshold types, type = 5th character of the area code, direction 'd' only for
    qualifier exactly 'Downstream Stage'. Order is kept in ``seq`` (station, series,
    threshold positions); nothing is deduplicated. A kept threshold with no area code is a
    reject (the JS throws and loses the station; §2.11 item 16)."""
    s = explode_series(payload, text).filter(~F.col("parameter").eqNullSafe("Flow"))
    th = s.select("station_id", "direction", "_station_pos", "_series_pos",
                  F.posexplode_outer("thresholds").alias("_th_pos", "_t")).filter(F.col("_th_pos").isNotNull())
    th = th.filter(F.col("_t.ThresholdType").isin(THRESHOLD_TYPES))
    out = th.select(
        "station_id", F.col("_t.FloodWarningArea").alias("fwis_code"),
        F.substring(F.col("_t.FloodWarningArea"), 5, 1).alias("fwis_type"), "direction",
        F.col("_t.Level").alias("value"), F.col("_t.ThresholdType").alias("threshold_type"),
        F.struct("_station_pos", "_series_pos", "_th_pos").alias("seq"))
    good = out.filter(F.col("fwis_code").isNotNull())
    if with_rejects:
        return good, out.filter(F.col("fwis_code").isNull())
    return good


def min_thresholds(thresholds: DataFrame) -> DataFrame:
    """Per station the minimum level for downstream/upstream × alert/warning, NULL when
    there is none; four conditional mins in one aggregate (no pivot shuffle)."""
    t = F.lower(F.col("fwis_type"))

    def mn(d: str, k: str):
        return F.min(F.when((F.col("direction") == d) & (t == k), F.col("value")))
    return thresholds.groupBy("station_id").agg(
        mn("d", "a").alias("downstream_alert"), mn("d", "w").alias("downstream_warning"),
        mn("u", "a").alias("upstream_alert"), mn("u", "w").alias("upstream_warning"))


def stations_to_fetch(river_stations: DataFrame, key: str = "rloi_id") -> DataFrame:
    """Distinct non-null station ids, ascending (a sort only for the report)."""
    return river_stations.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(key)


def write_thresholds(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header station_id,fwis_code,fwis_type,direction,value."""
    df.select(*CSV_COLUMNS).write.mode(mode).option("header", True).csv(path)
