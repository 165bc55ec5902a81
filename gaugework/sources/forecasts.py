"""Forecast ingest (L7) and warning snapshot ingest (L8) from XML, via ``from_xml``.

``from_xml`` keeps element names with their namespace prefix (``md:Date``), attributes get
the ``_`` prefix and element text is ``_VALUE``. Files are read whole (``wholetext``), one row
per file, and parsed on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()
FC_VALUE = T.StructType([T.StructField("_date", S), T.StructField("_time", S), T.StructField("_VALUE", S)])
FC_SET = T.StructType([T.StructField(f"_{a}", S) for a in
                       ("parameter", "qualifier", "units", "startDate", "startTime", "endDate", "endTime")]
                      + [T.StructField("Value", T.ArrayType(FC_VALUE))])
FC_STATION = T.StructType([T.StructField("_stationReference", S), T.StructField("_stationName", S),
                           T.StructField("SetofValues", T.ArrayType(FC_SET))])
FORECAST_FILE = T.StructType([T.StructField("md:Date", S), T.StructField("md:Time", S),
                              T.StructField("Station", T.ArrayType(FC_STATION))])

WARNING_ATTRS = ["fwacode", "fwakey", "description", "region", "area", "tidal", "severity", "severityvalue",
                 "warningkey", "timeraised", "severity_changed", "rim_changed"]
WARNING = T.StructType([T.StructField(f"_{a}", S) for a in WARNING_ATTRS] + [T.StructField("rim_english", S)])
WARNING_FILE = T.StructType([T.StructField("warning", T.ArrayType(WARNING))])

TS = "yyyy-MM-dd HH:mm:ss"
WARN_TS = "dd MM yyyy HH mm"


def read_xml_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (filename, xml)."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_name").alias("filename"), F.col("value").alias("xml"))


def _ts(d, t, fmt=TS):
    return F.try_to_timestamp(F.concat(d, F.lit(" "), t), F.lit(fmt))


def parse_forecasts(files: DataFrame, xml: str = "xml") -> DataFrame:
    """L7 parse: one row per Station with the forecast date and the **first** SetofValues'
    attributes; its values as array<struct<ts, value>> (the reference keeps the XML body)."""
    doc = files.withColumn("_doc", F.from_xml(F.col(xml), FORECAST_FILE, {"mode": "PERMISSIVE"}))
    st = doc.select("filename", _ts(F.col("_doc.`md:Date`"), F.col("_doc.`md:Time`")).alias("forecast_date"),
                    F.explode_outer("_doc.Station").alias("_st")).filter(F.col("_st").isNotNull())
    first = F.element_at(F.col("_st.SetofValues"), 1)
    vals = F.transform(first["Value"], lambda v: F.struct(
        _ts(v["_date"], v["_time"]).alias("ts"), v["_VALUE"].try_cast("double").alias("value")))
    return st.select(
        "filename", "forecast_date", F.col("_st._stationReference").alias("station_reference"),
        F.col("_st._stationName").alias("station_name"), first["_parameter"].alias("parameter"),
        first["_qualifier"].alias("qualifier"), first["_units"].alias("units"),
        _ts(first["_startDate"], first["_startTime"]).alias("start_timestamp"),
        _ts(first["_endDate"], first["_endTime"]).alias("end_timestamp"), vals.alias("values"))


def ingest_forecasts(files: DataFrame, context: DataFrame, xml: str = "xml") -> DataFrame:
    """Parsed forecasts of parameter exactly 'Water Level', matched to a station by
    wiski_id (inner join: unmatched stations are dropped)."""
    f = parse_forecasts(files, xml).filter(F.col("parameter") == "Water Level")
    c = context.select(F.col("wiski_id").alias("station_reference"), "rloi_id")
    return f.join(c, "station_reference")


def forecast_max(forecasts: DataFrame, key: str = "rloi_id") -> DataFrame:
    """A10 (inferred; the reference only has the result table): per station the highest
    forecast value and when it occurs (earliest time among equal maxima)."""
    v = forecasts.select(key, "filename", F.explode("values").alias("_v")).filter(
        F.col("_v.value").isNotNull() & ~F.isnan("_v.value"))
    # one order for both columns: highest value, earliest time, then the greatest file name
    order = F.struct(F.col("_v.value"), -F.unix_micros(F.col("_v.ts").cast("timestamp")), "filename")
    return v.groupBy(key).agg(F.max("_v.value").alias("value"), F.max_by(F.col("_v.ts"), order).alias("value_date"),
                              F.max_by("filename", order).alias("filename"))


def parse_warnings(files: DataFrame, xml: str = "xml") -> DataFrame:
    """L8 parse: one row per ``warning`` element, typed, times in 'DD MM YYYY HH24 MI'."""
    doc = files.withColumn("_doc", F.from_xml(F.col(xml), WARNING_FILE, {"mode": "PERMISSIVE"}))
    w = doc.select("filename", F.explode_outer("_doc.warning").alias("w")).filter(F.col("w").isNotNull())
    ts = lambda a: F.try_to_timestamp(F.col(f"w._{a}"), F.lit(WARN_TS))
    return w.select(
        "filename", F.col("w._fwacode").alias("fwa_code"), F.col("w._fwakey").try_cast("int").alias("fwa_key"),
        F.col("w._description").alias("description"), F.col("w._region").alias("region"),
        F.col("w._area").alias("area"), F.col("w._tidal").alias("tidal"), F.col("w._severity").alias("severity"),
        F.col("w._severityvalue").try_cast("smallint").alias("severity_value"),
        F.col("w._warningkey").try_cast("int").alias("warning_key"), ts("timeraised").alias("time_raised"),
        ts("severity_changed").alias("severity_changed"), ts("rim_changed").alias("rim_changed"),
        F.col("w.rim_english").alias("rim"))


def ingest_warnings(files: DataFrame, current: DataFrame | None = None, xml: str = "xml") -> tuple[DataFrame, DataFrame]:
    """L8 full replace: the snapshot is taken only when exactly one file is present and its
    name starts with 'fwis-'; otherwise ``current`` is kept. Returns (warnings, load audit)
    where the audit carries the load time parsed from 'fwis-<epoch>.xml'. The guard is a
    one-row aggregate evaluated as a scalar subquery, not a driver-side branch."""
    ok_files = files.agg((F.count(F.lit(1)) == 1).alias("one"),
                         F.bool_and(F.col("filename").startswith("fwis-")).alias("prefix"))
    go = ok_files.select(F.col("one") & F.coalesce(F.col("prefix"), F.lit(False))).scalar()
    fresh = parse_warnings(files, xml).filter(go)
    if current is None:
        out = fresh
    else:
        out = fresh.unionByName(current.filter(~go), allowMissingColumns=True)
    audit = files.filter(go).select(
        F.regexp_extract("filename", r"^fwis-(\d+)\.xml$", 1).try_cast("long").alias("load_timestamp"))
    return out, audit
