"""Gauge reading ingest: L1 (JSON files), L2 (match to station), L3 (clean), L4 (rejects), L5.

A reading file is one JSON document: EATimeSeriesDataExchangeFormat.Station[] →
SetofValues[] → Value[]; attributes live under ``$`` and text under ``_``. Files are read
with a declared schema (never inferred), one row per file, and flattened with ``explode`` on
the executors; rows that fail a cast go to a rejects frame instead of failing the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VALUE = T.StructType([T.StructField("_", T.StringType()),
                      T.StructField("$", T.StructType([T.StructField("date", T.StringType()),
                                                       T.StructField("time", T.StringType())]))])
SET_ATTRS = ["startDate", "startTime", "endDate", "endTime", "parameter", "qualifier", "units"]
SET_OF_VALUES = T.StructType([
    T.StructField("$", T.StructType([T.StructField(a, T.StringType()) for a in SET_ATTRS])),
    T.StructField("Value", T.ArrayType(VALUE))])
STATION = T.StructType([
    T.StructField("$", T.StructType([T.StructField("stationReference", T.StringType()),
                                     T.StructField("region", T.StringType())])),
    T.StructField("SetofValues", T.ArrayType(SET_OF_VALUES))])
READING_FILE = T.StructType([T.StructField("EATimeSeriesDataExchangeFormat", T.StructType([
    T.StructField("Station", T.ArrayType(STATION))]))])

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_reading_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file with its name (the dedupe key of L6)."""
    df = spark.read.schema(READING_FILE).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return df.select(F.col("_metadata.file_name").alias("filename"), "EATimeSeriesDataExchangeFormat")


def parse_reading_text(df: DataFrame, text: str = "json", filename: str = "filename") -> DataFrame:
    """Same shape as ``read_reading_files`` from a string column holding the document."""
    return df.select(F.col(filename).alias("filename"),
                     F.from_json(F.col(text), READING_FILE)["EATimeSeriesDataExchangeFormat"]
                     .alias("EATimeSeriesDataExchangeFormat"))


def _unquote(c: Column) -> Column:
    return F.btrim(c, F.lit('"'))


def _ts(d: Column, t: Column) -> Column:
    """Date ‖ ' ' ‖ time → timestamp; NULL when either part is NULL (``concat``, not
    ``concat_ws``) or when the text does not parse."""
    return F.try_to_timestamp(F.concat(d, F.lit(" "), t), F.lit(TS_FORMAT))


def explode_kept(df: DataFrame, arr: str, pos: str, item: str, *keep) -> DataFrame:
    """``posexplode`` that does not re-parse its input: a plain generator makes Catalyst infer
    ``size(array) > 0`` and push it below the projection that parses the document, so every
    document would be parsed twice. The outer form has no inferred filter; empty arrays are
    then dropped on the generated position."""
    return (df.select(*keep, F.posexplode_outer(arr).alias(pos, item))
            .filter(F.col(pos).isNotNull()))


def ingest_readings(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L1: (headers, values) as text-typed rows with parsed timestamps. The header id is a
    hash of (filename, station position, set position), stable across replays."""
    st = explode_kept(raw, "EATimeSeriesDataExchangeFormat.Station", "_si", "_st", "filename")
    sv = explode_kept(st.select("filename", "_si", F.col("_st.$.stationReference").alias("station"),
                                F.col("_st.$.region").alias("region"), "_st"),
                      "_st.SetofValues", "_vi", "_sv", "filename", "_si", "station", "region")
    hid = F.xxhash64("filename", "_si", "_vi")
    a = F.col("_sv.$")
    headers = sv.select(
        hid.alias("telemetry_value_parent_id"), "filename",
        _unquote(F.col("station")).alias("station"), _unquote(F.col("region")).alias("region"),
        _ts(a["startDate"], a["startTime"]).alias("start_timestamp"),
        _ts(a["endDate"], a["endTime"]).alias("end_timestamp"),
        _unquote(a["parameter"]).alias("parameter"), _unquote(a["qualifier"]).alias("qualifier"),
        _unquote(a["units"]).alias("units"))
    vals = explode_kept(sv.select(hid.alias("telemetry_value_parent_id"), "_sv"), "_sv.Value", "_pi", "_v",
                        "telemetry_value_parent_id")
    values = vals.select(
        "telemetry_value_parent_id",
        F.xxhash64("telemetry_value_parent_id", "_pi").alias("telemetry_value_id"),
        _unquote(F.col("_v._")).alias("value_text"),
        _ts(F.col("_v.$.date"), F.col("_v.$.time")).alias("value_timestamp"))
    return headers, values


def match_station(headers: DataFrame, context: DataFrame, region_lookup: DataFrame,
                  dp: int = 2, marker: str = "downstream") -> DataFrame:
    """L2: keep headers whose (station, feed region) matches a station's (telemetry_id,
    context region) through the region lookup; carry rloi_id, station_type, post_process,
    subtract and the per-direction por_max / percentile_5 rounded to ``dp`` (the 'd_' columns
    when the qualifier contains ``marker``). Unmatched headers are dropped, as the reference.
    The lookup is a fixed nine-row table (broadcast); the context join is left to AQE."""
    lk = F.broadcast(region_lookup.select(F.col("region_name").alias("_feed"),
                                          F.col("context_region_name").alias("_ctx")))
    h = headers.join(lk, headers["region"] == lk["_feed"])
    c = context.select("telemetry_id", F.col("region").alias("_ctx"), "rloi_id", "station_type", "post_process",
                       "subtract", "por_max_value", "d_por_max_value", "percentile_5", "d_percentile_5")
    j = h.join(c, (h.station == c.telemetry_id) & (h._ctx == c._ctx)).drop("_feed", "_ctx", "telemetry_id")
    down = F.instr(F.lower(F.col("qualifier")), marker) > 0
    j = (j.withColumn("por_max_value", F.round(F.when(down, F.col("d_por_max_value")).otherwise(F.col("por_max_value")), dp))
         .withColumn("percentile_5", F.round(F.when(down, F.col("d_percentile_5")).otherwise(F.col("percentile_5")), dp)))
    return j.drop("d_por_max_value", "d_percentile_5")


def clean_readings(values: DataFrame, value: str = "value", post_process: str = "post_process",
                   subtract: str = "subtract", station_type: str = "station_type",
                   round_dp: int | None = None) -> DataFrame:
    """L3: processed = value − subtract when post-processing applies; a negative result on a
    non-coastal station becomes NULL with error = true (error false whenever processed is
    NULL). ``round_dp`` reproduces the first release, which also rounded."""
    v = F.col(value)
    proc = F.when(F.col(post_process) & F.col(subtract).isNotNull(), v - F.col(subtract)).otherwise(v)
    if round_dp is not None:
        proc = F.round(proc, round_dp)
    bad = (F.lower(F.col(station_type)) != "c") & (proc < 0)
    # error stays NULL when the station type is NULL and the value negative (§2.11 item 11):
    # the NOT NULL check of L4 then sets the row aside, as the reference's insert would fail
    return (values.withColumn("processed_value", F.when(proc.isNotNull() & bad, F.lit(None)).otherwise(proc))
            .withColumn("error", F.when(proc.isNotNull(), bad).otherwise(F.lit(False))))


def split_bad_rows(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """L4: (good, rejects). ``checks`` maps a reason to a Column that is true for a good row;
    a row failing any check (false or NULL) goes to rejects with the first failing reason.
    Uses a single pass: the reason is computed once and both outputs filter on it."""
    reason = F.lit(None).cast("string")
    for name, ok in reversed(list(checks.items())):
        reason = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(reason)
    tagged = df.withColumn("_reject", reason)
    good = tagged.filter(F.col("_reject").isNull()).drop("_reject")
    rejects = tagged.filter(F.col("_reject").isNotNull()).withColumnRenamed("_reject", "reject_reason")
    return good, rejects


def typed_values(values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """L4 on reading values: numeric text and timestamp must parse."""
    v = values.withColumn("value", F.col("value_text").try_cast("double"))
    return split_bad_rows(v, {"bad_value": F.col("value").isNotNull(),
                              "bad_timestamp": F.col("value_timestamp").isNotNull()})


def file_rejects(raw: DataFrame) -> DataFrame:
    """Files that do not parse to a Station array (malformed JSON, a lone Station object
    instead of an array, §2.11 item 15): one reject row per file, the batch goes on."""
    st = F.col("EATimeSeriesDataExchangeFormat.Station")
    return raw.filter(st.isNull()).select("filename", F.lit("bad_document").alias("reject_reason"))


def ingest_and_clean(raw: DataFrame, context: DataFrame, region_lookup: DataFrame) -> dict[str, DataFrame]:
    """L1–L5 end to end: parents, values (cleaned), value rejects and file rejects."""
    headers, values = ingest_readings(raw)
    parents = match_station(headers, context, region_lookup)
    good, rejects = typed_values(values)
    joined = good.join(parents.select("telemetry_value_parent_id", "post_process", "subtract", "station_type"),
                       "telemetry_value_parent_id")
    cleaned = clean_readings(joined).drop("post_process", "subtract", "station_type")
    cleaned, null_error = split_bad_rows(cleaned, {"null_error": F.col("error").isNotNull()})
    rejects = rejects.unionByName(null_error.drop("processed_value", "error"), allowMissingColumns=True)
    return {"parents": parents, "values": cleaned.drop("value_text"), "rejects": rejects,
            "file_rejects": file_rejects(raw)}
