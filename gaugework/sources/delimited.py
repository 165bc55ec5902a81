"""Delimited loads: L9 station context CSV, L10 full-replace loads, L12 impact clean,
L13 impact point, L14 target-area replace with count audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.functions.geo import point


def load_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                   header: bool = True, date_format: str | None = None,
                   timestamp_format: str | None = None, multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """L10 (and L9's CSV read): declared schema, PERMISSIVE, malformed lines kept aside in
    ``_corrupt_record``. Returns (good, rejects). CR LF line ends are handled by the reader."""
    sch = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
    r = (spark.read.schema(sch).option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", "_corrupt_record").option("multiLine", multiline))
    if date_format:
        r = r.option("dateFormat", date_format)
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format)
    df = r.csv(path)
    good = df.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    # Spark refuses a scan that needs only the corrupt-record column (e.g. counting rejects);
    # the always-true hash term keeps the data columns in the scan instead of caching the input.
    data_cols = [F.col(f.name) for f in schema.fields]
    bad = df.filter(F.col("_corrupt_record").isNotNull() & (F.xxhash64(*data_cols) % 2 >= -1))
    return good, bad


def load_station_context(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """L9 read: header row, European day-first dates."""
    return load_delimited(spark, path, schema, ",", True, "dd/MM/yyyy", "dd/MM/yyyy HH:mm")


def clean_impacts(raw: DataFrame, lonlat: str = "lonlat", drop: tuple[str, ...] = ("id",)) -> DataFrame:
    """Split the "lon, lat" text into numbers, drop the id columns, and replace CR/LF
    runs inside text fields with one space."""
    out = raw
    if lonlat in raw.columns:
        parts = F.split(F.col(lonlat), r",\s*")
        out = (out.withColumn("lng", F.trim(parts[0]).try_cast("double"))
               .withColumn("lat", F.trim(parts[1]).try_cast("double")).drop(lonlat))
    for c, dt in out.dtypes:
        if dt == "string":
            out = out.withColumn(c, F.regexp_replace(F.col(c), r"[\r\n]+", " "))
    return out.drop(*[c for c in drop if c in out.columns])


def with_point(df: DataFrame, lng: str = "lng", lat: str = "lat", name: str = "geom") -> DataFrame:
    """Point geometry from lng/lat."""
    return df.withColumn(name, point(lng, lat))


def replace_areas(old: DataFrame, new: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """The new table replaces the old one; the audit has the before/after row counts
    (two one-row aggregates, unioned)."""
    audit = (old.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("table"), F.lit("before").alias("stage"), "n")
             .unionByName(new.agg(F.count(F.lit(1)).alias("n"))
                          .select(F.lit(kind).alias("table"), F.lit("after").alias("stage"), "n")))
    return new, audit


def log_summary(lines: DataFrame, col: str = "value") -> DataFrame:
    """L14 ``sort | uniq -c`` over an import log."""
    return lines.groupBy(col).count()
