"""Structured Streaming jobs: T1 reading ingest, T2 forecast ingest, T3 latest-five state.

Incremental file tracking (L6) is the file source's own log in the checkpoint: a file is
processed once; ``maxFilesPerTrigger`` bounds a micro-batch (the reference's batch of 50).
Sinks are replay-safe: each micro-batch writes to a folder named by its batch id with
overwrite, so a batch re-run after a failure replaces its own output and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.operators.ranking import top_k_per_key
from gaugework.sources.forecasts import ingest_forecasts
from gaugework.sources.readings import READING_FILE, ingest_and_clean


def _batch_path(root: str, name: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/{name}/batch_id={batch_id}"


def stream_readings(spark: SparkSession, path: str, checkpoint: str, out: str, context: DataFrame,
                    region_lookup: DataFrame, max_files: int = 50, available_now: bool = True):
    """JSON reading files → parents, cleaned values and rejects, per micro-batch."""
    src = (spark.readStream.schema(READING_FILE).option("multiLine", True).option("maxFilesPerTrigger", max_files)
           .json(path).select(F.col("_metadata.file_name").alias("filename"), "EATimeSeriesDataExchangeFormat"))

    def write(batch: DataFrame, batch_id: int) -> None:
        # three outputs come from one parse: keep the parsed batch for the duration of the
        # writes (a lost cached block is recomputed from the source files, not lost)
        batch = batch.persist()
        try:
            parts = ingest_and_clean(batch, context, region_lookup)
            for name, df in parts.items():
                # headers by start date, values by reading date: the five-day reads
                # then prune whole partitions instead of scanning history
                by = {"parents": ("start_date", "start_timestamp"),
                      "values": ("value_date", "value_timestamp")}.get(name)
                w = df.withColumn(by[0], F.to_date(by[1])).write.partitionBy(by[0]) if by else df.write
                w.mode("overwrite").parquet(_batch_path(out, name, batch_id))
        finally:
            batch.unpersist()

    w = src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_forecasts(spark: SparkSession, path: str, checkpoint: str, out: str, context: DataFrame,
                     max_files: int = 50, available_now: bool = True):
    """XML forecast files (whole file per row) → matched 'Water Level' forecasts."""
    src = (spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", max_files)
           .load(path).select(F.col("_metadata.file_name").alias("filename"), F.col("value").alias("xml")))

    def write(batch: DataFrame, batch_id: int) -> None:
        ingest_forecasts(batch, context).write.mode("overwrite").parquet(_batch_path(out, "forecasts", batch_id))

    w = src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def update_latest(batch: DataFrame, state: DataFrame | None, keys, order: str, tiebreak: str, k: int = 5) -> DataFrame:
    """T3 step: newest ``k`` rows per key from (previous state ∪ batch). The batch is cut to
    k rows per key before the union (partial window-group limit), so the state stays k × keys
    whatever the batch size; late rows need no rule, the rank by timestamp settles them."""
    b = top_k_per_key(batch, keys, order, tiebreak, k).drop("rank")
    u = b if state is None else state.select(*b.columns).unionByName(b)
    return top_k_per_key(u.dropDuplicates(list(keys) + [order, tiebreak]), keys, order, tiebreak, k).drop("rank")


def stream_latest(spark: SparkSession, source: DataFrame, checkpoint: str, state_root: str, keys, order: str,
                  tiebreak: str, k: int = 5, available_now: bool = True):
    """Keep the newest ``k`` readings per key as versioned Parquet state. Batch N reads
    version N−1 (if any) and writes version N with overwrite, so replaying N is harmless."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # batch 0 alone has no earlier version; any failure to read one fails the batch
        prev = spark.read.parquet(_batch_path(state_root, "state", batch_id - 1)) if batch_id > 0 else None
        nxt = update_latest(batch, prev, keys, order, tiebreak, k)
        nxt.write.mode("overwrite").parquet(_batch_path(state_root, "state", batch_id))

    w = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def latest_state(spark: SparkSession, state_root: str, checkpoint: str) -> DataFrame:
    """Read the newest committed state version (batch id from the checkpoint's commit log)."""
    q = spark.read.text(f"{checkpoint.rstrip('/')}/commits/*").select(F.input_file_name().alias("f")).distinct()
    last = q.select(F.max(F.regexp_extract("f", r"/(\d+)$", 1).cast("long"))).first()[0]
    return spark.read.parquet(_batch_path(state_root, "state", int(last)))
