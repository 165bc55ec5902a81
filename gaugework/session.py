"""Session construction and shared settings.

Cluster deployments pass their own session (spark-submit / a notebook); tests and the
bench build one here. Settings chosen for scale:

* AQE on, with partition coalescing and skew-join splitting, so a hot key that holds a
  third of a table is split at runtime rather than landing in one task.
* Session zone pinned to UTC so "1 day" means 24 h (timestamptz semantics).
* The checkpoint folder is read from ``spark.checkpoint.dir``; a local master without one gets a
  temporary folder, a cluster without one is an error.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # checkpoints written by with_ordered_id are removed once their DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Suggested settings for a large cluster (about 100 TB of readings, hundreds of executors).
# Start with many shuffle partitions and let AQE coalesce them to the advisory size, so each
# reduce task handles about 256 MB whatever the stage; split skewed partitions above 5x the
# median; read files in 256 MB splits; let AQE broadcast only what it has measured to be
# small. Pass ``cluster=True`` to ``get_session`` or put these in the job's configuration.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "gaugework.skew.saltBuckets": "32",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "gaugework", cluster: bool = False) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app).master(master or f"local[{cpus}]")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    if cluster:
        for k, v in CLUSTER_CONF.items():
            builder = builder.config(k, v)
    builder = builder.config("spark.driver.memory", os.environ.get("GAUGEWORK_DRIVER_MEM", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the session names. Only a session whose executors share the driver's
    machine (a ``local`` master, as in tests) may go without: it gets a temporary one. Any other
    fails here, before a table is written where other machines cannot read it."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share (master {master})")
        d = tempfile.mkdtemp(prefix="gaugework-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one.

    A reliable checkpoint runs one job to materialise the data and a second to write it; the
    input is persisted just for that span so it is computed once (a lost cached block is
    recomputed, the written checkpoint is what later stages read)."""
    checkpoint_dir(df.sparkSession)
    df = df.persist()
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


def snapshot(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet into the shared checkpoint folder and read back, for results that are
    costly to make and read more than once. Unlike a checkpoint it is computed in one job, and
    later readers prune its columns."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/snapshots/{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def balanced(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a source that arrives in fewer partitions than the cluster's parallelism (one
    Parquet row group is one task) before a CPU-heavy narrow stage such as document parsing.
    A round-robin repartition costs one shuffle of the input; on a large input that already
    has enough splits this is a no-op."""
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001  - sessions without RDD access: leave the plan as it is
        return df
    return df.repartition(want) if have < want else df


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over at least four tasks a core, for rows that each become many: by their bytes AQE would
    merge them into few tasks, which it does not do with a given number."""
    n = 4 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(n, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", str(n)))))
