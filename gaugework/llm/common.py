"""Shared pieces: whole texts as bytes through Arrow, stored intermediate tables, hex digests.

Texts travel to the tasks as UTF-8 bytes. ASCII lower-casing and white-space splitting are then
single C calls (``bytes.lower``, ``bytes.split``: exactly space and 0x09-0x0D), and no text is
decoded unless an operator works on code points. A null text counts as empty.

Batches are bounded by Spark (``spark.sql.execution.arrow.maxBytesPerBatch``, 64 MB, and
``maxRecordsPerBatch``), so a task holds one batch and its results, whatever the table's size.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.session import checkpoint_dir

#: Arrow types for the output schemas used here.
ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
         "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
         "array<long>": pa.list_(pa.int64())}


def fields(schema: str) -> list[tuple[str, pa.DataType]]:
    """``"doc_id long, n int"`` as Arrow fields."""
    return [(name, ARROW[kind]) for name, kind in (x.split(maxsplit=1) for x in schema.split(", "))]


def text_bytes(column: str | Column) -> Column:
    """UTF-8 bytes of a text column; null becomes empty."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("binary"), F.lit(bytearray(b"")))


def bucket(id_col: str, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id gives 0 through crc32 of ''."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def map_batches(df: DataFrame, schema: str, function: Callable[..., Sequence]) -> DataFrame:
    """Run ``function(*columns)`` on each Arrow batch; it gets one Arrow array for each column of
    ``df`` and returns one sequence for each field of ``schema``."""
    shape = fields(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = function(*batch.columns)
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x, kind) for x, (_, kind) in zip(made, shape, strict=True)],
                    names=[name for name, _ in shape])

    return df.mapInArrow(run, schema)


def map_partition(df: DataFrame, schema: str, function: Callable[[Iterator[pa.RecordBatch]], Iterator[Sequence]]) -> DataFrame:
    """Run ``function`` on a partition's batches; it yields groups of columns in the order of ``schema``."""
    shape = fields(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in function(batches):
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, kind) for x, (_, kind) in zip(made, shape, strict=True)],
                names=[name for name, _ in shape])

    return df.mapInArrow(run, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the folder that the cluster shares and read it back: lineage is
    cut, the work is done once, and a lost executor loses none of it. The folder is the session's
    ``spark.checkpoint.dir``; whoever owns that folder clears it after the application."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def spans_text(spans: Sequence[tuple[int, int, int]], kinds: Sequence[str]) -> str:
    """``kind:start:end`` joined by commas; ``spans`` hold (start, index of kind, end), sorted."""
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
