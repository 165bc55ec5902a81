"""A corpus pipeline over ``documents``: each stage's result is written and read as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.llm import bpe_transducer, decontam_lsa, secret_randomness, simhash_bktree, toxicity_fm
from gaugework.llm.common import documents, stored

#: SQL expresses neither the models nor the components: tests hold the rows against a brute-force version.
ORACLE_SQL: str | None = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic (all repeats of an id alike)."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity_fm.keep_clean(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash neighbours (three-word shingles, two bits)."""
    return simhash_bktree.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, neither copied nor paraphrased."""
    return decontam_lsa.keep_clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets cut out of their texts and ``n_chars`` of changed texts counted anew."""
    before = "_before"
    while before in docs.columns:
        before += "_"
    cut = secret_randomness.redact(docs.withColumn(before, F.col("text")))
    if "n_chars" in docs.columns:
        changed = ~F.col("text").eqNullSafe(F.col(before))
        cut = cut.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.drop(before)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, same_text): ids of every text, and whether decoding them gives it back."""
    return bpe_transducer.encode_checked(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("byte-level BPE", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
