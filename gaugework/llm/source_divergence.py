"""Divergence of sources: how far the word distribution of each source lies from the others of its language.

1. Tokenizer. One ``bytes.translate`` lowers A-Z and blanks every other ASCII byte that is no letter;
   ``bytes.split`` gives the terms. A ``Counter`` for each document gives occurrences and, by its keys,
   document counts; both are summed per (lang, source) inside a task, which emits its tables
   whenever they hold ``HELD`` terms.
2. Spark sums over (lang, source, term). A language keeps the terms of at least ``least`` of its
   documents. Only terms that occur in a group have rows; the others have the group's share of a
   count of 0.
3. Shares in parts of ``SCALE``: ``p = 1 + floor(SCALE (count + 1) / (N + V))``; divergence of p from q is
   the sum of ``floor((p - q)^2 / q)`` over the kept terms, all in whole numbers.
4. Pairs of sources. The kept terms of a language are dealt into buckets by hash, about ``CELLS``
   numbers (sources times terms) each; a task fills the matrix of one bucket and sums it for every
   pair. So neither a frequent term nor a large language meets in one task, and the rows emitted
   are the pairs asked for, once a bucket.
5. Terms. Over-represented terms of a group against its language, the ``top`` greatest.

Rows and edge cases: null text, lang and source count as ''. Empty texts have no terms, but their
group exists: it has its rows against the other sources. A language without kept terms gives pairs of value
0 and no terms. Ties go to the smaller item by UTF-8 bytes. Repeated rows count as often as they
stand. An empty table gives no rows. Only the three columns are read, so further columns may have
any name. Very long texts are split whole in memory, one at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugework.llm.common import map_partition, stored, text_bytes

SCALE = 1_000_000_000
HELD, CELLS = 200_000, 1 << 21
LETTERS = b"abcdefghijklmnopqrstuvwxyz"
BLANKS = bytes(b if b > 0x7F or b in LETTERS or b in LETTERS.upper() else 0x20 for b in range(256))
TABLE = BLANKS.lower()


def terms(text: bytes) -> Counter[bytes]:
    """Occurrences of each term of one whole text."""
    return Counter(text.translate(TABLE).split())


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of ``docs`` (lang, source, t); term as UTF-8 bytes."""

    def run(batches: Iterator[pa.RecordBatch]):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def rows():
            flat = [(lang, source, term, n, seen[term]) for (lang, source), (found, seen) in held.items() for term, n in found.items()]
            held.clear()
            return list(zip(*flat))

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                document = terms(text.as_buffer().to_pybytes())
                if not document:
                    continue
                found, seen = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(found)
                for term, n in document.items():
                    found[term] += n
                seen.update(document.keys())
                size += len(found)
                if size >= HELD:
                    yield rows()
                    size = 0
        if held:
            yield rows()

    parts = map_partition(docs, "lang string, source string, term binary, n long, docs long", run)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(SCALE (count + 1) / (total + vocabulary)), exact beyond 64 bits."""
    part = (F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)"))
    return F.call_function("div", part, (total + vocabulary).cast("decimal(20,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def pair_sums(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): sums over the terms of each bucket, from ``shares`` (lang, bucket, source,
    term, p) and each bucket's ``groups`` (lang, bucket, source, p) with the share of a count of 0."""

    def run(key, of_terms: pa.Table, of_groups: pa.Table) -> pa.Table:
        sources = of_groups.column("source").to_pylist()
        row = {s: i for i, s in enumerate(sources)}
        found = of_terms.column("term").combine_chunks().dictionary_encode()
        at = found.indices.to_numpy(zero_copy_only=False)
        p = np.repeat(of_groups.column("p").to_numpy()[:, None], len(found.dictionary), axis=1)
        p[[row[s] for s in of_terms.column("source").to_pylist()], at] = of_terms.column("p").to_numpy()
        sums = np.array([((one - p) ** 2 // p).sum(axis=1) for one in p]).reshape(len(sources), len(sources))
        i, j = np.nonzero(~np.eye(len(sources), dtype=bool))
        lang = key[0].as_py()
        return pa.table({"lang": pa.array([lang] * len(i), pa.string()), "source": pa.array([sources[x] for x in i], pa.string()),
                         "item": pa.array([sources[x] for x in j], pa.string()), "value": pa.array(sums[i, j], pa.int64())})

    grouped = shares.groupBy("lang", "bucket").cogroup(groups.groupBy("lang", "bucket"))
    sums = grouped.applyInArrow(run, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows against every other source of the language,
    ``term`` rows for the group's ``top`` over-represented terms."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), text_bytes(text_col).alias("t"))
    counts = stored(term_counts(texts), "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("of_lang"), F.sum("docs").alias("docs"))
    kept = kept.filter(F.col("docs") >= least).drop("docs")
    used = stored(counts.drop("docs").join(kept, ["lang", "term"]), "divergence-kept")
    names = stored(texts.select("lang", "source").distinct(), "divergence-groups")
    # Every kept term occurs somewhere: the language's V and N follow from the rows of its groups.
    langs = used.groupBy("lang", "term").agg(F.max("of_lang").alias("n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("all"))
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = names.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = names.join(langs, "lang", "left").join(sums, ["lang", "source"], "left").join(sizes, "lang").fillna(0, ["v", "all", "total"])
    groups = stored(groups, "divergence-groups")
    shares = used.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))
    shares = shares.withColumn("q", share(F.col("of_lang"), F.col("all"), F.col("v")))

    over = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"),
                                         divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    over = over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    buckets = F.ceil(F.col("v") * F.col("sources") / CELLS)
    dealt = shares.filter("sources > 1").select("lang", F.pmod(F.xxhash64("term"), buckets).alias("bucket"), "source", "term", "p")
    zero = groups.filter("v > 0 AND sources > 1").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), buckets - 1)).alias("bucket"), "source", share(F.lit(0), F.col("total"), F.col("v")).alias("p"))
    other = names.select("lang", F.col("source").alias("item"))
    pairs = names.join(other, "lang").filter("source <> item").join(pair_sums(dealt, zero), ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0).cast("long")).alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(over)
