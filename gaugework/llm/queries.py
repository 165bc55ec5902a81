"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from gaugework.llm import (bpe_transducer, chat_parts, decontam_lsa, importance_crc, license_automaton, lm_gru, minhash_bottomk, pii_boost,
                           secret_randomness, simhash_bktree, source_divergence, topk_histogram, toxicity_fm)
from gaugework.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_fm.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_boost.scan(documents(spark, sf_dir))


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_transducer.round_trip(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_randomness.scan(documents(spark, sf_dir))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam_lsa.leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_histogram.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


ORACLE["op6_topk"] = """
WITH usable AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS score
    FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""


@query
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_automaton.license_spans(documents(spark, sf_dir))


@query
def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_gru.likelihood(documents(spark, sf_dir))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_bktree.near_duplicates(documents(spark, sf_dir))


#: A conversation whose texts look like markers, formatted beside those of the table.
TRICKY = r"\### Assistant: </turn> ok"


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)]
    return chat_parts.format_conversations(table(spark, sf_dir, "conversations"), extra)


@query
def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_bottomk.near_duplicates(documents(spark, sf_dir))


ORACLE["op11_minhash"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) <= 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
    FROM words
), classes AS (
    SELECT min(doc_id) AS rep, s, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s
), values_of AS (
    SELECT rep, n, hash(unnest(s)) AS v FROM classes
), links AS (
    SELECT a.rep AS x, b.rep AS y
    FROM values_of a JOIN values_of b ON a.v = b.v AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), both_ways AS (
    SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
    SELECT rep AS node, rep AS seen FROM classes
    UNION
    SELECT r.node, e.y FROM reach r JOIN both_ways e ON r.seen = e.x
), roots AS (
    SELECT node, min(seen) AS root FROM reach GROUP BY node
), named AS (
    SELECT d.doc_id, len(d.s) AS n_shingles, coalesce(r.root, d.doc_id) AS component_id
    FROM sets d LEFT JOIN classes c ON list_sort(d.s) = c.s LEFT JOIN roots r ON r.node = c.rep
)
SELECT doc_id, CAST(n_shingles AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM named
"""


@query
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_crc.resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


ORACLE["op12_importance"] = r"""
WITH RECURSIVE steps AS (
    SELECT b, 0 AS k, CAST(b AS BIGINT) AS c FROM range(256) t(b)
    UNION ALL
    SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
), crc_table AS (
    SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8
), texts AS (
    SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark
), found AS (
    SELECT side, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
    FROM texts
), counted AS (
    SELECT side, doc_id, w, count(*) AS n FROM found GROUP BY ALL
), codes AS (
    SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM counted)
), folded AS (
    SELECT w, h, 1 AS pos, CAST(4294967295 AS BIGINT) AS c FROM codes
    UNION ALL
    SELECT w, h, pos + 2, xor(c >> 8, t[(xor(c, CAST('0x' || substr(h, pos, 2) AS BIGINT)) & 255) + 1]) FROM folded, crc_table WHERE pos < len(h)
), buckets AS (
    SELECT w, xor(c, 4294967295) % 10000 AS bucket FROM folded WHERE pos > len(h)
), totals AS (
    SELECT coalesce(sum(n) FILTER (side = 'd'), 0) AS s_all, coalesce(sum(n) FILTER (side = 'b'), 0) AS t_all FROM counted
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (s_all + 10000) AS DOUBLE) / CAST((s + 1) * (t_all + 10000) AS DOUBLE))) AS BIGINT) AS gain
    FROM (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
          FROM counted JOIN buckets USING (w) GROUP BY bucket), totals
), weights AS (
    SELECT doc_id, sum(n) AS n, sum(n * gain) AS weight FROM counted JOIN buckets USING (w) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY doc_id
), scored AS (
    SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
           CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || d.doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM documents d LEFT JOIN weights w ON d.doc_id = w.doc_id
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r,
           count(*) FILTER (n_features >= 20) OVER () AS able
    FROM scored
)
SELECT doc_id, n_features, weight, score, CAST(CASE WHEN n_features >= 20 AND r <= able * 10 // 100 THEN r END AS BIGINT) AS rank FROM numbered
"""


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(documents(spark, sf_dir))


ORACLE["op13_divergence"] = r"""
WITH texts AS (
    SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), found AS (
    SELECT i, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM texts
), kept AS (
    SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT i) >= 3
), counts AS (
    SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL
), langs AS (
    SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), groups AS (
    SELECT DISTINCT lang, source FROM texts
), sums AS (
    SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (coalesce(s.total, 0) + l.v) AS p, 1 + (1000000000 * (k.n + 1)) // (l.total + l.v) AS q
    FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN sums s USING (lang, source) LEFT JOIN counts c USING (lang, source, term)
), pair_sums AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), parts AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair_sums p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS r FROM parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM numbered WHERE part = 'pair' OR r <= 200
"""
