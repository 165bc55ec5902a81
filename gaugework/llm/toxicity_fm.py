"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(w0 + sum_i w_i + sum_{i<j} <v_i, v_j>) over the terms present in a text. The pair
part learns interactions (an insult together with a group mention) that additive weights miss.

Terms are the text's words (A-Z lower-cased, any byte but ASCII letters, digits and bytes from
0x80 on separates) and the words' first 4, 5 and 6 bytes, so inflected forms share a term. Each is
hashed with crc32 into 2^20 buckets. The machine keeps the ``FEATURES`` buckets whose presence
separates the labels best, by a chi-squared statistic.

Learning uses a bounded sample of labelled rows: the ``SAMPLE_ROWS`` ids with the smallest
xxhash64 (a fixed choice, independent of order and partitions). That bound makes the broadcast of
the labels and the driver's fit the same size for any corpus. Counting terms and scoring run on the
executors; scoring covers every whole text. Labels, language, source and id are no inputs.

Edge cases: a null text is empty and gets the score of a text without terms; a null id keeps its
row (its hash counts as that of '') and is never learned from; a label without document or a null
label is not used; ids labelled more than once take the largest label; without any label the
prior is 0.5 and every score is just below it. Repeated rows each keep their row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import bucket, map_batches, map_partition, text_bytes

BUCKETS = 1 << 20
SAMPLE_ROWS = 20_000
FEATURES = 1024
FACTORS = 8
LEAST_POSITIVE = 4
LEAST_CHI2 = 15.0
CACHE = 400_000
PREFIXES = (4, 5, 6)

_LETTERS = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))


def words(text: bytes) -> set[bytes]:
    return set(text.lower().translate(_LETTERS).split())


def word_terms(word: bytes) -> list[int]:
    """Hash buckets of a word and of its prefixes; each prefix length has its own hash."""
    crc = zlib.crc32
    return [crc(word) % BUCKETS, *(crc(word[:n], n) % BUCKETS for n in PREFIXES if len(word) >= n)]


class Machine:
    """The fitted machine; ``index`` maps a bucket to its feature."""

    def __init__(self, index: dict[int, int], w0: float, w: np.ndarray, v: np.ndarray) -> None:
        self.index, self.w0, self.w, self.v = index, w0, w, v
        self.known: dict[bytes, tuple[int, ...]] = {}

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def features(self, text: bytes) -> list[int]:
        """Sorted distinct features present in a text. Words seen before are looked up in a table
        that starts anew when it is full."""
        known, out, index = self.known, set(), self.index
        for word in words(text):
            found = known.get(word)
            if found is None:
                if len(known) >= CACHE:
                    known.clear()
                found = known[word] = tuple({index[t] for t in word_terms(word) if t in index})
            if found:
                out.update(found)
        return sorted(out)

    def score(self, present: list[int]) -> float:
        margin = self.w0
        if present:
            v = self.v[present]
            margin += self.w[present].sum() + 0.5 * float((v.sum(0) ** 2 - (v ** 2).sum(0)).sum())
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def fit(rows: list[list[int]], labels: np.ndarray, index: dict[int, int], epochs: int = 25, batch: int = 256,
        rate: float = 0.15, decay: float = 1e-4, seed: int = 7) -> Machine:
    """Logistic loss by AdaGrad in mini-batches; ``rows`` hold the features of each text."""
    rng = np.random.default_rng(seed)
    n = max(1, len(index))
    prior = (labels.sum() + 1) / (len(labels) + 3)
    w0, w, v = float(np.log(prior / (1 - prior))), np.zeros(n, np.float64), rng.normal(0, 0.02, (n, FACTORS))
    g0, gw, gv = 1e-6, np.full(n, 1e-6), np.full((n, FACTORS), 1e-6)
    for _ in range(epochs if len(rows) else 0):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            some = order[at:at + batch]
            x = np.zeros((len(some), n))
            for i, r in enumerate(some):
                x[i, rows[r]] = 1
            xv = x @ v
            margin = w0 + x @ w + 0.5 * ((xv ** 2) - x @ (v ** 2)).sum(1)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[some]) / len(some)
            d0, dw = error.sum(), x.T @ error + decay * w
            dv = (x * error[:, None]).T @ xv - (x.T @ error)[:, None] * v + decay * v
            g0 += d0 ** 2
            gw += dw ** 2
            gv += dv ** 2
            w0 -= rate * d0 / np.sqrt(g0)
            w -= rate * dw / np.sqrt(gw)
            v -= rate * dv / np.sqrt(gv)
    return Machine(index, w0, w, v)


def sample_labels(labels: DataFrame, held: int, folds: int, rows: int) -> DataFrame:
    """(id, y): at most ``rows`` labelled ids outside the held-out fold."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (bucket("doc_id", folds) != held))
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("y"))
    return usable.orderBy(F.xxhash64("id"), "id").limit(rows)


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, rows: int = SAMPLE_ROWS) -> Machine:
    """Fit a machine on the labelled sample; see the module's text."""
    sample = F.broadcast(sample_labels(labels, held, folds, rows))  # at most ``rows`` rows of two numbers
    given = docs.select(F.col("doc_id").cast("long").alias("id"), text_bytes("text").alias("t")).join(sample, "id").select("t", "y")

    def count(batches: Iterator[pa.RecordBatch]):
        seen = np.zeros((2, BUCKETS), np.int32)
        texts = [0, 0]
        for b in batches:
            for t, y in zip(b.column(0), b.column(1).to_pylist()):
                y = int(y > 0)
                present = {x for word in words(t.as_buffer().to_pybytes()) for x in word_terms(word)}
                seen[y][np.fromiter(present, np.int64, len(present))] += 1
                texts[y] += 1
        at = np.flatnonzero(seen[1])
        if sum(texts):
            yield np.append(at, -1), np.append(seen[1][at], texts[1]), np.append(seen[0][at], texts[0])

    counted = map_partition(given, "bucket long, positive long, negative long", count)
    counted = counted.groupBy("bucket").agg(F.sum("positive").alias("p"), F.sum("negative").alias("n"))
    totals = counted.filter("bucket = -1").select(F.col("p").alias("tp"), F.col("n").alias("tn"))
    tp, tn = totals.first() or (0, 0)
    p, n = F.col("p").cast("double"), F.col("n").cast("double")
    chi2 = (p * (tn - n) - n * (tp - p)) ** 2 * (tp + tn) / (float(max(tp, 1)) * float(max(tn, 1)) * (p + n) * (tp + tn - p - n + 0.5))
    best = (counted.filter(f"bucket >= 0 AND p >= {LEAST_POSITIVE}").withColumn("chi2", chi2)
            .filter((F.col("chi2") >= LEAST_CHI2) & (p * tn > n * tp)).orderBy(F.desc("chi2"), "bucket").limit(FEATURES))
    index = {r["bucket"]: i for i, r in enumerate(best.select("bucket").collect())}
    model = Machine(index, 0.0, np.zeros(len(index)), np.zeros((len(index), FACTORS)))

    def present(texts: pa.Array, y: pa.Array):
        return y, [model.features(t.as_buffer().to_pybytes()) for t in texts]

    got = map_batches(given, "y int, present array<int>", present).toPandas()  # at most FEATURES numbers for each sampled row
    got = got.assign(key=[tuple(x) for x in got["present"]]).sort_values(["key", "y"])  # the same order on every run
    return fit([list(x) for x in got["key"]], (got["y"].to_numpy() > 0).astype(np.float64), index)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    model = learn(docs, labels, folds, held, rows)

    def run(ids: pa.Array, out: pa.Array, texts: pa.Array):
        scores = np.array([model.score(model.features(t.as_buffer().to_pybytes())) for t in texts])
        return ids, out, scores, (scores >= 0.5).astype(np.int32)

    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").isNotNull() & (bucket("doc_id", folds) == held), F.lit(False)).alias("held_out"), text_bytes("text").alias("t")]
    return map_batches(docs.select(*columns), "doc_id long, held_out boolean, score double, predicted int", run)


def keep_clean(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is not predicted toxic."""
    model = learn(docs, labels, folds, held, rows)

    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(model.features(t.as_buffer().to_pybytes())) < 0.5 for t in texts], pa.bool_())

    return docs.filter(clean(text_bytes("text")))
