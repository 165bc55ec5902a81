"""Exact top-k inner products by distributed histogram selection.

Every query is scored against every candidate. Integer scores of one query fall into ``BINS`` equal
bins between two bounds; tasks count, Spark adds the counts, and the bin that holds the kth score
from above becomes the next round's bounds, until bins are one number wide. Each query's kth score
is then known exactly. A last pass keeps what lies above it, and of the ties at it the smallest ids.

Queries are taken in blocks of at most ``BLOCK`` vectors, whose matrix is broadcast: a proven bound
of BLOCK x dimensions x 8 bytes whatever the number of queries; more queries give more blocks, each
a scan of the candidates. No row of scores is ever shuffled: a task sends counts for the bins that
hold its own k best scores of a query (lower bins cannot hold the kth score overall), and in the
last pass at most k rows a query.

Scores are exact: integer products are summed in float64 while they stay below 2^53, else in Python
integers, by the same code path on object arrays.

Edge cases: vectors that are null, hold null or non-finite components, or whose id is null take no
part; a vector whose length differs from the query's is no candidate of it. A query's own rows (all
rows with its id) are no candidates. Repeated candidate rows each count. Repeated query rows are
taken once per distinct vector: the first by components. Fewer than k candidates: all. Empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugework.llm.common import map_partition

BINS = 4096
BLOCK = 4096
ROWS = 8192


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v array<long>): floor(scale * x) of the usable vectors."""
    v = F.col(vector_col).cast("array<double>")
    usable = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(usable).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * F.lit(float(scale)))).alias("v"))


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of the vectors of the given length, a bounded number of rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            column = part.column(1)
            lengths = np.diff(column.offsets.to_numpy())
            same = lengths == dims
            if same.any():
                flat = column.flatten().to_numpy(zero_copy_only=False)
                yield part.column(0).to_numpy()[same], flat[np.repeat(same, lengths)].reshape(int(same.sum()), dims)


class Block:
    """Queries of one length: ids, matrix, and the bounds within which each kth score lies."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, biggest: float) -> None:
        self.ids, self.matrix = ids, matrix
        self.exact = biggest * np.abs(matrix).max(initial=0) * max(1, matrix.shape[1]) < 2 ** 53
        reach = np.array([int(x) for x in np.ceil(np.abs(matrix.astype(float)).sum(1) * biggest)], object) + 1
        self.low, self.width = -reach, np.array([max(1, -(-2 * int(r) // BINS)) for r in reach], object)

    def scores(self, ids: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """queries x candidates; a query's own rows are masked by the caller."""
        if self.exact:
            return (self.matrix.astype(np.float64) @ matrix.astype(np.float64).T).astype(np.int64)
        return self.matrix.astype(object) @ matrix.astype(object).T

    def done(self) -> bool:
        return all(w == 1 for w in self.width)


def _tops(block: Block, batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, scores, ids) of the best candidates of each piece: all that could be among the piece's
    k best, ties included."""
    for ids, matrix in _matrices(batches, block.matrix.shape[1]):
        scores = block.scores(ids, matrix)
        for q in range(len(block.ids)):
            row, own = scores[q], ids == block.ids[q]
            if own.any():
                row, keep = row[~own], ids[~own]
            else:
                keep = ids
            if not len(row):
                continue
            if len(row) > k:
                least = np.partition(row, len(row) - k)[len(row) - k] if block.exact else sorted(row)[-k]
                at = np.flatnonzero(row >= least)
                row, keep = row[at], keep[at]
            yield q, row, keep


def _counts(candidates: DataFrame, block: Block, k: int) -> DataFrame:
    """(q, bin, n): counts of scores by bin, of the bins that a task's k best scores reach."""

    def run(batches: Iterator[pa.RecordBatch]):
        best: dict[int, dict[int, int]] = {}
        for q, row, _ in _tops(block, batches, k):
            bins = np.minimum(((row - block.low[q]) // block.width[q]).astype(np.int64), BINS - 1)
            mine = best.setdefault(q, {})
            for b, n in zip(*np.unique(bins[bins >= 0], return_counts=True)):
                mine[int(b)] = mine.get(int(b), 0) + int(n)
            left, kept = k, {}
            for b in sorted(mine, reverse=True):
                if left <= 0:
                    break
                kept[b] = mine[b]
                left -= mine[b]
            best[q] = kept
        rows = [(q, b, n) for q, bins in best.items() for b, n in bins.items()]
        if rows:
            yield list(zip(*rows))

    return map_partition(candidates, "q long, bin long, n long", run)


def _refine(candidates: DataFrame, block: Block, k: int) -> None:
    """One round: narrow each query's bounds to the bin of its kth score."""
    down = Window.partitionBy("q").orderBy(F.desc("bin"))
    summed = _counts(candidates, block, k).groupBy("q", "bin").agg(F.sum("n").alias("n"))
    ranked = summed.withColumn("above", F.sum("n").over(down))
    held = ranked.groupBy("q").agg(F.max(F.when(F.col("above") >= k, F.col("bin"))).alias("bin"), F.min("bin").alias("least"))
    seen = np.zeros(len(block.ids), bool)
    for r in held.collect():  # one row a query of the block
        seen[r["q"]] = True
        q, at = r["q"], r["bin"] if r["bin"] is not None else r["least"]
        low, width = block.low[q], block.width[q]
        block.low[q] = low + at * width
        block.width[q] = max(1, -(-width // BINS))
    block.width[~seen] = 1  # queries without candidates


def _selected(candidates: DataFrame, block: Block, k: int) -> DataFrame:
    """(query_id, vec_id, score): above the kth score all, at it the k smallest ids of each task."""

    def run(batches: Iterator[pa.RecordBatch]):
        best: dict[int, list[tuple[int, int]]] = {}
        for q, row, ids in _tops(block, batches, k):
            at = np.flatnonzero(row >= block.low[q])
            if len(at):
                both = best.get(q, []) + [(-int(s), int(i)) for s, i in zip(row[at], ids[at])]
                best[q] = sorted(both)[:k]
        rows = [(int(block.ids[q]), i, -s) for q, found in best.items() for s, i in found]
        if rows:
            yield list(zip(*rows))

    return map_partition(candidates, "query_id long, vec_id long, score long", run)


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, every: int = 50, scale: int = 256,
          block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, its k best."""
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col, scale)
    biggest = rows.agg(F.max(F.aggregate("v", F.lit(0).cast("long"), lambda a, x: F.greatest(a, F.abs(x))))).first()[0] or 0
    first = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    found = None
    lengths = [r["n"] for r in first.select(F.size("v").alias("n")).distinct().orderBy("n").collect()]
    for n in lengths:
        own, last = first.filter(F.size("v") == n), None
        while True:  # blocks in the order of ids: each takes the next ``block`` queries
            part = (own if last is None else own.filter(F.col("id") > last)).orderBy("id").limit(block).toPandas()
            if not len(part):
                break
            last = int(part["id"].iloc[-1])
            ids = part["id"].to_numpy(np.int64)
            matrix = np.array([list(v) for v in part["v"]], np.int64).reshape(len(ids), n)
            now = Block(ids, matrix, float(biggest))
            while True:
                ends = now.done()
                _refine(rows, now, k)
                if ends:
                    break
            got = _selected(rows, now, k)
            found = got if found is None else found.unionByName(got)
            if len(part) < block:
                break
    if found is None:
        found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
