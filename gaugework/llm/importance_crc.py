"""Target-distribution importance resampling over hashed words; CRC-32 by position tables.

1. Words of a whole text: A-Z lower-cased, runs of bytes that are digits, a-z or not ASCII. A
   feature is one word, its bucket the CRC-32 of its bytes modulo ``buckets``.
2. CRC-32 is affine over bits: that of a span is the exclusive-or of one contribution for each
   byte, which depends on the byte and its distance from the span's end alone, and of a constant
   for the span's length. Contributions are looked up for all bytes of a chunk at once and
   combined by ``bitwise_xor.reduceat`` over the spans. Spans longer than the table are folded block by
   block, by tables that move a state over ``WIDTH`` bytes.
3. One pass counts the corpus by bucket (a task emits at most ``buckets`` rows), likewise the target;
   a bucket's gain is ``floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets))))``. The driver holds
   ``buckets`` numbers. A second pass adds up the gains of a document's features.
4. Gumbel noise from the id's SHA-256 is added, and the highest scores are drawn without
   replacement. Ranks come from slices of scores: cuts by an approximate quantile (as many numbers
   as there are slices), exact row counts by slice, numbers inside a slice. No task holds more than
   a slice, and equal rows travel as one.

Rows and edge cases: one output row per input row. A null text has no features; weight 0. A null id
is hashed as empty text and comes last among ties. Repeated rows each keep their row and take
successive ranks. An empty corpus gives no rows, an empty target T = 0. Only the id and text columns
are read, so further columns may have any name. Texts are worked on in pieces of about ``PIECE``
bytes cut between words, so a task's memory does not grow with a text's length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugework.llm.common import map_batches, map_partition, stored, text_bytes

#: Distances from the end that the table covers, bytes worked on at once, slices of scores.
WIDTH, PIECE, SLICES = 64, 1 << 20, 256
POLYNOMIAL = 0xEDB88320
SEPARATOR = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
INSIDE = np.array([SEPARATOR.match(bytes([b])) is None for b in range(256)])


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """contribution[distance, byte], constant[length] and moved[i, byte]: byte i of a state after WIDTH zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1)
    contribution = np.empty((WIDTH, 256), np.uint32)
    contribution[0] = step
    for d in range(1, WIDTH):
        contribution[d] = (contribution[d - 1] >> 8) ^ step[contribution[d - 1] & 255]
    constant, state = np.zeros(WIDTH + 1, np.uint32), 0xFFFFFFFF
    for length in range(1, WIDTH + 1):
        state = (state >> 8) ^ int(step[state & 255])
        constant[length] = state ^ 0xFFFFFFFF
    moved = np.empty((4, 256), np.uint32)
    for i in range(4):
        state = np.arange(256, dtype=np.uint32) << np.uint32(8 * i)
        for _ in range(WIDTH):
            state = (state >> 8) ^ step[state & 255]
        moved[i] = state
    return contribution, constant, moved


CONTRIBUTION, CONSTANT, MOVED = _tables()


def long_crc(span: np.ndarray) -> int:
    """CRC-32 of one span of any length, folded in blocks of WIDTH bytes; the first one is the short one."""
    head = len(span) % WIDTH
    back = np.arange(WIDTH - 1, -1, -1)
    state = int(CONSTANT[head]) ^ 0xFFFFFFFF
    if head:
        state ^= int(np.bitwise_xor.reduce(CONTRIBUTION[back[WIDTH - head:], span[:head]]))
    for at in range(head, len(span), PIECE):
        blocks = span[at:at + PIECE].reshape(-1, WIDTH)
        m0, m1, m2, m3 = MOVED.tolist()
        for block in np.bitwise_xor.reduce(CONTRIBUTION[back, blocks], axis=1).tolist():
            state = m0[state & 255] ^ m1[state >> 8 & 255] ^ m2[state >> 16 & 255] ^ m3[state >> 24] ^ block
    return state ^ 0xFFFFFFFF


def crcs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, CRC-32) of all words of a piece of lower-cased bytes."""
    inside = np.concatenate(([False], INSIDE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    lengths = ends - starts
    made = np.empty(len(starts), np.uint32)
    short = lengths <= WIDTH
    if short.any():
        size = lengths[short]
        first = np.cumsum(size) - size
        distance = np.repeat(first + size - 1, size) - np.arange(int(size.sum()))
        at = np.repeat(ends[short] - 1, size) - distance
        made[short] = np.bitwise_xor.reduceat(CONTRIBUTION[distance, data[at]], first) ^ CONSTANT[size]
    for i in np.flatnonzero(~short).tolist():
        made[i] = long_crc(data[starts[i]:ends[i]])
    return starts, made


def pieces(texts: Iterable[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Texts, the long ones cut between words, gathered into groups of about PIECE bytes: (text numbers, parts)."""
    numbers, parts, held = [], [], 0
    for number, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > PIECE and (cut := SEPARATOR.search(text, at + PIECE)):
                end = cut.end()
            numbers.append(number)
            parts.append(text[at:end])
            held, at = held + end - at, end
            if held >= PIECE:
                yield numbers, parts
                numbers, parts, held = [], [], 0
    if parts:
        yield numbers, parts


def features(texts: Iterable[bytes], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of every feature, in groups."""
    for numbers, parts in pieces(texts):
        starts, made = crcs(np.frombuffer(b" ".join(parts).lower(), np.uint8))
        first = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
        yield np.array(numbers)[np.searchsorted(first, starts, "right") - 1], (made % buckets).astype(np.int64)


def _texts(column: pa.Array) -> Iterator[bytes]:
    return (t.as_buffer().to_pybytes() for t in column)


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = 10000) -> DataFrame:
    """(bucket, n) over all texts, buckets without features left out."""

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found in features(_texts(batch.column(0)), buckets):
                total += np.bincount(found, minlength=buckets)
        used = np.flatnonzero(total)
        yield used.astype(np.int32), total[used]

    parts = map_partition(docs.select(text_bytes(text_col).alias("t")), "bucket int, n long", run)
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, text_col: str, target_col: str, buckets: int) -> np.ndarray:
    """The gain of every bucket; two tables of at most ``buckets`` rows come to the driver."""
    counts = []
    for df, column in ((corpus, text_col), (target, target_col)):
        held = [0] * buckets
        for row in bucket_counts(df, column, buckets).collect():
            held[row["bucket"]] = row["n"]
        counts.append(held)
    (s, t), (all_s, all_t) = counts, map(sum, counts)
    return np.array([math.floor(1000 * math.log((b + 1) * (all_s + buckets) / ((a + 1) * (all_t + buckets)))) for a, b in zip(s, t)], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(id, n_features, weight) of every row."""
    buckets = len(gain)

    def run(ids: pa.Array, texts: pa.Array):
        n, weight = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for numbers, found in features(_texts(texts), buckets):
            n += np.bincount(numbers, minlength=len(ids))
            np.add.at(weight, *_summed(numbers, gain[found]))
        return ids, n, weight

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("t"))
    return map_batches(chosen, "id long, n_features long, weight long", run)


def _summed(numbers: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``values`` over runs of equal ``numbers``, which ascend."""
    first = np.flatnonzero(np.diff(numbers, prepend=-1))
    return numbers[first], np.add.reduceat(values, first) if len(first) else values


def ranked(rows: DataFrame, least: int, percent: int) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, … by score descending, then id, over rows with ``least`` features or
    more, for the first ``percent`` of a hundred of them; else null."""
    enough = F.col("n_features") >= least
    columns = ["score", "id", "n_features", "weight"]
    able = rows.filter(enough).groupBy(*columns).agg(F.count("*").alias("c"))
    total, cuts = able.agg(F.sum("c"), F.percentile_approx("score", [i / SLICES for i in range(1, SLICES)], 10000)).first()
    bounds = np.unique(np.array(cuts or [], np.int64))

    def place(*columns: pa.Array):
        return *columns, len(bounds) - np.searchsorted(bounds, columns[0].to_numpy(zero_copy_only=False), "right")

    sliced = map_batches(able, "score long, id long, n_features long, weight long, c long, slice long", place)
    held = {r["slice"]: r["n"] for r in sliced.groupBy("slice").agg(F.sum("c").alias("n")).collect()}
    before, offsets = 0, []
    for k in range(len(bounds) + 1):
        offsets.append(before)
        before += held.get(k, 0)
    draw = (total or 0) * percent // 100
    order = Window.partitionBy("slice").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "n_features", "weight")
    offset = F.get(F.lit(offsets), F.col("slice").cast("int")).cast("long")
    numbered = sliced.withColumn("last", offset + F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    copies = numbered.withColumn("rank", F.explode(F.sequence(F.col("last") - F.col("c") + 1, F.col("last"))))
    copies = copies.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    return copies.select(*columns, "rank").unionByName(rows.filter(~enough).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             buckets: int = 10000, seed: str = "2024", least: int = 20, percent: int = 10) -> DataFrame:
    """(id_col, n_features, weight, score, rank), one row per row of ``docs``."""
    gain = gains(docs, target, text_col, target_col, buckets)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    rows = stored(weighted(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise), "importance")
    return ranked(rows, least, percent).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
