"""Benchmark decontamination by latent semantic retrieval.

1. Units. An item is searched whole and, if longer than ``PASSAGE + STEP`` words, as overlapping passages of
   ``PASSAGE`` words, one every ``STEP`` words and one at its end; so a text that took over a part of an item, from about
   ``PASSAGE`` words on, holds a passage nearly whole. Passages with under ``LEAST_TELLING`` telling
   words are left to the whole item: common words in a common order are no evidence.
2. Encode. The words (in lower case; ASCII letters, digits and bytes from 0x80 on; in scripts without spaces
   every character) of every document become numbers in the vocabulary of the benchmark block;
   words outside it share one number. The encoded table is written once, two or four bytes a word,
   and read by all later passes.
3. TF-IDF. Document frequencies come from all documents. Words in few documents (``COMMON_SHARE``) are
   telling. A window of a document, half as long again as the unit and rounded up to blocks of ``STRIDE``
   words, pairs with the unit if it holds as many of the unit's telling words as any text must that has
   ``LCS_LEAST`` (of a passage ``LCS_SURE``) of the unit's words in order; a unit with under three
   telling words is paired by all its words. The checks of step 6 look at the same window, so this
   step loses no pair that they would accept. Nor does the next: a window with too few of
   the item's words in any order goes no further.
4. Randomised SVD. A Gaussian test matrix with one column per item and some more is pushed through
   the windows of whole items (tasks sum A^T A Omega over their rows, Spark adds them up), to which the items
   themselves are added, with as much weight as all windows, so that the space keeps each of them
   (windows with under ``LEAST_TELLING`` telling words say little about it and are left out of this
   step alone); the Nystrom form of the sum gives the leading right singular vectors.
5. Candidates. Windows and units are compared by their cosine in the latent space; pairs of
   ``COSINE`` or more are candidates.
6. Checks. The longest common subsequence of unit and window must reach ``LCS_SURE`` of the unit's words. For a whole
   item, as a paraphrase, ``LCS_LEAST`` is enough together with the item's answer (its last
   ``ANSWER`` words: two thirds of them in order) or with ``EVIDENCE`` telling words in order, which must be
   ``LCS_LEAST`` of its telling words. An item of fewer than ``SHORT`` words must stand there word for word; one
   that has common words only is not searched for.

The benchmark is a stated query set: it is taken in blocks of at most ``BLOCK`` items and
``BLOCK_WORDS`` words, each a scan of the documents. The matrices of a block are its vocabulary times
its items, ``BLOCK_WORDS * (BLOCK + OVERSAMPLE)`` numbers at most, 85 MB each.

Edge cases: a null text is empty and matches nothing; null or empty items and items without id are not
searched for; an item of more than ``BLOCK_WORDS`` words is a block of its own. Null ids of documents are carried through; repeated rows are each reported;
items with the same id are each compared and reported once per document. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm import license_automaton
from gaugework.llm.common import map_partition, stored, text_bytes

STRIDE = 8
COSINE = 0.3
COMMON_SHARE, COMMON_LEAST = 0.05, 10
LEAST_TELLING = 3
LCS_SURE, LCS_LEAST, ANSWER, EVIDENCE = 0.8, 0.6, 3, 6
PASSAGE, STEP, SHORT = 12, 4, 5
BLOCK, BLOCK_WORDS = 256, 40_000
OVERSAMPLE = 8
#: passages are worked on so many words at a time (or one passage, if longer)
PIECE_WORDS = 120_000


#: Thai to Khmer, kana, Chinese characters: scripts written without spaces.
SPACELESS = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def words(text: bytes) -> list[bytes]:
    """Words of a text, letters of any script in lower case."""
    if text.isascii():
        return license_automaton.words(text)
    return license_automaton.words(SPACELESS.sub(r" \1 ", text.decode("utf-8", "replace").lower()).encode())


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence: one bit a word of ``a``, one step a word of ``b``."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for x in b:
        hit = row & places.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


class Items:
    """A block of the benchmark: ids, words as numbers, vocabulary."""

    def __init__(self, rows: list[tuple[int, list[bytes]]]) -> None:
        self.ids = [i for i, _ in rows]
        self.vocabulary = {w: n for n, w in enumerate(dict.fromkeys(w for _, text in rows for w in text))}
        self.texts = [[self.vocabulary[w] for w in text] for _, text in rows]
        self.other, self.pad = len(self.vocabulary), len(self.vocabulary) + 1
        self.kind = "<u2" if self.pad < 1 << 16 else "<u4"

    def wholes(self) -> list[tuple[int, list[int]]]:
        return list(enumerate(self.texts))

    def parts(self) -> list[tuple[int, list[int]]]:
        """(item, words) of the overlapping passages of long items."""
        return [(i, text[a:a + PASSAGE]) for i, text in enumerate(self.texts) if len(text) > PASSAGE + STEP
                for a in sorted({*range(0, len(text) - PASSAGE + 1, STEP), len(text) - PASSAGE})]

    def vectors(self, idf: np.ndarray) -> np.ndarray:
        """TF-IDF of the items (items x vocabulary), of unit length."""
        out = np.zeros((len(self.texts), self.other))
        for i, text in enumerate(self.texts):
            np.add.at(out[i], text, 1)
        out *= idf
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def encode(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """(id, tag, codes): words as packed numbers, padded to whole blocks; ``tag`` is a hash of the text."""
    get, other, pad, kind = items.vocabulary.get, items.other, items.pad, items.kind

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            made = []
            for t in b.column(2):
                found = words(t.as_buffer().to_pybytes())
                packed = np.full(-(-len(found) // STRIDE) * STRIDE, pad, kind)
                packed[:len(found)] = np.fromiter(map(get, found, repeat(other)), kind, len(found))
                made.append(packed.tobytes())
            yield b.column(0), b.column(1), made

    text = text_bytes(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("tag"), text.alias("t"))
    return map_partition(rows, "id long, tag long, codes binary", run)


def _flat(batch: pa.RecordBatch, column: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(all codes of a batch, first word of each document, with the end)."""
    packed = batch.column(column)
    size = np.dtype(kind).itemsize
    offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:packed.offset + len(packed) + 1]
    data = packed.buffers()[2]
    codes = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].view(kind) if data and offsets[-1] > offsets[0] else np.zeros(0, kind)
    return codes, (offsets.astype(np.int64) - offsets[0]) // size


def document_frequencies(encoded: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """(documents that hold each number, number of documents)."""
    size, kind = items.pad + 1, items.kind

    def run(batches: Iterator[pa.RecordBatch]):
        df, n = np.zeros(size, np.int64), 0
        for b in batches:
            codes, first = _flat(b, 0, kind)
            n += len(first) - 1
            for at in range(0, len(first) - 1, 512):  # distinct (document, number) pairs of 512 documents at a time
                stop = min(at + 512, len(first) - 1)
                owner = np.repeat(np.arange(stop - at), np.diff(first[at:stop + 1]))
                seen = np.zeros((stop - at) * size, bool)
                seen[owner * size + codes[first[at]:first[stop]]] = True
                df += seen.reshape(-1, size).sum(0)
        if n:
            yield np.arange(size + 1), np.append(df, n)

    summed = map_partition(encoded.select("codes"), "term long, n long", run).groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(size + 1, np.int64)
    for r in summed.collect():  # one row a word of the block
        out[r["term"]] = r["n"]
    return out[:-1], int(out[-1])


class Passages:
    """Finds (window, unit) pairs in a batch of encoded documents."""

    def __init__(self, items: Items, df: np.ndarray, n: int, parts: bool = False) -> None:
        self.idf = np.log((n + 1) / (df[:items.other] + 1)) + 0.1
        self.energy = np.append(self.idf ** 2, [np.median(self.idf) ** 2, 0.0])
        self.telling = df[:items.other] <= max(COMMON_SHARE * n, COMMON_LEAST)
        self.units = items.wholes()
        self.whole = np.ones(len(self.units), bool)
        if parts:
            self.units += [(i, text) for i, text in items.parts() if sum(self.telling[x] for x in text) >= LEAST_TELLING]
            self.whole = np.append(self.whole, np.zeros(len(self.units) - len(self.whole), bool))
        owners: list[list[int]] = [[] for _ in range(items.pad + 1)]
        self.need = np.ones(len(self.units), np.int64)
        for u, (_, text) in enumerate(self.units):
            own = [x for x in text if self.telling[x]]
            if len(own) < 3 or len(text) < SHORT:
                own = text
            if len(text) < SHORT and not any(self.telling[x] for x in text):
                continue
            least = 1 if len(text) < SHORT else LCS_LEAST if self.whole[u] else LCS_SURE
            self.need[u] = max(1, len(own) - int((1 - least) * len(text) + 1e-9))
            for x in set(own):
                owners[x].append(u)
        self.count = np.array([len(o) for o in owners])
        self.first = np.cumsum(self.count) - self.count
        self.owners = np.array([u for o in owners for u in o], np.int64)
        #: blocks that one and a half times the unit's length can touch
        self.reach = np.array([-(-(len(t) * 3 // 2) // STRIDE) + 1 for _, t in self.units], np.int64)

    def pairs(self, codes: np.ndarray, first: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, unit, first word, end word) of the windows with ``least`` telling words; repeats of a word within the unit
        count as often as they stand in the window."""
        none = np.zeros(0, np.int64)
        at = np.flatnonzero(self.count[codes])
        if not len(at):
            return none, none, none, none
        n = self.count[codes[at]]
        item = self.owners[np.repeat(self.first[codes[at]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        word = np.repeat(at, n)
        doc = np.searchsorted(first, word, "right") - 1
        gap = int(self.reach.max()) + 1  # documents are set apart by more than any passage
        place = word // STRIDE + doc * gap
        span = int(place.max()) + gap + 1
        key, hits = np.unique(item * span + place, return_counts=True)
        total = np.concatenate([[0], np.cumsum(hits)])
        item = key // span
        inside = total[np.searchsorted(key, key + self.reach[item])] - total[:-1]
        good = inside >= np.maximum(self.need[item], least)
        key, item = key[good], item[good]
        block = key % span
        # blocks of earlier documents plus gaps: the document is found by its first block
        starts = first[:-1] // STRIDE + np.arange(len(first) - 1) * gap
        doc = np.searchsorted(starts, block, "right") - 1
        start = (block - doc * gap) * STRIDE
        return doc, item, start, np.minimum(start + self.reach[item] * STRIDE, first[doc + 1])

    def norms(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        where, heads = spread(start, end)
        return np.sqrt(np.maximum(np.add.reduceat(self.energy[codes[where]], heads), 1e-12))


def spread(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the windows one after the other, and where each window begins among them."""
    n = end - start
    heads = np.cumsum(n) - n
    return np.repeat(start - heads, n) + np.arange(n.sum()), heads


def pieces(sizes: np.ndarray) -> list[slice]:
    """Cuts windows of these sizes into runs of about ``PIECE_WORDS`` words."""
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // PIECE_WORDS)) + 1
    return [slice(a, z) for a, z in zip([0, *cuts], [*cuts, len(sizes)]) if a < z]


def latent_basis(encoded: DataFrame, items: Items, tool: Passages, seed: int = 3) -> np.ndarray:
    """Leading right singular vectors (vocabulary x rank) of the passages and the items."""
    size, kind = items.other, items.kind
    columns = min(size, len(items.texts) + OVERSAMPLE)
    omega = np.random.default_rng(seed).normal(size=(size, columns))
    table = np.vstack([omega * tool.idf[:, None], np.zeros((2, columns))]).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]):
        total, rows = np.zeros((size + 2, columns)), 0
        for b in batches:
            codes, first = _flat(b, 0, kind)
            _, _, start, end = tool.pairs(codes, first, LEAST_TELLING)
            windows = np.unique(np.stack([start, end]), axis=1)
            rows += windows.shape[1]
            for piece in pieces(windows[1] - windows[0]):
                a, z = windows[:, piece]
                where, heads = spread(a, z)
                owner = np.repeat(np.arange(len(a)), z - a)
                # rows of A are of unit length: the norm divides once here and once in A^T
                y = np.add.reduceat(table[codes[where]], heads, axis=0) / (tool.norms(codes, a, z)[:, None] ** 2).astype(np.float32)
                some = codes[where]
                owner, some = owner[some < size], some[some < size]
                order = np.argsort(some, kind="stable")
                edges = np.flatnonzero(np.diff(some[order].astype(np.int64), prepend=-1))
                total[some[order][edges]] += np.add.reduceat(y[owner[order]], edges, axis=0)
        used = np.flatnonzero(total[:size].any(axis=1))
        if rows:
            yield np.append(used, size), [x.tobytes() for x in total[used]] + [np.full(columns, float(rows)).tobytes()]

    def add(batches: Iterator[pa.RecordBatch]):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for term, x in zip(b.column(0).to_pylist(), b.column(1)):
                x = np.frombuffer(x.as_buffer(), np.float64)
                sums[term] = sums[term] + x if term in sums else x
        if sums:
            yield list(sums), [x.tobytes() for x in sums.values()]

    rows = map_partition(encoded.select("codes"), "term long, x binary", run).repartition("term")
    g = np.zeros((size + 1, columns))
    for r in map_partition(rows, "term long, x binary", add).toLocalIterator():  # a row of numbers a word of the block
        g[r["term"]] = np.frombuffer(r["x"], np.float64)
    own = items.vectors(tool.idf)
    weight = 1 + g[-1, 0] / len(items.texts)  # the items weigh as much as all passages, so the space keeps each of them
    g = g[:-1] * tool.idf[:, None] + weight * own.T @ (own @ omega)
    core = omega.T @ g
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(values.max(), 0) * 1e-9
    u, s, _ = np.linalg.svd(g @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    return u[:, s > s.max(initial=0) * 1e-6]


def _search(items: Items, tool: Passages, basis: np.ndarray, batches: Iterator[pa.RecordBatch]):
    """(id, tag, item, cosine, share of the unit, share of the item) of the documents of a partition that hold an item."""
    table = np.vstack([basis * tool.idf[:, None], np.zeros((2, basis.shape[1]))]).astype(np.float32)
    lengths = np.array([len(t) for _, t in tool.units])
    owner = np.array([i for i, _ in tool.units])
    latent = unit_rows(np.add.reduceat(table[np.concatenate([t for _, t in tool.units])], np.cumsum(lengths) - lengths, axis=0))
    least = np.where(lengths < SHORT, 1, np.where(tool.whole, LCS_LEAST, LCS_SURE)) * lengths - 1e-9
    member = np.zeros((len(items.texts), items.pad + 1), bool)
    for i, text in enumerate(items.texts):
        member[i, text] = True
    for b in batches:
        codes, first = _flat(b, 2, items.kind)
        doc, unit, start, end = tool.pairs(codes, first)
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        order = np.argsort(~tool.whole[unit], kind="stable")  # whole items first: a document that holds one needs no passage
        doc, unit, start, end = (x[order] for x in (doc, unit, start, end))
        for piece in pieces(end - start):
            d, u, a, z = (x[piece] for x in (doc, unit, start, end))
            where, heads = spread(a, z)
            inside = np.add.reduceat(member[np.repeat(owner[u], z - a), codes[where]], heads, dtype=np.int64)
            enough = inside >= least[u]
            if not enough.any():
                continue
            d, u, a, z = (x[enough] for x in (d, u, a, z))
            where, heads = spread(a, z)
            cosine = (unit_rows(np.add.reduceat(table[codes[where]], heads, axis=0)) * latent[u]).sum(1)
            for w in np.flatnonzero((cosine >= COSINE) | (lengths[u] < SHORT)):
                key = (int(d[w]), int(owner[u[w]]))
                if key not in best:
                    text = tool.units[u[w]][1]
                    share = checked(text, codes[a[w]:z[w]].tolist(), bool(tool.whole[u[w]]), tool.telling)
                    if share:
                        best[key] = (float(cosine[w]), share, share * len(text) / len(items.texts[key[1]]))
        if best:
            ids, tags = b.column(0).to_pylist(), b.column(1).to_pylist()
            yield list(zip(*((ids[d], tags[d], items.ids[i], *v) for (d, i), v in sorted(best.items()))))


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def checked(unit: list[int], region: list[int], whole: bool, telling: np.ndarray) -> float:
    """The share of the unit's words that the region holds in order, if that makes it a copy or, of a whole
    item, a paraphrase; else 0."""
    if len(unit) < SHORT:
        return float(any(region[i:i + len(unit)] == unit for i in range(len(region) - len(unit) + 1)))
    share = lcs(unit, region) / len(unit)
    if share >= LCS_SURE:
        return share
    if whole and share >= LCS_LEAST:
        told = [x for x in unit if telling[x]]
        kept = lcs(told, region) if told else 0
        if kept >= max(EVIDENCE, LCS_LEAST * len(told)):
            return share
        answer = unit[-ANSWER:]
        span = 2 * len(answer)
        if any(3 * lcs(answer, region[i:i + span]) >= 2 * len(answer) for i in range(0, max(1, len(region) - len(answer)))):
            return share
    return 0.0


def blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[Items]:
    """The usable items in the order of their ids, a bounded number at a time."""
    some: list[tuple[int, list[bytes]]] = []
    size = 0
    rows = benchmark.filter(F.col(item_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(item_col).cast("long").alias("i"), text_bytes(text_col).alias("t"))
    for r in rows.orderBy("i", "t").toLocalIterator():
        text = words(bytes(r["t"]))
        if not text:
            continue
        if some and (len(some) >= BLOCK or size + len(text) > BLOCK_WORDS):
            yield Items(some)
            some, size = [], 0
        some.append((r["i"], text))
        size += len(text)
    if some:
        yield Items(some)


def _found(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str) -> DataFrame:
    """(id, tag, item, cosine, lcs, item_share), stored."""
    out = None
    for items in blocks(benchmark, item_col, item_text):
        encoded = stored(encode(docs, items, id_col, text_col), "decontam-codes")
        df, n = document_frequencies(encoded, items)
        basis = latent_basis(encoded, items, Passages(items, df, n))
        tool = Passages(items, df, n, parts=True)

        def run(batches: Iterator[pa.RecordBatch], items=items, tool=tool, basis=basis):
            yield from _search(items, tool, basis, batches)

        got = stored(map_partition(encoded, "id long, tag long, item long, cosine double, lcs double, item_share double", run), "decontam-found")
        out = got if out is None else out.unionByName(got)
    return out if out is not None else docs.sparkSession.createDataFrame([], "id long, tag long, item long, cosine double, lcs double, item_share double")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id_col, item_col, cosine, lcs, item_share): each document row with each benchmark item that it holds,
    whole or in part: the cosine, the share of the unit found and the share of the whole item that this makes."""
    return _found(docs, benchmark, id_col, text_col, item_col, item_text).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "cosine", "lcs", "item_share")


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text holds no benchmark item."""
    bad = _found(docs, benchmark, id_col, text_col, "item_id", "text").select("tag", F.coalesce("id", F.lit(0)).alias("_bad_id"), F.col("id").isNull().alias("_bad_none")).distinct()
    same = (F.xxhash64(text_bytes(docs[text_col])) == bad["tag"]) & (F.coalesce(docs[id_col].cast("long"), F.lit(0)) == bad["_bad_id"]) & (docs[id_col].isNull() == bad["_bad_none"])
    return docs.join(bad, same, "left_anti")
