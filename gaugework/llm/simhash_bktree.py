"""SimHash near-duplicates: fingerprints linked through sharded BK-trees, then components.

1. Fingerprint. A-Z is lower-cased, words are runs without space and 0x09-0x0D, a shingle is
   ``shingle`` words joined by one space (fewer words: the whole sequence). Bit i is 1 if it is
   set in over half of the shingles' XXH64 values. A text without words has fingerprint 0.
2. One row per distinct fingerprint (partial aggregates: a group of copies holding a third of
   the rows becomes one row before anything is compared).
3. Shards. The 64 bits are cut into ``radius + 3`` blocks. Two fingerprints within the radius
   differ in at most ``radius`` blocks, so at least three blocks agree: every choice of three
   blocks is a shard key of 36 bits or more, and each linked pair meets in at least one shard.
4. BK-trees. Each shard's members form a BK-tree: a child hangs under its integer Hamming
   distance from the parent. A member is looked up before it is inserted, and only edges within
   ``[d - radius, d + radius]`` are followed. Shard trees are built where the shuffle brings the
   shard, not broadcast: the fingerprints of a corpus have no size bound, whereas a shard's
   members agree in 36 bits or more.
5. A union-find inside the shard turns links into one edge per member, so a shard of n members
   emits n - 1 edges at most, never its pairs.
6. Components: alternating large-star and small-star steps over stored tables.

Rows and edge cases: one output row per input row. A null text is empty. A null id is carried
through; ``component_id`` is the smallest id reachable and is null only if no id in the component
is set. Repeated ids and repeated rows each keep their row. An empty table gives no rows. Only
the id and text columns are read, so further columns may have any name.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import map_batches, map_partition, stored, text_bytes

SEED = 42
CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of a whole text given as UTF-8 bytes."""
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), SEED)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        values = np.array([digest(line[a:b], SEED) for a, b in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])], "<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, tag, fp): the fingerprint as a signed 64-bit number, and a 64-bit hash of the text that
    tells rows with the same id apart."""

    def run(ids: pa.Array, tags: pa.Array, texts: pa.Array):
        return ids, tags, np.array([fingerprint(t.as_buffer().to_pybytes(), shingle) for t in texts], np.uint64).astype(np.int64)

    text = text_bytes(text_col)
    columns = [F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("tag"), text.alias("t")]
    return map_batches(docs.select(*columns), "id long, tag long, fp long", run)


def block_masks(radius: int) -> list[int]:
    """A mask for each choice of three out of ``radius + 3`` blocks of the 64 bits."""
    n = radius + 3
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(n)]
    return [sum(x) for x in itertools.combinations(blocks, 3)]


class BKTree:
    """Integers under the Hamming distance; each node is [value, {distance: child}]."""

    def __init__(self) -> None:
        self.root: list | None = None

    def near(self, value: int, radius: int) -> list[int]:
        """Members within ``radius`` of ``value``."""
        found, todo = [], [self.root] if self.root else []
        while todo:
            member, children = todo.pop()
            d = (member ^ value).bit_count()
            if d <= radius:
                found.append(member)
            for edge, child in children.items():
                if d - radius <= edge <= d + radius:
                    todo.append(child)
        return found

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = [value, {}]
            return
        node = self.root
        while d := (node[0] ^ value).bit_count():
            child = node[1].get(d)
            if child is None:
                node[1][d] = [value, {}]
                return
            node = child


def shard_edges(members: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among a shard's members, as (member, root)."""
    tree, parent = BKTree(), {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for value in members:
        parent[value] = value
        for other in tree.near(value, radius):
            a, b = root(value), root(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
        tree.add(value)
    return [(x, r) for x in parent if (r := root(x)) != x]


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): edges that connect every pair of distinct fingerprints within ``radius`` bits,
    directly or through other members of their shard."""
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(radius)]
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "key"))

    def run(batches: Iterator[pa.RecordBatch]):
        shard, members = None, []

        def close():
            if len(members) > 1:
                if found := shard_edges([x & 0xFFFFFFFFFFFFFFFF for x in members], radius):
                    a, b = np.array(found, np.uint64).astype(np.int64).T
                    return [a, b]
            return None

        for batch in batches:
            fp, mask, key = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(fp):
                continue
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            for part, first in zip(np.split(fp, cuts), [0, *cuts.tolist()]):
                here = (int(mask[first]), int(key[first]))
                if here != shard:
                    if out := close():
                        yield out
                    shard, members = here, []
                members.extend(part.tolist())
        if out := close():
            yield out

    sharded = keyed.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    return map_partition(sharded, "a long, b long", run)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b), null-free; root is the smallest node reachable.

    Large-star joins every larger neighbour to the smallest neighbour, small-star the smaller
    ones; both are a partial aggregate per node and a join back, which AQE splits if one node
    has very many edges. Rounds grow with the logarithm of a component's diameter."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), name)
    seen = None
    while (state := now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()) != seen:
        seen = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        large = stored(large, name)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        now = stored(small.filter("a <> b").distinct(), name)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> DataFrame:
    """(id, tag, fp, root, component_id), one row per row of ``docs``."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), radius), "simhash-links")
    known = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(known.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """(id_col, fingerprint, component_id), one row per row of ``docs``."""
    return _classes(docs, id_col, text_col, shingle, radius).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of ``docs`` per component: the smallest id (ids before nulls), then the smallest hash
    of the text, then the smallest hash of all columns. Copies of a row collapse in the partial
    aggregate, before texts are shuffled, which happens once."""
    found = _classes(docs, id_col, text_col, shingle, radius)
    least = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0)).alias("id"), "tag")).alias("k"))
    chosen = least.select("k.*").distinct()
    each = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.col(id_col).isNull().alias("none"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
                       F.xxhash64(text_bytes(text_col)).alias("tag"), F.xxhash64(each).alias("order"), each.alias("row"))
    one = rows.groupBy("none", "id", "tag").agg(F.min_by("row", "order").alias("row"))
    return one.join(chosen, ["none", "id", "tag"], "left_semi").select("row.*")
