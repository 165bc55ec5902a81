"""MinHash near-duplicates by bottom-k sketches from one hash function, confirmed on full sets.

1. A document's set: distinct 5-word shingles of its whole text (A-Z lower-cased, words are runs
   without space and 0x09-0x0D, joined by one space), each as its XXH64; fewer words make one
   shingle, no word an empty set that links with nothing. Documents with equal sets form one
   class, which goes on as one row, however many copies there are.
2. A class's sketch is the ``K`` least values of its set. Of the ``K`` least values of a union the
   shared ones stand in both sketches, and at a similarity of 0.85 there are ``SHARED`` of them or
   more, but for a chance under 1e-9 a pair (binomial; the true hypergeometric tail is thinner).
   Sets up to ``K`` values are complete in their sketch.
3. Inverted lists, over the ``HEAD`` least values by the same rule: a linked pair shares ``HEAD_SHARED`` of
   them, and of sets up to ``WHOLE`` values, which are complete there as any partner's, at least
   85 in 100. Two heads that share m values share one among the first ``size - m + 1`` of each in
   any common order. The order is rare values first, so a passage that a third of all documents
   hold enters a list only for classes that consist of little else.
4. Lists of up to ``SHORT`` classes give their pairs (at most ``SHORT`` a row). Longer lists first
   link every class with ``LEADERS`` leaders of the list; classes that this does not join are
   compared in blocks inside the tasks, whose members are dealt out over as many tasks as there are
   pairs of blocks, each pair in the list of its least common value. Nothing is capped, and pairs already in one component
   are not emitted. Only classes that stand in a list have their sketch moved.
5. The union sketch (``K`` least values of both sketches) estimates the similarity; pairs with fewer
   than ``SHARED`` shared values there go. Rest: exact intersection of the full sets,
   ``100 * shared >= 85 * union``; sets beyond ``K`` values are made anew from their texts.
6. Components of the links by alternating stars over stored tables.

Rows and edge cases: one output row per input row. A null text is empty. A null id is carried
through; ``component_id`` is the smallest id reachable, null only if no id of the component is
set. Repeated ids and rows each keep their row. An empty table gives no rows. Only the id and text
columns are read, so further columns may have any name. The driver gets no rows but totals: of
the components' states, and row counts by which keys are broadcast, up to ``BROADCAST`` of them, or
else shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import map_batches, map_partition, stored, text_bytes
from gaugework.llm.simhash_bktree import components

SEED = 42
#: Values of a sketch and of its head, and the shared ones that a link leaves in a union's (see 2, 3).
K, SHARED = 256, 180
HEAD, HEAD_SHARED = 64, 34
#: Links need LEAST of 100 parts; a partner of a set of WHOLE values has at most HEAD.
LEAST = 85
WHOLE = HEAD * LEAST // 100
#: Lists up to this length give their pairs as rows; leaders and blocks of longer ones; keys broadcast at most.
SHORT, LEADERS, BLOCK = 64, 2, 1024
BROADCAST = 1_000_000


def shingle_set(text: bytes, shingle: int = 5) -> np.ndarray:
    """Distinct shingle hashes of a whole text, ascending, as signed 64-bit numbers."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.int64)
    line = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    values = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())), np.uint64, len(starts))
    return np.unique(values.view(np.int64))


def _lists(sets: list[np.ndarray]) -> pa.Array:
    cuts = np.cumsum([0] + [len(s) for s in sets])
    return pa.LargeListArray.from_arrays(cuts, np.concatenate(sets)).cast(pa.list_(pa.int64()))


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, h, m, d1, d2, n, sketch, row): two hashes of the text, 128-bit digest and size of the set, sketch."""

    def run(ids: pa.Array, h: pa.Array, m: pa.Array, texts: pa.Array):
        sets = [shingle_set(t.as_buffer().to_pybytes(), shingle) for t in texts]
        digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), np.int64).reshape(-1, 2)
        return ids, h, m, digests[:, 0], digests[:, 1], [len(s) for s in sets], _lists([s[:K] for s in sets])

    text = text_bytes(text_col)
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), F.hash(text).alias("m"), text.alias("t"))
    made = map_batches(chosen, "id long, h long, m int, d1 long, d2 long, n long, sketch array<long>", run)
    return made.withColumn("row", F.monotonically_increasing_id())


def semi(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key stands in ``keys`` (distinct, stored): broadcast if counted to be few."""
    few = keys.count() <= BROADCAST
    return df.join(F.broadcast(keys) if few else keys, on, "left_semi")


def full_sets(docs: DataFrame, text_col: str, shingle: int, wanted: DataFrame) -> DataFrame:
    """(rep, n, s): the full sets of ``wanted`` (rep, h, m), made anew from one text each."""

    def run(reps: pa.Array, texts: pa.Array):
        sets = [shingle_set(t.as_buffer().to_pybytes(), shingle) for t in texts]
        return reps, [len(s) for s in sets], _lists(sets)

    text = text_bytes(text_col)
    texts = docs.select(F.xxhash64(text).alias("h"), F.hash(text).alias("m"), text.alias("t"))
    one = semi(texts, wanted.select("h", "m").distinct(), ["h", "m"]).groupBy("h", "m").agg(F.first("t").alias("t"))
    return map_batches(one.join(wanted, ["h", "m"]).select("rep", "t"), "rep long, n long, s array<long>", run)


def near_sizes(a: Column, b: Column) -> Column:
    return LEAST * F.greatest(a, b) <= 100 * F.least(a, b)


def enough(shared: Column, a: Column, b: Column) -> Column:
    return 100 * shared >= LEAST * (a + b - shared)


def inverted_lists(prints: DataFrame, reps: DataFrame) -> DataFrame:
    """(v, c, rep, n): the lists of step 3 that hold two classes or more; c is the list's length."""
    heads = prints.select(F.col("row").alias("rep"), "n", F.slice("sketch", 1, HEAD).alias("head")).join(reps, "rep", "left_semi")
    values = heads.select("rep", "n", F.explode("head").alias("v"))
    seen = values.groupBy("v").agg(F.count("*").alias("df")).filter("df > 1")
    kept = values.join(seen.hint("shuffle_hash"), "v").groupBy("rep").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "v"))).alias("vs"))  # at most HEAD
    size = F.least("n", F.lit(HEAD))
    need = F.when(F.col("n") <= WHOLE, F.ceil(F.col("n") * LEAST / 100)).otherwise(HEAD_SHARED)
    alone = size - F.size("vs")  # values of no other class come first in the order
    first = F.greatest(size - need + 1 - alone, F.lit(0)).cast("int")
    entries = kept.select("rep", "n", F.explode(F.slice("vs", F.lit(1), first)["v"]).alias("v"))
    entries = stored(entries, "bottomk-lists")
    lengths = entries.groupBy("v").agg(F.count("*").alias("c")).filter("c > 1")
    return stored(entries.join(lengths.hint("shuffle_hash"), "v").select("v", "c", "rep", "n"), "bottomk-lists")


class Confirm:
    """The union sketch and the exact check, over the sketches of the classes that stand in lists."""

    def __init__(self, docs: DataFrame, text_col: str, shingle: int, sketches: DataFrame):
        self.docs, self.text_col, self.shingle, self.sketches = docs, text_col, shingle, sketches

    def links(self, pairs: DataFrame) -> DataFrame:
        """(a, b) of ``pairs`` that are linked."""
        side = {x: self.sketches.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab"}
        both = pairs.join(side["a"], "a").join(side["b"], "b").withColumn("i", F.array_intersect("sa", "sb"))
        union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, K)
        whole = (F.col("na") <= K) & (F.col("nb") <= K)
        passed = F.when(whole, enough(F.size("i"), F.col("na"), F.col("nb"))).otherwise(
            F.when(F.size("i") >= SHARED, F.size(F.array_intersect(union, "i")) >= SHARED))
        near = stored(both.filter(passed).select("a", "b", whole.alias("whole")), "bottomk-near")
        rest = near.filter("not whole").select("a", "b")
        reps = rest.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
        wanted = stored(self.sketches.select("rep", "h", "m").join(reps, "rep", "left_semi"), "bottomk-wanted")
        sets = stored(full_sets(self.docs, self.text_col, self.shingle, wanted), "bottomk-sets")
        full = {x: sets.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("s").alias(f"s{x}")) for x in "ab"}
        linked = rest.join(full["a"], "a").join(full["b"], "b").filter(
            enough(F.size(F.array_intersect("sa", "sb")), F.col("na"), F.col("nb")))
        return near.filter("whole").select("a", "b").unionByName(linked.select("a", "b"))


def bit_rows(sets: list[np.ndarray]) -> np.ndarray:
    """One row of bits a set; two rows share as many bits as their sets share values."""
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    often = count > 1
    use = often[column]
    row, column = row[use], (np.cumsum(often) - 1)[column[use]]
    bits = np.zeros((len(sets), int(often.sum()) // 64 + 1), np.uint64)
    np.bitwise_or.at(bits, (row, column // 64), np.uint64(1) << (column % 64).astype(np.uint64))
    return bits


def first_common(lists: list[np.ndarray], v: int) -> np.ndarray:
    """Rows of bits over the values below ``v``: a pair that shares one is compared in that value's list."""
    return bit_rows([x[x < v] for x in lists])


def block_pairs(v: int, reps: np.ndarray, ns: np.ndarray, roots: np.ndarray, sketches: list[np.ndarray], lists: list[np.ndarray], side: np.ndarray):
    """(a, b, sure) for members of different components whose least common value is ``v``: those with
    ``side`` 0 against those with 1, or all against all if there is one side. Sure: both sets are
    complete, so the check was exact; of sure links only a spanning forest is emitted."""
    if len(np.unique(roots)) < 2:
        return
    inside = side.min() == side.max()
    bits, before = bit_rows(sketches), first_common(lists, v)
    complete = ns <= K
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    for a in range(len(reps)) if inside else np.flatnonzero(side == 0).tolist():
        other = np.arange(a + 1, len(reps)) if inside else np.flatnonzero(side == 1)
        other = other[(roots[other] != roots[a]) & (LEAST * np.maximum(ns[other], ns[a]) <= 100 * np.minimum(ns[other], ns[a]))]
        other = other[~(before[other] & before[a]).any(axis=1)]
        shared = np.bitwise_count(bits[other] & bits[a]).sum(axis=1, dtype=np.int64)
        whole = complete[other] & complete[a]
        passed = np.where(whole, 100 * shared >= LEAST * (ns[other] + ns[a] - shared), shared >= SHARED)
        for b, sure in zip(other[passed].tolist(), whole[passed].tolist()):
            if sure:
                x, y = root(int(roots[a])), root(int(roots[b]))
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    yield int(reps[a]), int(reps[b]), True
            else:
                least = np.union1d(sketches[a], sketches[b])[:K]
                if np.isin(least, np.intersect1d(sketches[a], sketches[b], assume_unique=True), assume_unique=True).sum() >= SHARED:
                    yield int(reps[a]), int(reps[b]), False


def compare_blocks(members: DataFrame) -> DataFrame:
    """(a, b, sure) from the long lists: ``members`` is (v, c, rep, n, root, sketch, lists)."""
    blocks = F.ceil(F.col("c") / BLOCK)
    own = F.pmod(F.xxhash64("rep"), blocks)
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    keyed = dealt.select("v", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         "rep", "n", "root", (F.col("own") > F.col("other")).cast("int").alias("side"), "sketch", "lists")
    keyed = keyed.repartition("v", "i", "j").sortWithinPartitions("v", "i", "j", "rep")

    def run(batches: Iterator[pa.RecordBatch]):
        key, held = None, []

        def close():
            if len(held) > 1:
                reps, ns, roots, side, sketches, lists = zip(*held)
                if found := list(block_pairs(key[0], np.array(reps), np.array(ns), np.array(roots), list(sketches), list(lists), np.array(side))):
                    return list(zip(*found))
            return None

        for batch in batches:
            v, i, j, rep, n, root, side = (batch.column(c).to_pylist() for c in range(7))
            sketches, lists = (np.split(x.flatten().to_numpy(zero_copy_only=False), np.cumsum(x.value_lengths().to_numpy(zero_copy_only=False))[:-1])
                               for x in batch.columns[7:])
            for at in range(batch.num_rows):
                if (here := (v[at], i[at], j[at])) != key:
                    if out := close():
                        yield out
                    key, held = here, []
                held.append((rep[at], n[at], root[at], side[at], sketches[at], lists[at]))
        if out := close():
            yield out

    return map_partition(keyed, "a long, b long, sure boolean", run)


def links(docs: DataFrame, text_col: str, shingle: int, prints: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b): links between classes that connect every pair of classes of enough similarity."""
    lists = inverted_lists(prints, reps)
    listed = stored(lists.select("rep").distinct(), "bottomk-listed")
    rows = prints.select(F.col("row").alias("rep"), "h", "m", "n", "sketch")
    sketches = stored(semi(rows, listed, ["rep"]), "bottomk-sketches")
    confirm = Confirm(docs, text_col, shingle, sketches)
    short, long = lists.filter(F.col("c") <= SHORT), lists.filter(F.col("c") > SHORT)
    a, b = (short.select("v", F.col("rep").alias(x), F.col("n").alias(f"n{x}")) for x in "ab")
    pairs = a.join(b, "v").filter((F.col("a") < F.col("b")) & near_sizes(F.col("na"), F.col("nb"))).select("a", "b")
    leaders = long.groupBy("v").agg(F.array(*[F.min(F.struct(F.xxhash64("v", "rep", F.lit(i)).alias("h"), "rep", "n")) for i in range(LEADERS)]).alias("ls"))
    others = F.filter(F.array_distinct(F.transform("ls", lambda l: F.struct(l["rep"].alias("rep"), l["n"].alias("n")))), lambda l: (l["rep"] != F.col("rep")) & near_sizes(F.col("n"), l["n"]))
    led = long.join(leaders, "v").select("rep", F.explode(others).alias("l"))
    pairs = pairs.unionByName(led.select(F.least("rep", "l.rep").alias("a"), F.greatest("rep", "l.rep").alias("b")))
    first = stored(confirm.links(stored(pairs.distinct(), "bottomk-pairs")), "bottomk-links")
    roots = components(first, "bottomk-first")
    of_rep = long.groupBy("rep").agg(F.array_sort(F.collect_list("v")).alias("lists"))  # at most HEAD
    members = long.join(roots, long["rep"] == roots["node"], "left").select("v", "c", "rep", "n", F.coalesce("root", "rep").alias("root"))
    open_lists = members.groupBy("v").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("v")
    members = members.join(open_lists, "v").join(of_rep, "rep").join(sketches.select("rep", "sketch"), "rep")
    found = stored(compare_blocks(members.select("v", "c", "rep", "n", "root", "sketch", "lists")), "bottomk-blocks")
    more = found.filter("not sure").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return first.unionByName(found.filter("sure").select("a", "b")).unionByName(confirm.links(stored(more, "bottomk-pairs")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5) -> DataFrame:
    """(id_col, n_shingles, component_id, kept), one row per row of ``docs``."""
    prints = stored(shingle_sets(docs, id_col, text_col, shingle), "bottomk")
    classes = stored(prints.filter("n > 0").groupBy("d1", "d2").agg(F.min("row").alias("rep"), F.min("id").alias("first")), "bottomk-classes")
    roots = components(links(docs, text_col, shingle, prints, classes.select("rep")), "bottomk-roots")
    known = classes.join(roots, classes["rep"] == roots["node"], "left").select("d1", "d2", "first", F.coalesce("root", "rep").alias("root"))
    least = known.groupBy("root").agg(F.min("first").alias("least"))
    named = known.join(least, "root").select("d1", "d2", "least")
    rows = prints.select("id", "n", "d1", "d2").join(named, ["d1", "d2"], "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("least"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.col("id").eqNullSafe(component).alias("kept"))
