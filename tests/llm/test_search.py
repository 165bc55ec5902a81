"""Exact top-k against brute force, with ties, odd vectors and several blocks; BK-trees and components."""

import math
import random

import pytest

from gaugework.llm import simhash_bktree, topk_histogram


def plain_top(rows, k, every, scale):
    use = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in use if i % every == 0}):
        mine = min(v for i, v in use if i == q)
        best = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in use if i != q and len(v) == len(mine))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [2, 4096])
def test_topk_brute_force(spark, block):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(40)] + [(7, rows[0][1])] + [(300, [0.0] * 6)] * 3
    rows += [(None, rows[1][1]), (400, None), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (20, [1.0, 2.0]), (40, []), (41, [3.0, 4.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(5)
    as_floats = [(r.vec_id, r.embedding) for r in df.collect()]
    got = topk_histogram.top_k(df, k=5, every=20, scale=256, block=block).collect()
    assert sorted(tuple(r) for r in got) == plain_top(as_floats, 5, 20, 256)


def test_topk_few_and_none(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_histogram.top_k(empty).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert topk_histogram.top_k(one).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (3, [1e9])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk_histogram.top_k(two).collect()] == [(0, 1, 3, 256 * 256 * 10 ** 9)]


def test_bktree_finds_all_within_radius():
    rng = random.Random(6)
    members = [rng.getrandbits(16) for _ in range(400)]
    tree = simhash_bktree.BKTree()
    for m in members:
        tree.add(m)
    for _ in range(50):
        q = rng.getrandbits(16)
        assert sorted(tree.near(q, 2)) == sorted({m for m in members if (m ^ q).bit_count() <= 2})


def test_every_close_pair_shares_a_shard():
    rng = random.Random(7)
    masks = simhash_bktree.block_masks(2)
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        assert any(a & m == b & m for m in masks)


def plain_print(text, n=3):
    import xxhash
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=2):
    prints = [plain_print(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted((str(i), f"{p:016x}", str(least.get(g))) for (i, _), p, g in zip(rows, prints, group)), group


def near_rows():
    rng = random.Random(8)
    vocab = ["w%d" % i for i in range(400)]
    rows = []
    for g in range(12):
        base = rng.choices(vocab, k=150)
        for _ in range(rng.randint(1, 8)):
            words = list(base)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((len(rows) + 10, " ".join(words)))
    rows += [(1, None), (2, ""), (3, " \t\n"), (None, "lonely text here now"), (None, None), (4, "One TWO"), (5, "one\ttwo"), (4, "One TWO"), (6, "é é x y z")]
    return rows


def test_near_duplicates_brute_force(docs_of):
    rows = near_rows()
    got = simhash_bktree.near_duplicates(docs_of(rows)).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == plain_components(rows)[0]
    assert simhash_bktree.near_duplicates(docs_of([])).count() == 0


def test_keep_first_keeps_one_of_each_component(docs_of):
    rows = near_rows()
    _, group = plain_components(rows)
    kept = simhash_bktree.keep_first(docs_of(rows))
    assert kept.columns == docs_of([]).columns
    got = sorted(str(r.doc_id) for r in kept.collect())
    want = {}
    for g, (i, t) in zip(group, rows):
        want[g] = min(want.get(g, (2, 0)), (i is None, i or 0))
    assert got == sorted("None" if none else str(i) for none, i in want.values())
    assert simhash_bktree.keep_first(docs_of([])).count() == 0


def test_components_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (105, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in simhash_bktree.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100, 105: 100}
