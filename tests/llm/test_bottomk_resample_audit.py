"""Bottom-k near-duplicates, importance resampling and the source audit against plain versions, and awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from gaugework.llm import importance_crc, minhash_bottomk, source_divergence


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_classes(rows):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs of sets."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets.append({" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=repr)


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def changed(rng, text, n):
    out = list(text)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"x{rng.randrange(10 ** 6)}"
    return out


def check(spark, docs_of, rows):
    got = minhash_bottomk.near_duplicates(docs_of(rows).repartition(3)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_classes(rows)


def test_links_of_short_and_long_sets(spark, docs_of):
    rng = random.Random(3)
    rows = []
    for size in (3, 5, 12, 60, 230, 300, 900):
        base = words(rng, size, 10 ** 6)
        for copy in range(6):
            rows.append((len(rows) * 7 % 401, " ".join(changed(rng, base, min(size, copy * max(1, size // 150))))))
    check(spark, docs_of, rows)


def test_chain_and_exact_border(spark, docs_of):
    # Sets of 20 and 17 shingles, one inside the other: 100 * 17 = 85 * 20 links; 16 of 19 does not.
    line = [f"a{i}" for i in range(24)]
    other = [f"b{i}" for i in range(23)]
    rows = [(5, " ".join(line)), (3, " ".join(line[:21])), (9, " ".join(other)), (1, " ".join(other[:20]))]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_bottomk.near_duplicates(docs_of(rows)).collect()}
    assert got == {5: (20, 3), 3: (17, 3), 9: (19, 9), 1: (16, 1)}
    check(spark, docs_of, rows)


def test_awkward_rows(spark, docs_of):
    rng = random.Random(4)
    text = " ".join(words(rng, 3000, 10 ** 6))
    rows = [(1, None), (2, ""), (3, " \t\x0b\r\n"), (4, "One"), (4, "one"), (None, "ONE"), (None, None), (6, "É a b"), (7, "é a b"),
            (8, text), (8, text), (9, text + " tail"), (None, text + " other tail"), (10, "a\x1cb \x85 c d"), (11, "a a a a a a a"), (12, "a a a a a")]
    check(spark, docs_of, rows)
    assert minhash_bottomk.near_duplicates(docs_of([])).count() == 0


@pytest.mark.parametrize("short, block", [(4, 8), (4, 1024), (64, 1024)])
def test_a_large_group_in_blocks(spark, docs_of, monkeypatch, short, block):
    """A passage that all hold, sets above and below the sketch's size, some linked and some not."""
    monkeypatch.setattr(minhash_bottomk, "SHORT", short)
    monkeypatch.setattr(minhash_bottomk, "BLOCK", block)
    rng = random.Random(8)
    rows = []
    for size in (60, 400):
        base = words(rng, size, 10 ** 6)
        for k in range(45):
            rows.append((1000 - len(rows), " ".join(base + words(rng, size * (k % 9) // 20, 10 ** 6) if k % 2 else changed(rng, base, size * (k % 9) // 200))))
    check(spark, docs_of, rows)


def test_bit_rows_share_what_sets_share():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 90, n)) for n in (0, 1, 20, 40, 90)]
    bits = minhash_bottomk.bit_rows(sets)
    for a in range(5):
        for b in range(a):
            assert np.bitwise_count(bits[a] & bits[b]).sum() == len(np.intersect1d(sets[a], sets[b]))


@pytest.mark.parametrize("broadcast", [0, 10 ** 6])
def test_keys_shuffled_or_broadcast(spark, docs_of, monkeypatch, broadcast):
    monkeypatch.setattr(minhash_bottomk, "BROADCAST", broadcast)
    rng = random.Random(12)
    base = words(rng, 400, 10 ** 6)
    check(spark, docs_of, [(k, " ".join(changed(rng, base, 5 * k))) for k in range(6)] * 2 + [(9, "a b"), (8, "A  b")])


def test_set_of_a_text():
    want = sorted({xxhash.xxh64_intdigest(s, 42) for s in (b"a b c d e", b"b c d e f")})
    assert sorted(minhash_bottomk.shingle_set(b"A b  c\td e F").astype(np.uint64).tolist()) == want


# importance resampling


def test_crc_of_every_length():
    rng = random.Random(2)
    spans = [bytes(rng.choice(b"0123456789abcxyz\xc3\xa9\xff") for _ in range(n)) for n in [*range(1, 200), 1000, 4096, 70001]]
    starts, made = importance_crc.crcs(np.frombuffer(b" ".join(spans), np.uint8))
    assert made.tolist() == [zlib.crc32(s) for s in spans]
    assert starts.tolist() == np.cumsum([0] + [len(s) + 1 for s in spans[:-1]]).tolist()


def test_long_span_over_several_pieces(monkeypatch):
    monkeypatch.setattr(importance_crc, "PIECE", 256)
    span = bytes(i % 26 + 97 for i in range(5000))
    assert importance_crc.long_crc(np.frombuffer(span, np.uint8)) == zlib.crc32(span)
    texts = [b"ab cd " * 200, b"", span + b" x", b"--", span]
    found = Counter()
    for numbers, got in importance_crc.features(texts, 10 ** 9):
        found.update(zip(numbers.tolist(), got.tolist()))
    want = Counter((i, zlib.crc32(w) % 10 ** 9) for i, t in enumerate(texts) for w in re.findall(rb"[0-9a-z\x80-\xff]+", t))
    assert found == want


def plain_resample(docs, target, percent=10, buckets=10000):
    def found(text):
        return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))

    def bucket(w):
        return zlib.crc32(w.encode()) % buckets

    s = Counter(bucket(w) for _, t in docs for w in found(t))
    t = Counter(bucket(w) for x in target for w in found(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for doc, text in docs:
        w = found(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in map(bucket, w))
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(w), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[: len(able) * percent // 100], 1):
        r[4] = rank
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("percent", [10, 73])
def test_resample(spark, docs_of, percent):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice(["Aa", "b1", "cé", "日本", "d-d", "e" * 90]) + str(rng.randrange(30)) for _ in range(rng.randrange(60)))) for i in range(150)]
    docs += [(500, None), (501, ""), (None, "word " * 30), (7, docs[7][1]), (7, docs[7][1]), (502, "--- ..."), (503, "z" * 200)] + [(600, "same text here " * 9)] * 40
    target = ["aa1 b12 cé3", None, "", "日本4 E"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance_crc.resample(docs_of(docs).repartition(4), bench, percent=percent).collect()
    assert sorted(map(tuple, got), key=repr) == plain_resample(docs, target, percent)


def test_resample_empty(spark, docs_of):
    none = docs_of([])
    assert importance_crc.resample(none, none).count() == 0
    docs = [(1, "a " * 25), (2, None)]
    assert sorted(map(tuple, importance_crc.resample(docs_of(docs), none).collect()), key=repr) == plain_resample(docs, [])


# source audit


def plain_audit(rows, least=3, top=200):
    found, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        w = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
        found[lang, source].update(w)
        seen[lang].update(set(w))
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= least]
        of = {s: found[lang, s] for s in sources}
        whole = sum(of.values(), Counter())

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        q = shares(whole)
        p = {s: shares(c) for s, c in of.items()}
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            over = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if of[s][t] > 0 and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", over, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, r) for r, (value, item) in enumerate(items[:limit], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(t, lang, s, 1, "x") for t, lang, s in rows], "text string, lang string, source string, t int, term string").repartition(3)


@pytest.mark.parametrize("held, cells", [(200_000, 1 << 21), (5, 40)])
def test_audit(spark, monkeypatch, held, cells):
    monkeypatch.setattr(source_divergence, "HELD", held)
    monkeypatch.setattr(source_divergence, "CELLS", cells)
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in ("ab", "Ba", "cé", "日", "d'e", "Éa", "éa") for b in "klmnop"]
    rows = [(" ".join(rng.choice(vocabulary[k % 5:]) for _ in range(rng.randrange(40))), rng.choice(["en", "de", None, ""]), f"s{k % 7}") for k in range(120)]
    rows += [(None, "en", "blank"), ("", "en", None), ("12 34 --", "fr", "only"), ("rare words", "it", "a"), ("rare thing", "it", "b")]
    rows += [(None, None, None), (" ".join(vocabulary) * 50, "en", "s1")] + [("same same", "en", "s2")] * 20
    got = source_divergence.audit(frame(spark, rows), top=9).collect()
    assert sorted(map(tuple, got)) == plain_audit(rows, top=9)


def test_audit_empty(spark):
    assert source_divergence.audit(frame(spark, [])).count() == 0
    assert source_divergence.audit(frame(spark, [(None, None, None)] * 3)).count() == 0


def test_table_agrees_with_the_pattern():
    text = "".join(map(chr, range(0x180))) + " Tail\x85end\xa0x"
    want = Counter(w.encode() for w in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text)))
    assert source_divergence.terms(text.encode()) == want
