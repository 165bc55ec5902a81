"""Learned operators: held-out accuracy, exact base columns, gradients, planted passages."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd

from gaugework.llm import decontam_lsa, lm_gru, queries, toxicity_fm

SF = "/root/testdata/sf0.01"


def test_toxicity_held_out_accuracy(spark):
    rows = queries.op1_toxicity(spark, SF).toPandas()
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    assert sorted(rows.doc_id) == sorted(docs.doc_id)
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(rows.doc_id, rows.held_out))
    assert ((rows.score >= 0.5).astype(int) == rows.predicted).all() and rows.score.between(0, 1).all()
    held = rows[rows.held_out].merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    assert (held.predicted == held.toxic).mean() > 0.93


def test_factorization_learns_a_pair():
    rng = np.random.default_rng(0)
    rows = [[f for f in range(6) if rng.random() < 0.5] for _ in range(3000)]
    y = np.array([float(0 in r and 1 in r) for r in rows])  # only the pair is toxic
    model = toxicity_fm.fit(rows, y, {i: i for i in range(6)}, epochs=60)
    assert np.mean([(model.score(r) >= 0.5) == (t > 0) for r, t in zip(rows, y)]) > 0.97


def test_toxicity_odd_rows(spark, docs_of):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)] + [(None, 1), (3, None), (999, 1)], "doc_id long, toxic int")
    rows = [(i, "a rotten clown here" if i % 2 else "a fine day") for i in range(1, 60)] + [(None, "rotten"), (60, None), (61, ""), (5, "a rotten clown here"), (62, "fine " * 100_000)]
    out = toxicity_fm.toxicity(docs_of(rows), labels).collect()
    assert len(out) == len(rows)
    assert all(0 <= r.score <= 1 for r in out) and not any(r.held_out for r in out if r.doc_id is None)
    kept = toxicity_fm.keep_clean(docs_of(rows), labels)
    assert kept.columns == docs_of([]).columns
    assert {r.doc_id for r in kept.collect()} >= {60, 61, 62} and not any(r.doc_id is not None and r.doc_id < 60 and r.doc_id % 2 for r in kept.collect())
    assert toxicity_fm.toxicity(docs_of([]), labels).count() == 0
    assert toxicity_fm.toxicity(docs_of(rows), labels.limit(0)).count() == len(rows)


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w] + [None]


def check_lm(rows, docs):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in docs]
    counts = Counter(w for (_, t), h in zip(docs, held) if not h for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((str(i), h, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total,
                   round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens(t)), 4)) for (i, t), h in zip(docs, held))
    assert want == sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows)


def test_lm_base_columns_and_gain(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    rows = queries.op8_lm_score(spark, SF).collect()
    check_lm(rows, list(zip(docs.doc_id, docs.text)))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_odd_rows(docs_of, monkeypatch):
    monkeypatch.setattr(lm_gru, "COMMON", 3)  # most tokens go through the join
    rows = [(i, f"one Two three w{i} w{i % 7}") for i in range(60)] + [(1, None), (2, ""), (None, "one é"), (9, "one Two three w9 w2"), (70, "x " * 50_000)]
    check_lm(lm_gru.likelihood(docs_of(rows)).collect(), rows)
    assert lm_gru.likelihood(docs_of([])).count() == 0


def test_network_learns_from_every_training_document(docs_of, monkeypatch):
    """The driver's sample holds none of the documents in which b follows a; the rounds do."""
    monkeypatch.setattr(lm_gru, "SAMPLE_TOKENS", 0)
    rows = [(i, "a b c d " * 250) for i in range(400)]
    out = [r for r in lm_gru.likelihood(docs_of(rows).repartition(2)).collect() if r.held_out]
    assert out and all(r.score / r.n_tokens > 0.5 * r.base_score / r.n_tokens for r in out)


def test_texts_beyond_the_sample_bound_are_learnt(docs_of, monkeypatch):
    monkeypatch.setattr(lm_gru, "SAMPLE_TOKENS", 1_000)
    rows = [(i, "a b c d " * 5_000) for i in range(40)]
    out = [r for r in lm_gru.likelihood(docs_of(rows).repartition(2)).collect() if r.held_out]
    assert out and all(r.score > 0.5 * r.base_score for r in out)


def test_network_gradients():
    rng = np.random.default_rng(1)
    net = lm_gru.Network(np.arange(1.0, 13.0), hidden=3, embedding=2, classes=3)
    net.p = {k: rng.normal(0, 0.5, v.shape) for k, v in net.p.items()}
    inputs, targets, h = rng.integers(0, 12, (5, 4)), rng.integers(0, 12, (5, 4)), np.zeros((4, 3))
    grad, _, _ = net.backward(inputs, targets, h, end=0)
    for name, values in net.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in values.shape)
            loss = []
            for step in (1e-3, -2e-3):
                values[at] += step
                loss.append(net.backward(inputs, targets, h, end=0)[2])
            values[at] += 1e-3
            assert abs((loss[0] - loss[1]) / 2e-3 - grad[name][at]) < 2e-3, name


def test_network_state_is_carried_across_windows():
    net = lm_gru.Network(np.arange(1.0, 33.0), classes=4)
    texts = [np.random.default_rng(i).integers(0, 32, n) for i, n in enumerate((1, 50, 7, 33, 200))]
    whole = net.score(texts, end=0, window=1000)
    assert np.allclose(whole, net.score(texts, end=0, window=16), rtol=1e-4)
    assert np.allclose(whole, [net.score([t], end=0)[0] for t in texts], rtol=1e-4)


def test_decontamination_finds_copies_in_the_table(spark):
    got = {(r.doc_id, r.item_id) for r in queries.op5_decontamination(spark, SF).collect()}
    docs, items = pd.read_parquet(f"{SF}/documents.parquet"), pd.read_parquet(f"{SF}/benchmark.parquet")
    flat = {i: b" ".join(decontam_lsa.words(t.encode())) for i, t in zip(items.item_id, items.text)}
    want = {(d, i) for d, t in zip(docs.doc_id, docs.text) for i, x in flat.items() if b" " + x + b" " in b" " + b" ".join(decontam_lsa.words(t.encode())) + b" "}
    assert want <= got and len(got - want) <= 2


def test_decontamination_planted(spark, docs_of):
    rng = random.Random(9)
    vocab = ["".join(rng.choices("bcdfglmnprst", k=1) + rng.choices("aeiou", k=1))[:2] * rng.randint(1, 2) + str(i) for i in range(3000)]
    common = ["the", "of", "and", "to", "in"]
    text = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocab) for _ in range(n)]
    items = [(i, text(rng.randint(15, 60))) for i in range(40)]
    rows, want = [], set()
    for d in range(400):
        words = text(rng.randint(30, 300))
        if d % 4 == 0:
            i, item = items[d // 4 % 40]
            if d % 8 == 0:  # a paraphrase: a tenth of the words replaced, a few inserted, the answer kept
                item = [w if k >= len(item) - 3 or rng.random() > 0.1 else rng.choice(vocab) for k, w in enumerate(item)]
                item.insert(5, rng.choice(vocab))
            at = rng.randrange(len(words))
            words[at:at] = item
            want.add((d, i))
        rows.append((d, " ".join(words).capitalize() + "."))
    rows += [(900, None), (901, ""), (None, " ".join(items[0][1])), (902, " ".join(items[1][1])), (902, " ".join(items[1][1])), (903, " ".join(items[2][1]) * 2 + " the" * 50_000)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items] + [(None, "x y z"), (77, None), (78, ""), (79, "the of")], "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in decontam_lsa.leaks(docs_of(rows), bench).collect()]
    odd = [(None, 0), (902, 1), (902, 1), (903, 2)]
    assert all(got.count(x) >= odd.count(x) for x in odd)
    found = {x for x in got if x[0] is not None and x[0] < 900}
    assert len(found & want) >= 0.97 * len(want) and len(found - want) == 0
    kept = decontam_lsa.keep_clean(docs_of(rows), bench)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs_of([]).columns and {900, 901} <= set(ids) and not {None, 902, 903} & set(ids)
    assert len(ids) == len(rows) - len({d for d, _ in found}) - 4
    assert decontam_lsa.leaks(docs_of([]), bench).count() == 0
    assert decontam_lsa.leaks(docs_of(rows), bench.limit(0)).count() == 0


def pieces_of(rng, item, kind, vocab):
    """What a text may hold of an item."""
    n = len(item)
    if kind == "passage":
        at = rng.randrange(n - 12)
        return item[at:at + 13]
    if kind in ("first half", "60 %", "75 %"):
        return item[:-(-n * {"first half": 50, "60 %": 60, "75 %": 75}[kind] // 100)]
    if kind == "altered":
        gone = set(rng.sample(range(n), round(0.3 * n)))
        return [rng.choice(vocab) if k in gone else w for k, w in enumerate(item)]
    return [x for w in item for x in ([w, rng.choice(vocab)] if rng.random() < 0.3 else [w])]  # words put in


def test_decontamination_finds_parts_of_items(spark, docs_of):
    rng = random.Random(19)
    vocab = ["".join(rng.choices("bcdfglmnprst", k=3)) + str(i) for i in range(4000)]
    common = ["the", "of", "and", "to", "in"]
    text = lambda n: [rng.choice(common) if rng.random() < 0.4 else rng.choice(vocab) for _ in range(n)]
    items = [text(rng.randint(26, 60)) for _ in range(60)]
    kinds = ["passage", "first half", "60 %", "75 %", "altered", "words put in"]
    rows, want = [], {k: set() for k in kinds}
    for d in range(900):
        words = text(rng.randint(30, 300))
        if d % 2 == 0:
            kind, i = kinds[d // 2 % 6], rng.randrange(60)
            at = rng.randrange(len(words))
            words[at:at] = pieces_of(rng, items[i], kind, vocab)
            want[kind].add((d, i))
        rows.append((d, " ".join(words)))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.lcs, r.item_share) for r in decontam_lsa.leaks(docs_of(rows), bench).collect()}
    assert not set(got) - set().union(*want.values())
    for kind in kinds:
        assert len(want[kind] & set(got)) >= 0.9 * len(want[kind]), kind
    assert all(0.6 <= a <= 1 and 0 < b <= a for a, b in got.values())


def test_decontamination_short_items_and_scripts_without_spaces(spark, docs_of):
    items = ["zorbal quint", "東京都の人口は約千四百万人であり日本で最も多い都市です", "one", "a b c d"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [(1, "so the Zorbal, quint is"), (2, "zorbal is quint"), (3, "まず、東京都の人口は約千四百万人であり日本で最も多い都市です。"), (4, "人口"), (5, "b c d a b c x"), (6, "x a b c d")]
    rows += [(k, f"filler text number {k} of many") for k in range(10, 60)]
    got = {(r.doc_id, r.item_id) for r in decontam_lsa.leaks(docs_of(rows), bench).collect()}
    assert got == {(1, 0), (3, 1), (6, 3)}


def test_lcs_against_brute_force():
    rng = random.Random(10)
    for _ in range(100):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontam_lsa.lcs(a, b) == table[-1][-1]


def test_network_against_a_plain_step_by_step_network():
    """Every token by itself, with loops and float64: gates, class, token inside the class."""
    import math

    net = lm_gru.Network(np.arange(1.0, 13.0), hidden=3, embedding=2, classes=3)
    rng = np.random.default_rng(7)
    net.p = {k: rng.normal(0, 0.5, v.shape) for k, v in net.p.items()}
    p, n = net.p, 3
    sigmoid = lambda x: 1 / (1 + math.exp(-x))

    def log_softmax(x, i):
        return x[i] - math.log(sum(math.exp(v) for v in x))

    texts, want = [[4, 1, 11, 0], [0], [7, 7, 2, 9, 3, 0]], []
    for text in texts:
        h, last, total = [0.0] * n, 0, 0.0
        for token in text:
            x = [sum(p["embed"][last][e] * p["wx"][e][j] for e in range(2)) + p["bx"][j] for j in range(3 * n)]
            y = [sum(h[i] * p["wh"][i][j] for i in range(n)) for j in range(3 * n)]
            new = []
            for i in range(n):
                update, reset = sigmoid(x[i] + y[i]), sigmoid(x[n + i] + y[n + i])
                candidate = math.tanh(x[2 * n + i] + reset * y[2 * n + i])
                new.append(update * h[i] + (1 - update) * candidate)
            h = new
            kind, inside = divmod(token, net.size)
            total += log_softmax([sum(h[i] * p["cw"][i][c] for i in range(n)) + p["cb"][c] for c in range(3)], kind)
            total += log_softmax([sum(h[i] * p["ow"][kind][i][w] for i in range(n)) + p["ob"][kind][w] for w in range(net.size)], inside)
            last = token
        want.append(total)
    assert np.allclose(net.score([np.array(t) for t in texts], end=0), want, rtol=1e-5)


def test_scores_do_not_follow_the_partitions(docs_of, monkeypatch):
    monkeypatch.setattr(lm_gru, "BLOCK", 2_000)  # several shards a round
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(200)))) for i in range(120)]
    runs = [{r.doc_id: r.score for r in lm_gru.likelihood(docs_of(rows).repartition(n)).collect()} for n in (1, 5)]
    assert runs[0].keys() == runs[1].keys() and all(abs(runs[0][k] - runs[1][k]) < 1e-3 for k in runs[0])


def test_common_tokens_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(lm_gru, "COMMON", 50)
    counts = spark.createDataFrame([(f"t{i}".encode(), 1000 - i if i < 30 else 7) for i in range(500)], "token binary, c long")
    got = lm_gru.common_tokens(counts)
    assert [t for t, _ in got[:30]] == [f"t{i}".encode() for i in range(30)] and 30 <= len(got) <= 50


def test_shards_share_a_round(docs_of, monkeypatch):
    """Four shards a round: each gets about a quarter of the round's documents."""
    monkeypatch.setattr(lm_gru, "BLOCK", 1_000)
    rounds, plain = [], lm_gru.map_partition

    def spy(df, schema, function):
        if "shard" in df.columns:
            rounds.append(Counter(r.shard for r in df.select("shard").collect()))
        return plain(df, schema, function)

    monkeypatch.setattr(lm_gru, "map_partition", spy)
    assert lm_gru.likelihood(docs_of([(i, "a b c d e f g") for i in range(2_000)])).count() == 2_000
    assert len(rounds) == lm_gru.ROUNDS and all(sorted(r) == [0, 1, 2, 3] and max(r.values()) < 2 * min(r.values()) for r in rounds)


def test_tokens_of_a_batch_against_bytes_split():
    import pyarrow as pa

    rng = random.Random(3)
    texts = [bytes(rng.choice(b" \t\n\x0b\x0c\rabAZ\x1c\x1f\x85\xa0\xc3\xff\x00") for _ in range(rng.randrange(30))) for _ in range(2_000)] + [b"", b" ", b" a", b"a "]
    for skip in (0, 5):  # a slice as well
        words, sizes = lm_gru.tokens(pa.array(texts, pa.binary()).slice(skip))
        words, ends = words.to_pylist(), np.cumsum(sizes)
        assert [words[e - n:e] for e, n in zip(ends, sizes)] == [[*t.lower().split(), b""] for t in texts[skip:]]
    cuts = list(lm_gru.pieces(np.array([lm_gru.PIECE * 3, 1, 1, lm_gru.PIECE, 0, 0])))
    assert cuts == [slice(0, 1), slice(1, 4), slice(4, 6)] and not list(lm_gru.pieces(np.array([], np.int64)))


def test_scoring_needs_less_time_than_a_row_for_each_token():
    """Many sums over short rows cost more than a few over long columns; both give the same scores."""
    import time

    net = lm_gru.Network(np.arange(1.0, 1025.0))
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 1024, 64) for _ in range(512)]
    p, n = net.p, net.hidden

    def softmax(x, at):
        x = x - x.max(-1, keepdims=True)
        return x[np.arange(len(x)), at] - np.log(np.exp(x).sum(-1))

    def by_rows():
        wanted = np.array(texts).T
        table, h, last, out = p["embed"] @ p["wx"] + p["bx"], np.zeros((512, n), np.float32), np.zeros(512, int), np.zeros(512)
        for at in range(0, 64, 16):
            states = []
            for t in range(at, at + 16):
                x, y = table[last], h @ p["wh"]
                gates = 0.5 + 0.5 * np.tanh(0.5 * (x[:, :2 * n] + y[:, :2 * n]))
                candidate = np.tanh(x[:, 2 * n:] + gates[:, n:] * y[:, 2 * n:])
                h, last = candidate + gates[:, :n] * (h - candidate), wanted[t]
                states.append(h)
            flat, kind, inside = np.concatenate(states), wanted[at:at + 16].ravel() // net.size, wanted[at:at + 16].ravel() % net.size
            logs = softmax(flat @ p["cw"] + p["cb"], kind)
            for c in range(net.classes):
                some = np.flatnonzero(kind == c)
                logs[some] += softmax(flat[some] @ p["ow"][c] + p["ob"][c], inside[some])
            out += logs.reshape(16, 512).sum(0)
        return out

    def least(function):
        spent = []
        for _ in range(7):
            start = time.thread_time()
            made = function()
            spent.append(time.thread_time() - start)
        return made, min(spent)

    (plain, slow), (scores, fast) = least(by_rows), least(lambda: net.score(texts, end=0))
    assert np.allclose(plain, scores, rtol=1e-4)
    assert fast < 0.85 * slow
