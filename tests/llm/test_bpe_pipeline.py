"""Byte-level BPE against a published implementation, streaming decode, and the pipeline's stages."""

import base64
import hashlib
import random

import pandas as pd
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from gaugework.llm import bpe_transducer, decontam_lsa, queries, secret_randomness, simhash_bktree, toxicity_fm
from gaugework.llm.common import documents

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def plain():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def hexes(plain, text):
    ids = plain.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


ODD = [(1, None), (2, ""), (3, " "), (4, "  a \n\n b\t"), (None, "x"), (5, "dup"), (5, "dup"), (6, "\x1ca\x85b　c 😀😀 １２ ①"), (7, "ab" * 40_000), (8, "word " * 120_000), (9, "   x"), (10, "it's I'LL don't")]


def test_round_trip_whole_table_and_odd_rows(spark, docs_of, plain):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    for rows, texts in ((queries.op3_bpe(spark, SF), list(zip(docs.doc_id, docs.text))), (bpe_transducer.round_trip(docs_of(ODD), PATH, PATTERN), ODD)):
        got = rows.collect()
        assert all(r.same_text for r in got)
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted((str(i), *hexes(plain, t)) for i, t in texts)
    assert bpe_transducer.round_trip(docs_of([]), PATH, PATTERN).count() == 0


def test_encode_then_decode(docs_of):
    encoded = bpe_transducer.encode(docs_of(ODD), PATH, PATTERN)
    back = bpe_transducer.decode(encoded, PATH, PATTERN)
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(i), t or "") for i, t in ODD)


def test_transducer_with_a_full_table(plain, monkeypatch):
    rng = random.Random(1)
    pieces = ["a", "b", "the", " ", "  ", "\n", "é", "中", "1", "'s", "ing", "!", "tion", "A", "_", "😀", "er", "un"]
    for states in (1, 50, 20_000):
        monkeypatch.setattr(bpe_transducer, "STATES", states)
        monkeypatch.setattr(bpe_transducer, "WORDS", states)
        tool = bpe_transducer.Codec({t: r for t, r in plain._mergeable_ranks.items()}, PATTERN)
        for _ in range(400):
            text = "".join(rng.choices(pieces, k=rng.randint(0, 25)))
            assert [i for part in tool.encode(text) for i in part.tolist()] == plain.encode_ordinary(text)


def test_chunks_change_nothing(plain, monkeypatch):
    tool = bpe_transducer.codec(PATH, PATTERN)
    text = "the  quick\n\nbrown fox's  " * 50
    for size in (1, 7, 100):
        assert "".join(tool.chunks(text, size)) == text
        ids = [i for c in tool.chunks(text, size) for part in tool.encode(c) for i in part.tolist()]
        assert ids == plain.encode_ordinary(text)


def test_utf8_stream_by_single_bytes():
    for text in ("aé中😀z", "", "😀" * 3):
        stream = bpe_transducer.Utf8Stream()
        assert "".join(stream.feed(bytes([b])) for b in text.encode()) + stream.close() == text
    stream = bpe_transducer.Utf8Stream()
    assert stream.feed(b"a\xe4\xb8") + stream.close() == "a�"


def test_stages_against_brute_force(spark):
    """Each stage is judged on its own input: what it keeps follows from its operator's rows."""
    docs = documents(spark, SF)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-dedup", "benchmark decontamination", "secret scans", "byte-level BPE"]
    for name, stage in corpus_pipeline.STAGES:
        before, after = docs.toPandas(), stage(spark, docs, SF)
        rows = after.toPandas()
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity_fm.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.predicted}
            want = before[~before.doc_id.isin(bad)]
        elif name == "simhash near-dedup":
            want = before[before.doc_id.isin({r.component_id for r in simhash_bktree.near_duplicates(docs).collect()})]
        elif name == "benchmark decontamination":
            bad = {r.doc_id for r in decontam_lsa.leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            want = before[~before.doc_id.isin(bad)]
        elif name == "secret scans":
            spans = {r.doc_id: r.spans for r in secret_randomness.scan(docs).collect()}
            want = before.copy()
            for i, r in before.iterrows():
                cuts = [(int(s.split(":")[1]), int(s.split(":")[2])) for s in spans[r.doc_id].split(",") if s]
                text = r.text
                for a, b in reversed(list(secret_randomness.merged(cuts))):
                    text = text[:a] + "[SECRET]" + text[b:]
                if text != r.text:
                    want.loc[i, ["text", "n_chars"]] = [text, len(text)]
        else:
            assert sorted(rows.doc_id) == sorted(before.doc_id) and rows.same_text.all()
            continue
        assert list(rows.columns) == ["doc_id", "text", "lang", "source", "n_chars"]
        key = ["doc_id", "text"]
        pd.testing.assert_frame_equal(rows.sort_values(key).reset_index(drop=True), want.sort_values(key).reset_index(drop=True), check_dtype=False)
        docs = spark.createDataFrame(rows, documents(spark, SF).schema)


def test_stages_with_odd_documents(spark):
    rows = [(1, None, None, None, None), (2, "", "en", None, 0), (None, "lonely words here", None, "s", 3), (None, None, None, None, None), (4, "same text as the other", "en", "s", 22),
            (5, "same text as the other", "fr", "s", 22), (5, "same text as the other", "fr", "s", 22), (6, "token=abcdefghijklmnopqrst " * 20_000, "en", "s", 1)]
    schema = documents(spark, SF).schema
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), schema)
        out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        assert all(r.same_text for r in out)
        if given:
            ids = [r.doc_id for r in out]
            assert ids.count(4) == 1 and 5 not in ids and ids.count(6) == 1 and ids.count(None) == 1
            assert "abcdefghijklmnopqrst" not in "".join(r.text or "" for r in docs.collect())
