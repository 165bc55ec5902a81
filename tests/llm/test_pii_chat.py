"""Personal data and chat formatting against plain rules."""

import hashlib
import random
import re

import numpy as np
import pandas as pd

from gaugework.llm import chat_parts, pii_boost, queries

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (None, "a@b.c"), (4, "a@b.c@d.e x@y @z.w a@@b.c é@b.co.uk. 1.2.3.4.5.6.7.8 256.1.1.1 " + "9" * 5000 + ".1.1.1"), (4, "dup a@b.c"), (4, "dup a@b.c"),
       (5, "+1 (314) 555-6532 4663622617512349 4539 1488 0343 6467 +12 34567-8901"), (6, "@" * 1000 + "a" * 200_000 + "@x.y"), (7, "+1" + " " * 50_000 + "2")]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_pii(text):
    text = text or ""

    def luhn(n):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(n))) % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(len(p) < 4000 and int(p) <= 255 for p in s.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15)]
    found = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m[0]))
    return [sum(f[1] == k for f in found) for k in range(4)], ",".join(f"{rules[k][0]}:{a}:{b}" for a, k, b in found)


def check_pii(rows, texts):
    want = [(i, *plain_pii(t)) for i, t in texts if len(t or "") < 60_000 or i == 7]
    long = {i for i, t in texts if len(t or "") >= 60_000 and i != 7}
    got = [r for r in rows if r.doc_id not in long]
    assert len(rows) == len(texts)
    assert sorted((str(i), *n, digest(s)) for i, n, s in want) == sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got)


def test_pii_base_spans(spark, docs_of):
    texts = pd.read_parquet(f"{SF}/documents.parquet")
    rows = queries.op2_pii(spark, SF).collect()
    check_pii(rows, list(zip(texts.doc_id, texts.text)))
    by_id = {i: plain_pii(t)[1] for i, t in zip(texts.doc_id, texts.text)}
    for r in rows:
        assert set(filter(None, by_id[r.doc_id].split(","))) <= set(r.spans.split(","))
    rows = pii_boost.scan(docs_of(ODD)).collect()
    check_pii(rows, ODD)
    assert [r.n_email for r in rows if r.doc_id == 6] == [1]  # a long run without @ is read once
    assert pii_boost.scan(docs_of([])).count() == 0


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, (2000, 4)).astype(float)
    y = ((x[:, 0] == x[:, 1]) & (x[:, 2] > 0)).astype(float)
    trees = pii_boost.Trees(rounds=30).fit(x, y)
    assert ((trees.margin(x) > 0) == (y > 0)).mean() > 0.99


def test_pii_adds_spans_that_base_matches_lost(docs_of):
    rng = random.Random(4)

    def card():
        body = "4" + "".join(rng.choices("0123456789", k=14))
        return next(body + str(d) for d in range(10) if pii_boost.luhn(body + str(d)))

    def phone():
        return f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"

    rows = []
    for i in range(600):
        kind = i % 6
        rows.append((i, "the and " + [card(), phone(), f"{rng.randint(1, 250)}.{rng.randint(1, 250)}.1.2", f"a{i}@mail.org", str(rng.randint(10**15, 10**16 - 1)), f"{phone()} {card()}"][kind] + " for with"))
    out = {r.doc_id: r for r in pii_boost.scan(docs_of(rows)).collect()}
    lost = [out[i] for i in range(5, 600, 6)]
    assert all(r.n_phone == 0 for r in lost)
    assert sum("phone:8:25" in r.spans and "card:26:42" in r.spans for r in lost) > 0.9 * len(lost)
    wrong = [out[i] for i, t in rows if i % 6 == 4 and not pii_boost.luhn(t[8:24])]
    assert sum(bool(r.spans) for r in wrong) < 0.1 * len(wrong)


def test_pii_adds_written_addresses_and_national_numbers(docs_of):
    rng = random.Random(8)
    words = ["the", "and", "river", "gauge", "level", "for", "with", "area", "report"]
    rows, want = [], {}
    for i in range(1200):
        number = f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        some = [f"+1 {number}", f"a{i}@mail{i % 9}.org", f"name{i} [at] host{i % 7} [dot] org", number, number[1:4] + "-" + number[6:], str(rng.randint(10**9, 10**10 - 1)),
                f"call {number[1:4]}{number[6:9]}{number[10:]}", f"a{i} [at] b{i} [dot] notadomain"][i % 8]
        before = " ".join(rng.choices(words, k=4)) + " "
        rows.append((i, before + some + " " + " ".join(rng.choices(words, k=4))))
        at = len(before) + (5 if some.startswith("call") else 0)
        want[i] = f"{'email' if i % 8 == 2 else 'phone'}:{at}:{len(before) + len(some)}"
    out = {r.doc_id: r.spans for r in pii_boost.scan(docs_of(rows)).collect()}
    for form in (2, 3, 4, 6):
        mine = [out[i] == want[i] for i in range(form, 1200, 8)]
        assert sum(mine) > 0.9 * len(mine), form
    for form in (5, 7):
        assert sum(bool(out[i]) for i in range(form, 1200, 8)) < 0.05 * 150, form


def test_pii_labels_do_not_rest_on_the_base_patterns():
    def labels(text):
        return {text[a:b]: pii_boost.label(text, a, k, b) for a, k, b in pii_boost.candidates(text, list(pii_boost.NUMBERS.finditer(text)))}

    assert labels("id 980 (314) 555-6532 x") == {"980 (314) 555-6532": False, "(314) 555-6532": True}
    assert labels("write bob [at] host [dot] co [dot] uk now") == {"bob [at] host [dot] co [dot] uk": True}
    assert labels("id 3145556532") == {"3145556532": False} and labels("phone 3145556532") == {"3145556532": True}
    assert labels("100 200 3000") == {"100 200 3000": False}


def test_pii_thresholds_come_from_all_documents(docs_of):
    """Personal data in one document of a hundred: 4,000 documents would hold too few candidates of a kind."""
    rng = random.Random(9)
    rows, want = [], {}
    for i in range(9000):
        text = "the and for with river"
        if i % 100 == 0:
            text += f" name{i} [at] host{i % 7} [dot] org" if i % 300 == 0 else f" a{i}@mail{i % 9}.org"
        if i % 300 == 0:
            want[i] = f"email:23:{len(text)}"
        rows.append((i, text + " area " + rng.choice(["level", "gauge"])))
    out = {r.doc_id: r.spans for r in pii_boost.scan(docs_of(rows)).collect()}
    assert sum(out[i] == s for i, s in want.items()) > 0.9 * len(want)


def test_pii_repeated_rows_stay_bounded_and_count(docs_of):
    rows = [(7, "see +1 (314) 555-6532 now")] * 3000 + [(i, f"see a{i}@b.org now") for i in range(100)]
    out = pii_boost.scan(docs_of(rows)).collect()
    assert len(out) == 3100 and all(r.spans == "phone:4:21" for r in out if r.doc_id == 7 and r.n_phone)


def plain_chat(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {c: (len(t), digest("".join(f"{r}\n{x}\n" for r, x in t)), sum(len(x) for r, x in t if r == "assistant"),
                digest("".join(x for r, x in t if r == "assistant"))) for c, t in out.items()}


def check_chat(got, rows):
    want = plain_chat(rows)
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want and len(got) == len(want)


def test_chat_whole_table(spark):
    c = pd.read_parquet(f"{SF}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in c.itertuples()]
    t = "\\### Assistant: </turn> ok"
    check_chat(queries.op10_chat(spark, SF).collect(), rows + [(-7, 0, "user", t), (-7, 1, "assistant", t)])


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, None, "assistant", "<|end|>\n<|start|>assistant<|sep|> \\<|"), (None, 1, "assistant", "a"), (2, 5, "assistant", "\\"),
            (2, 5, "assistant", "\\"), (2, 4, "as<|sep|>sistant", "<\\|end|>"), (3, 0, "assistant", ""), (4, 0, "assistant", "é" * 100_000), (5, 0, "user", "<|image:0|>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    check_chat(chat_parts.format_conversations(df).collect(), rows)
    assert chat_parts.format_conversations(df.limit(0)).count() == 0
    assert chat_parts.format_conversations(df.limit(0), [(-7, 0, "user", "x")]).count() == 1


def test_chat_hot_conversation(spark):
    rows = [(i if i % 3 else 9, i, ["user", "assistant"][i % 2], f"t{i} <|x") for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    check_chat(chat_parts.format_conversations(df).collect(), rows)


def test_parts_become_ordered_placeholders(spark):
    parts = [{"type": "text", "text": "see <|image:0|> "}, {"type": "image", "ref": "i.png", "width": 1024, "height": 513}, {"type": "audio", "ref": "a", "seconds": 1.2},
             {"type": "document", "ref": "d", "pages": 3}, None, {"type": "text", "text": None}]
    flat = chat_parts.flatten(parts)
    assert flat.attachments == [(0, "image", "i.png", 4), (1, "audio", "a", 50), (2, "document", "d", 768)] and flat.tokens == 822
    piece = chat_parts.format_turn("assistant", "".join(flat.content))
    assert chat_parts.parse_turn(piece) == ("assistant", "see <|image:0|> ", "see <|image:0|> ")
    df = spark.createDataFrame([(1, 0, "assistant", parts)], f"conv_id long, turn long, role string, parts {chat_parts.PARTS}").selectExpr("*", "'' AS text")
    row = chat_parts.format_turns(df, parts_col="parts").first()
    assert row.piece == piece and row.tokens == 822 and piece[row.loss_start:row.loss_end] == "".join(flat.content)
    assert row.attachments == "0:image:4:i.png,1:audio:50:a,2:document:768:d"
