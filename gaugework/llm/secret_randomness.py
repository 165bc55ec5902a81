"""Secret scans: fixed patterns, and a battery of randomness tests with length-aware false-discovery control.

Base spans (assign, access, hex) are the leftmost non-overlapping matches of three patterns; matches
that fail their length rule are dropped, not retried.

The method adds spans of kind ``random``. Candidates are maximal runs of base64 and URL-safe
characters of ``LEAST`` or more that mix digits or capitals with other letters and touch no base
span. For each one the narrowest alphabet that holds it is inferred (hex, base32, base36, base62,
base64), and three tests ask whether it could be a uniform draw from it: chi-squared uniformity of
the alphabet, runs about the alphabet's middle, lag-1 serial correlation. Their p-values combine
by Fisher's sum; a small sum means that nothing speaks against randomness.

How often plain text looks as random is learned from the corpus itself: the lower-case words of
every document, joined, are cut into strings of each class's least length in turn (decoys), which go
through the same battery. In each length class the share of decoys with a sum as small gives a
candidate's p-value, and Benjamini-Hochberg at ``RATE`` keeps a prefix of the class. A class with
under ``1 / RATE`` decoys (all texts short) takes those of the next shorter class that has them:
shorter text looks more random, so its p-values are on the safe side. Both histograms cover all
documents and are tables of classes times bins.

Offsets are code points, ends exclusive. Edge cases: a null text is empty; null ids are carried
through; repeated rows each keep their row and count as often as they appear; an empty table gives
no rows; a corpus without lower-case a-z words has no decoys, every p-value is 1 and nothing is added.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import map_batches, sha256_hex, spans_text, stored

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
LEAST = 16
RATE = 0.01
BINS = 64
CLASSES = (16, 20, 24, 32, 48, 64)
PIECE = 4096
SLICE = 1 << 20


def base_spans(text: str, runs: list[re.Match]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns; ``runs`` are the text's matches of LONG, in which
    every kept access and hex match lies."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    for run in runs:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, run.start(), run.end()) if len(m[0]) >= 18]
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text, run.start(), run.end()) if len(m[0]) >= 16]
    return sorted(out)


# ---- the battery -------------------------------------------------------------------------------

def _alphabets() -> list[np.ndarray]:
    """Symbol numbers by character code, -1 outside: hex, base32, base36, base62, base64."""
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    made = []
    for letters in (digits + "abcdef", digits + "ABCDEF", upper + "234567", digits + lower, digits + upper, digits + upper + lower):
        table = np.full(128, -1, np.int64)
        table[[ord(c) for c in letters]] = range(len(letters))
        made.append(table)
    table = np.full(128, -1, np.int64)
    table[[ord(c) for c in upper + lower + digits + "+/"]] = range(64)
    table[[ord("-"), ord("_"), ord("=")]] = 62, 63, 0
    return [*made, table]


ALPHABETS = _alphabets()


def _tail(z: np.ndarray) -> np.ndarray:
    """Upper tail of the normal distribution (a rational approximation, error under 1e-7)."""
    t = 1 / (1 + 0.2316419 * np.abs(z))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = np.exp(-z * z / 2) / np.sqrt(2 * np.pi) * poly
    return np.where(z >= 0, upper, 1 - upper)


def battery(strings: list[str]) -> np.ndarray:
    """Fisher's sum of the three p-values for each ASCII string of two characters or more."""
    out = np.zeros(len(strings))
    for at in range(0, len(strings), PIECE):
        some = strings[at:at + PIECE]
        codes = np.frombuffer("".join(some).encode("ascii"), np.uint8)
        n = np.array([len(s) for s in some])
        first = np.concatenate([[0], np.cumsum(n)[:-1]])
        owner = np.repeat(np.arange(len(some)), n)
        symbols, size = np.full(len(codes), -1), np.zeros(len(some))
        for table in ALPHABETS:  # the first alphabet that holds the whole string
            held = np.minimum.reduceat(table[codes], first) >= 0
            new = held & (size == 0)
            size[new] = 64 if table is ALPHABETS[-1] else (table >= 0).sum()
            symbols = np.where(new[owner], table[codes], symbols)
        counts = np.bincount(owner * 64 + symbols, minlength=len(some) * 64).reshape(-1, 64)
        chi2 = size / n * (counts.astype(float) ** 2).sum(1) - n
        df = size - 1
        z = ((np.maximum(chi2, 1e-9) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / np.sqrt(2 / (9 * df))
        p = [_tail(z)]
        high = symbols >= size[owner] / 2
        inside = np.ones(len(codes), bool)
        inside[first] = False
        change = np.zeros(len(codes))
        change[1:] = high[1:] != high[:-1]
        runs = 1 + np.add.reduceat(change * inside, first)
        n1 = np.add.reduceat(high.astype(float), first)
        n2 = n - n1
        mean = 2 * n1 * n2 / n + 1
        var = np.maximum((mean - 1) * (mean - 2) / np.maximum(n - 1, 1), 1e-9)
        p.append(np.where((n1 == 0) | (n2 == 0), 2.0 ** (1 - n), np.minimum(1, 2 * _tail(np.abs(runs - mean) / np.sqrt(var)))))
        x = symbols - (np.add.reduceat(symbols.astype(float), first) / n)[owner]
        lag = np.zeros(len(codes))
        lag[1:] = x[1:] * x[:-1]
        r = np.add.reduceat(lag * inside, first) / np.maximum(np.add.reduceat(x * x, first), 1e-9)
        p.append(np.minimum(1, 2 * _tail(np.abs(r) * np.sqrt(n))))
        out[at:at + PIECE] = -2 * sum(np.log(np.maximum(q, 1e-30)) for q in p)
    return out


def length_class(n: int) -> int:
    return sum(n >= c for c in CLASSES) - 1


def _bins(strings: list[str]) -> list[int]:
    """class * BINS + bin of Fisher's sum: 64 bins over 0 to 128, the last one open."""
    values = np.minimum(battery(strings) / 2, BINS - 1).astype(int) if strings else []
    return [length_class(len(s)) * BINS + int(v) for s, v in zip(strings, values)]


def candidates(runs: list[re.Match], base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans of the candidates among the runs."""
    spans = []
    for run in runs:
        s = run[0]
        if not s.isdigit() and any(c.isdigit() for c in s) + any(c.isupper() for c in s[1:]) + any(c.islower() for c in s) > 1:
            if all(end <= run.start() or start >= run.end() for start, _, end in base):
                spans.append((run.start(), run.end()))
    return spans


def decoys(text: str) -> Iterator[str]:
    """The text's lower-case words joined and cut into a string of each class's least length in turn,
    from a class that depends on the words; the end is cut to the longest class that it holds."""
    rest, k = "", -1
    for at in range(0, len(text), SLICE):
        rest += "".join(w for w in text[at:at + SLICE].split() if w.isascii() and w.isalpha() and w.islower())
        k = zlib.crc32(rest.encode()) % len(CLASSES) if k < 0 else k
        done = 0
        while len(rest) - done >= CLASSES[k]:
            yield rest[done:done + CLASSES[k]]
            done += CLASSES[k]
            k = (k + 1) % len(CLASSES)
        rest = rest[done:]
    if len(rest) >= LEAST:
        yield rest[:CLASSES[length_class(len(rest))]]


# ---- the operator ------------------------------------------------------------------------------

def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))


def _scan(ids: pa.Array, texts: pa.Array):
    """Base spans as flat triples, candidates as flat pairs with their bins, and the decoys' bins."""
    base, spans, bins = [], [], []
    by_row: list[list[int]] = [[] for _ in range(len(texts))]
    plain: list[str] = []
    owners: list[int] = []

    def judge() -> None:
        for i, b in zip(owners, _bins(plain)):
            by_row[i].append(b)
        plain.clear()
        owners.clear()

    for i, t in enumerate(texts):
        text = t.as_py()
        runs = list(LONG.finditer(text))
        found = base_spans(text, runs)
        some = candidates(runs, found)
        base.append([x for span in found for x in span])
        spans.append([x for span in some for x in span])
        bins.append(_bins([text[a:b] for a, b in some]))
        for s in decoys(text):
            plain.append(s)
            owners.append(i)
            if len(plain) >= PIECE:
                judge()
    judge()
    return ids, base, spans, bins, by_row


def kept_bins(found: DataFrame, rate: float = RATE) -> set[int]:
    """The class * BINS + bin values that false-discovery control keeps."""
    targets, plain = np.zeros((len(CLASSES), BINS)), np.zeros((len(CLASSES), BINS))
    for counts, column in ((targets, "bins"), (plain, "decoys")):
        for r in found.select(F.explode(column).alias("b")).groupBy("b").agg(F.count("*").alias("n")).collect():  # classes times bins at most
            counts[divmod(r["b"], BINS)] = r["n"]
    keep: set[int] = set()
    for c in range(len(CLASSES)):
        null = next((plain[k] for k in range(c, -1, -1) if plain[k].sum() * rate >= 1), plain[c])
        p = (null.cumsum() + 1) / (null.sum() + 1)
        passes = p * targets[c].sum() / np.maximum(targets[c].cumsum(), 1) <= rate
        if passes.any():
            keep |= {c * BINS + b for b in range(int(np.flatnonzero(passes)[-1]) + 1)}
    return keep


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, base_sha256, spans), one row per row of ``docs``."""
    raw = map_batches(_texts(docs, id_col, text_col), "id long, base array<int>, spans array<int>, bins array<int>, decoys array<int>", _scan)
    found = stored(raw, "secrets")
    keep = kept_bins(found, rate)

    def run(ids: pa.Array, base: pa.Array, spans: pa.Array, bins: pa.Array):
        rows = []
        for b, s, k in zip(base.to_pylist(), spans.to_pylist(), bins.to_pylist()):
            own = list(zip(b[::3], b[1::3], b[2::3]))
            more = [(x, 3, y) for x, y, z in zip(s[::2], s[1::2], k) if z in keep]
            n = [sum(x[1] == kind for x in own) for kind in range(3)]
            rows.append((*n, sha256_hex(spans_text(own, KINDS).encode()), spans_text(sorted(own + more), KINDS)))
        return ids, *zip(*rows)

    schema = f"{id_col} long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_batches(found.select("id", "base", "spans", "bins"), schema, run)


def merged(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Overlapping spans joined, in order."""
    start = end = -1
    for a, b in sorted(spans):
        if a >= end:
            if end > start:
                yield start, end
            start, end = a, b
        end = max(end, b)
    if end > start:
        yield start, end


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", rate: float = RATE) -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; null texts stay null. The kept bins
    come from a first pass over all texts; the second pass finds the same spans again and cuts them out."""
    first = map_batches(_texts(docs.withColumn("_none", F.lit(None).cast("long")), "_none", text_col),
                        "id long, base array<int>, spans array<int>, bins array<int>, decoys array<int>", _scan)
    keep = kept_bins(stored(first.select("bins", "decoys").filter("size(bins) > 0 OR size(decoys) > 0"), "secret-bins"), rate)

    @F.arrow_udf("string")
    def cut(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            if t is not None:
                runs = list(LONG.finditer(t))
                base = base_spans(t, runs)
                some = candidates(runs, base)
                spans = [(a, b) for a, _, b in base] + [x for x, k in zip(some, _bins([t[a:b] for a, b in some])) if k in keep]
                at, parts = 0, []
                for a, b in merged(spans):
                    parts += [t[at:a], mark]
                    at = b
                t = "".join(parts) + t[at:]
            out.append(t)
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, cut(F.col(text_col).cast("string")))
