"""Personal data: fixed patterns, then candidate spans judged by gradient-boosted trees.

Base spans (email, ip, card, phone) are the leftmost non-overlapping matches of four patterns, each
scanned in time linear in the text; matches that fail their rule are dropped, not retried.

The method adds spans. High-recall generators propose overlapping candidates of each kind, among
them parts of longer runs that a base pattern swallowed or dropped (a card number right after a
phone number), and addresses written with "at" and "dot". Boosted trees score each candidate by its
format (lengths, digits, separators, checksum, groups) and its context (characters on both sides,
words before it). There is no hand-labelled table, so a candidate's weak label is whether it stands
alone and shows evidence of its kind: the whole of it passes the strict rule; an address written
with "at" and "dot" ends in a plausible top-level domain; a number without + is grouped as national
telephone numbers are, or has a telephone word before it (plain long numbers are negatives). Each
address and telephone number that passes its strict rule also gives the trees the same candidate
rewritten in these other forms, as one more positive in the same place. A logistic
calibration on candidates held out from the trees gives probabilities, and each kind's threshold is
the smallest probability at which its held-out precision reaches ``PRECISION``; a kind with under
``LEAST_HELD`` held-out candidates in the whole table takes the threshold of all kinds together.
Selected candidates that touch no base span are added, the likeliest first where they overlap.

Candidates are generated over all documents. A third of them by hash is always held out; of the other
distinct ones about ``SAMPLE_ROWS`` of each kind, in the order of the hash, fit the trees, and what
they leave is held out too. Held-out candidates are scored on Spark and summed into histograms of
kind, label and score (``BINS`` bins), from which calibration and thresholds are read.

Offsets are code points, ends exclusive. Edge cases: a null text is empty; null ids are carried
through; repeated rows each keep their row and count as often where they are held out; an empty table
gives no rows; without candidates to fit on only base spans are found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import map_batches, map_partition, sha256_hex, spans_text, stored

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS = 5_000
BINS, WIDTH = 512, 1 / 16
CHUNK = 10_000
PRECISION = 0.98
LEAST_HELD = 20

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBERS = re.compile(r"\+?[0-9(][\x20().0-9-]{5,}[0-9]")


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def ip_ok(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def card_ok(text: str) -> bool:
    number = digits(text)
    return 14 <= len(number) <= 19 and luhn(number)


def phone_ok(text: str) -> bool:
    return 10 <= len(digits(text)) <= 15


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: from each @ to both sides, so a long run without one
    is read once."""
    out, floor = [], 0
    at = text.find("@")
    while at >= 0:
        left = text[floor:at]
        start = floor + len(left.rstrip(_LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            floor = domain.end()
        else:
            floor = at + 1
        at = text.find("@", floor)
    return out


def base_spans(text: str, number_runs: list[re.Match]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the four patterns. Every match of the number patterns that can pass its
    rule holds a run of seven characters or more from digits, spaces and ``().+-``."""
    out = [(a, 0, b) for a, b in emails(text)]
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if ip_ok(m[0])]
    if number_runs:
        out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if len(m[0]) >= 14 and card_ok(m[0])]
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if phone_ok(m[0])]
    return sorted(out)


# ---- candidates and their features -------------------------------------------------------------

WRITTEN_AT = re.compile(r"[A-Za-z0-9._-]{2,64} ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{2,64}(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]{2,64}){0,5} ?(?:\[dot\]|\(dot\)) ?[A-Za-z]{2,24}")
INNER_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{2,7}(?![0-9])")
INNER_PHONE = re.compile(r"(?<![0-9])\+?[0-9]{0,3}[\x20.-]?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])")
#: The part of a telephone number after its country code, and how national numbers are grouped.
NATIONAL = re.compile(r"\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}")
NATIONAL_END = re.compile(rf"(?<![0-9]){NATIONAL.pattern}(?![\x20().0-9-]*[0-9])")
GROUPED = re.compile(r"(?:1[\x20.-]?)?(?:\([0-9]{3}\)[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}|[0-9]{3}([.-])[0-9]{3}\1[0-9]{4})")
INNER_IP = re.compile(r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])")
#: Words before a span that speak for a kind.
CONTEXT = (("email", "mail", "contact"), ("ip", "host", "server", "address"), ("card", "visa", "credit", "number"), ("phone", "tel", "call", "mobile"))
#: Generic top-level domains; those of countries have two letters.
DOMAINS = frozenset("com org net edu gov mil int info biz name pro mobi app dev xyz online site tech store cloud museum aero coop jobs".split())

FEATURES = 23


def candidates(text: str, number_runs: list[re.Match]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of everything that could be personal data; may overlap."""
    found = {(a, 0, b) for a, b in emails(text)}
    if "(at)" in text or "[at]" in text:
        found |= {(m.start(), 0, m.end()) for m in WRITTEN_AT.finditer(text)}
    for run in number_runs:
        a, b = run.span()
        for kind, pattern in ((1, INNER_IP), (2, INNER_CARD), (3, INNER_PHONE)):
            for m in pattern.finditer(text, a, b):
                s = m[0]
                lead = len(s) - len(s.lstrip(" .-"))
                found.add((m.start() + lead, kind, m.end()))
                if kind == 3 and "+" not in s:  # digits before the national part may be another number
                    found |= {(x.start(), kind, m.end()) for x in NATIONAL_END.finditer(text, m.start(), m.end())}
    return sorted(found)


def strict(kind: int, s: str) -> bool:
    """The rule of a kind over a whole candidate."""
    if kind == 0:
        return emails(s) == [(0, len(s))]
    if kind == 1:
        return bool(IP.fullmatch(s)) and ip_ok(s)
    if kind == 2:
        return bool(CARD.fullmatch(s)) and card_ok(s)
    return bool(PHONE.fullmatch(s)) and phone_ok(s)


def plausible_domain(s: str) -> bool:
    last = re.search("[A-Za-z]*$", s[-25:])[0].lower()
    return len(last) == 2 or last in DOMAINS


def words_before(text: str, start: int) -> list[str]:
    return text[max(0, start - 32):start].lower().split()[-3:]


def label(text: str, start: int, kind: int, end: int) -> bool:
    """The weak label of a candidate: it stands alone and shows evidence of its kind."""
    s = text[start:end]
    if text[end:end + 1].isalnum() or text[start - 1:start].isalnum():
        return False
    if kind == 0 and "@" not in s:
        return plausible_domain(s)
    if kind == 3 and not s.startswith("+"):
        if text[start - 1:start] in ("+", "-", ".", "/"):  # a part of something longer
            return False
        return bool(GROUPED.fullmatch(s)) or bool(NATIONAL.fullmatch(s)) and any(w in b for w in CONTEXT[3] for b in words_before(text, start))
    return strict(kind, s)


def rewritten(kind: int, s: str) -> str | None:
    """An address or a telephone number in the form that the base patterns do not match."""
    if kind == 0 and "@" in s:
        name, host = s.rsplit("@", 1)
        made = f"{name} [at] {host.replace('.', ' [dot] ')}"
        return made if WRITTEN_AT.fullmatch(made) else None
    if kind == 3 and s.startswith("+"):
        made = re.sub(r"^\+[0-9]{1,3}[\x20.-]?(?=\(|[0-9]{3})", "", s)
        return made if GROUPED.fullmatch(made) else None
    return None


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    s, number = text[start:end], digits(text[start:end])
    left, right = text[start - 1:start], text[end:end + 1]
    before = words_before(text, start)
    groups = re.findall(r"[0-9]+", s)
    parts = [min(999, int(g[:4])) for g in groups]
    near = [sum(any(w in b for w in some) for b in before) for some in CONTEXT]
    return [kind, len(s), len(number), len(groups), max(map(len, groups), default=0), len(groups[-1]) if groups else 0,
            max(parts, default=0), s.count("."), s.count("-"), s.count(" "), s.startswith("+"), "(" in s and ")" in s, s.count("@"),
            luhn(number) if number else 0, sum(c.isalpha() for c in s), len(set(number)),
            left.isdigit() or left in ("+", "."), left.isalnum(), right.isdigit(), right.isalnum(), near[kind], sum(near) - near[kind],
            kind == 0 and plausible_domain(s)]


def packed(row: list[float]) -> bytes:
    return np.array(row, np.float32).tobytes()


def rewritten_features(text: str, start: int, kind: int, end: int) -> list[float] | None:
    """Features of the rewritten form of a candidate that passes its strict rule, in the same place."""
    s = text[start:end]
    made = rewritten(kind, s) if strict(kind, s) else None
    if made is None:
        return None
    before = text[max(0, start - 33):start]
    return features(before + made + text[end:end + 1], len(before), kind, len(before) + len(made))


# ---- boosted trees -----------------------------------------------------------------------------

class Trees:
    """Gradient boosting of the logistic loss: trees of ``depth`` with splits at quantiles."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.3, shrink: float = 1.0) -> None:
        self.rounds, self.depth, self.rate, self.shrink = rounds, depth, rate, shrink
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 17)[1:-1])) for f in range(x.shape[1])]
        prior = (y.sum() + 1) / (len(y) + 2)
        self.start = float(np.log(prior / (1 - prior)))
        margin = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            size = 2 ** self.depth - 1
            feature, cut, value = np.zeros(size, int), np.full(size, np.inf), np.zeros(2 ** self.depth)
            node = np.zeros(len(y), int)
            for at in range(size):
                here = node == at
                feature[at], cut[at] = self._split(x[here], g[here], h[here], cuts)
                node[here] = 2 * at + 1 + (x[here, feature[at]] > cut[at])
            for leaf in range(2 ** self.depth):
                here = node == size + leaf
                value[leaf] = -self.rate * g[here].sum() / (h[here].sum() + self.shrink)
            self.trees.append((feature, cut, value))
            margin += value[node - size]
        return self

    def _split(self, x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray]) -> tuple[int, float]:
        best = (1e-6, 0, np.inf)
        total = g.sum() ** 2 / (h.sum() + self.shrink)
        for f, points in enumerate(cuts):
            if len(points) and len(x):
                left = x[:, f][:, None] <= points
                gl, hl = g @ left, h @ left
                gain = gl ** 2 / (hl + self.shrink) + (g.sum() - gl) ** 2 / (h.sum() - hl + self.shrink) - total
                at = int(gain.argmax())
                best = max(best, (float(gain[at]), f, float(points[at])), key=lambda b: b[0])
        return best[1], best[2]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            out += value[node - len(cut)]
        return out


class Judge:
    """Trees, calibration and a threshold for each kind."""

    def __init__(self, trees: Trees, slope: float, shift: float, thresholds: list[float]) -> None:
        self.trees, self.slope, self.shift, self.thresholds = trees, slope, shift, thresholds

    def of_margin(self, margin: np.ndarray | float) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * np.asarray(margin) + self.shift)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.of_margin(self.trees.margin(x))


def score_bins(margin: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(margin / WIDTH) + BINS // 2, 0, BINS - 1).astype(int)


def judge(trees: Trees, counts: np.ndarray) -> Judge:
    """Calibration and thresholds from the held-out counts by kind, label and score bin."""
    edge = (np.arange(BINS) - BINS // 2) * WIDTH
    margin, (no, yes) = edge + WIDTH / 2, counts.sum(0)
    both = no + yes
    slope, shift = 1.0, 0.0
    for _ in range(200):  # Newton steps on the two numbers, damped
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        w, d = both * (p * (1 - p) + 1e-6), both * p - yes
        g = np.array([(d * margin).sum() + 1e-2 * (slope - 1), d.sum()])
        hess = np.array([[(w * margin ** 2).sum() + 1e-2, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        slope, shift = slope - 0.5 * step[0], shift - 0.5 * step[1]
        if np.abs(step).max() < 1e-6:
            break
    made = Judge(trees, max(float(slope), 1e-3), float(shift), [2.0] * len(KINDS))
    for kind in range(len(KINDS)):
        own = counts[kind] if counts[kind].sum() >= LEAST_HELD else counts.sum(0)
        if own.sum() < LEAST_HELD:
            continue
        right, all_ = own[1][::-1].cumsum()[::-1], own.sum(0)[::-1].cumsum()[::-1]
        good = np.flatnonzero((all_ > 0) & (right >= PRECISION * all_))
        if len(good):
            made.thresholds[kind] = max(0.5, float(made.of_margin(edge[good[0]])) if good[0] else 0.0)
    return made


# ---- the operator ------------------------------------------------------------------------------

def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Judge | None:
    """Trees from a bounded sample of the candidates of each kind, calibration and thresholds from all
    others; None without candidates."""

    def run(batches: Iterator[pa.RecordBatch]):
        rows: list[tuple[int, int, int, int, bytes, bytes | None]] = []
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                i, t = i.as_py(), text.as_py()
                for start, kind, end in candidates(t, list(NUMBERS.finditer(t))):
                    y = label(t, start, kind, end)
                    other = rewritten_features(t, start, kind, end) if y else None
                    rows.append((i, start, kind, int(y), packed(features(t, start, kind, end)), other and packed(other)))
                    if len(rows) >= CHUNK:
                        yield list(zip(*rows))
                        rows.clear()
        if rows:
            yield list(zip(*rows))

    drawn = map_partition(_texts(docs, id_col, text_col), "id long, start long, kind int, y int, x binary, more binary", run)
    order = F.pmod(F.xxhash64("id", "start", "kind", "x"), F.lit(3 << 40))
    some = stored(drawn, "pii-candidates").withColumn("held", order % 3 == 0).withColumn("at", (order / 3).cast("long") / float(1 << 40))
    pool = some.filter("NOT held").select("kind", "at", "y", "x", "more").distinct()
    sizes = {r["kind"]: r["n"] for r in pool.groupBy("kind").agg(F.count("*").alias("n")).collect()}  # a row a kind
    share = F.element_at(F.array(*[F.lit(sample_rows / max(sizes.get(k, 0), 1)) for k in range(len(KINDS))]), F.col("kind") + 1)
    got = pool.filter(F.col("at") < share).toPandas().sort_values(["at", "kind", "x"])  # about sample_rows a kind
    if len(got) < 4:
        return None

    def rows_of(column) -> np.ndarray:
        return np.frombuffer(b"".join(column), np.float32).reshape(-1, FEATURES).astype(float)

    extra = rows_of(got["more"].dropna())
    trees = Trees().fit(np.vstack([rows_of(got["x"]), extra]), np.append(got["y"].to_numpy(float), np.ones(len(extra))))

    def score(kinds: pa.Array, ys: pa.Array, xs: pa.Array):
        return kinds, ys, score_bins(trees.margin(rows_of(x.as_buffer() for x in xs)))

    counts = np.zeros((len(KINDS), 2, BINS))
    held = some.filter(F.col("held") | (F.col("at") >= share)).select("kind", "y", "x")
    for r in map_batches(held, "kind int, y int, bin int", score).groupBy("kind", "y", "bin").agg(F.count("*").alias("n")).collect():  # kinds times labels times bins at most
        counts[r["kind"], r["y"], r["bin"]] = r["n"]
    return judge(trees, counts)


def find(text: str, made: Judge | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, added spans)."""
    runs = list(NUMBERS.finditer(text))
    base = base_spans(text, runs)
    if made is None:
        return base, []
    own = np.array([(a, b) for a, _, b in base]).reshape(-1, 2)
    some = [c for c in candidates(text, runs) if not ((own[:, 0] < c[2]) & (own[:, 1] > c[0])).any()]
    if not some:
        return base, []
    x = np.array([features(text, *c) for c in some], np.float32).astype(float)
    p = made.probability(x)
    added: list[tuple[int, int, int]] = []
    for i in sorted(range(len(some)), key=lambda i: (-p[i], some[i])):
        c = some[i]
        if p[i] >= made.thresholds[c[1]] and all(c[2] <= a or c[0] >= b for a, _, b in added):
            added.append(c)
    return base, added


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row per row of ``docs``."""
    made = learn(docs, id_col, text_col)

    def run(ids: pa.Array, texts: pa.Array):
        rows = []
        for t in texts:
            base, added = find(t.as_py(), made)
            n = [sum(s[1] == kind for s in base) for kind in range(len(KINDS))]
            rows.append((*n, sha256_hex(spans_text(base, KINDS).encode()), spans_text(sorted(base + added), KINDS)))
        return ids, *zip(*rows)

    schema = f"{id_col} long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_batches(_texts(docs, id_col, text_col), schema, run)
