"""Language-model scoring with a gated recurrent network in numpy.

Tokens are words (A-Z lower-cased, runs without space and 0x09-0x0D), then one end token per text.
Training documents are those whose crc32 of the id, modulo ``folds``, is not ``held``.

Over all training documents, on Spark: token counts, their total N and the number V of distinct
tokens (``base_score`` is the add-one unigram score over them), the network's vocabulary, its
classes and output biases, and the counts of all tokens outside the vocabulary.

The network: the ``VOCABULARY - 1`` most frequent tokens and one symbol for all others; an embedding, a
gated recurrent layer, and a softmax factored into a class and a token inside it, so a step costs
two softmaxes of ``CLASSES`` and ``VOCABULARY / CLASSES``. Its weights are fitted by truncated
backpropagation (windows of ``WINDOW`` tokens, state carried over) on every training document. They
start from a bounded sample fitted on the driver: training documents in the order of xxhash64 of the
id, up to ``SAMPLE_DOCS`` of them and ``SAMPLE_TOKENS`` tokens (a text that does not fit is left out).
Then all training documents, long ones too, go through ``ROUNDS`` rounds by xxhash64 of id and text,
each in one round and there in one of as many shards as the round has ``BLOCK`` tokens: every shard goes
on from the weights so far with its documents in the order of the hash, ``BLOCK`` tokens at a time, and Spark
averages the shards' changes, weighted by tokens, in whole numbers. So the weights depend on the documents
alone, not on the input's files or the cluster's size. Every text is split into tokens twice, once to
count and once to write it as two-byte numbers, which training and scoring read; Arrow's kernels split,
count and look up ``PIECE`` bytes of texts at a time. The network keeps tokens and lanes in columns, so
that its sums over classes and gates run along memory.

Scoring runs over every whole text: texts of similar length advance in lockstep, window by window,
their states carried across windows, so memory is bounded by lanes times window whatever a text's
length. A token outside the vocabulary has the network's probability of "other" times its add-one
share of it, (c + 1) / (R + T + 1): R training tokens outside the vocabulary, T distinct ones. As in
``base_score``, all tokens never seen are one more symbol.

Counts of the most frequent tokens, ``COMMON`` at most, travel to the tasks (a bounded table, chosen by a
histogram of counts, so that the driver gets no more of them at any size); all others are found by a
join on the token, which holds no frequent key.

Edge cases: a null text is empty and is scored for its end token; a null id counts as crc32 of '';
repeated rows each keep their row and count as often in training; without training documents N is
0 and V is 0, every base probability is 1, and the model is untrained; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import bucket, map_batches, map_partition, stored, text_bytes

END = b""  # no word is empty
VOCABULARY, CLASSES = 1024, 32
HIDDEN, EMBEDDING = 24, 16
WINDOW = 16
LANES, UPDATES = 512, 128
SAMPLE_DOCS, SAMPLE_TOKENS = 2_000, 400_000
ROUNDS, ROUND_RATE, BLOCK = 4, 0.004, 1 << 20
UNIT = float(1 << 20)
COMMON, STEPS = 100_000, 16
PIECE = 1 << 22


def pieces(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of texts of ``PIECE`` bytes and one text at most."""
    ends = np.cumsum(sizes)
    cuts = np.flatnonzero(np.diff((ends - sizes) // PIECE)) + 1
    return map(slice, [0, *cuts.tolist()], [*cuts.tolist(), len(sizes)]) if len(sizes) else iter(())


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all texts, one after the other, and the number of each text's tokens. The kernels work
    on bytes: A-Z only, runs without space and 0x09-0x0D, whatever the other bytes are. A space at the end
    makes the empty end token; one at the beginning would make another."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.binary_join_element_wise(texts.view(pa.string()), "", " ")))
    words, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy()
    ends = np.cumsum(sizes, dtype=np.int64)
    kept = pc.binary_length(words).to_numpy() > 0
    kept[ends - 1] = True
    return (words if kept.all() else words.filter(pa.array(kept))).view(pa.binary()), np.add.reduceat(kept, ends - sizes, dtype=np.int64)


# ---- the network -------------------------------------------------------------------------------

def _softmax(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-softmax of one entry of each column, and the columns' sums; ``x`` becomes the summands."""
    x -= x.max(0)
    wanted = x[at, np.arange(len(at))]
    np.exp(x, out=x)
    total = x.sum(0)
    return wanted - np.log(total), total


class Network:
    """Parameters by name in ``p``; gates are ordered update, reset, candidate."""

    def __init__(self, counts: np.ndarray, hidden: int = HIDDEN, embedding: int = EMBEDDING, classes: int = CLASSES, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.hidden, self.classes, self.size = hidden, classes, -(-len(counts) // classes)
        some = np.zeros(classes * self.size)
        some[:len(counts)] = counts + 0.5
        by_class = some.reshape(classes, self.size)
        by_class[by_class.sum(1) == 0] = 1e-9  # a class without tokens is never asked for
        with np.errstate(divide="ignore"):
            inside = np.log(by_class / by_class.sum(1, keepdims=True))
        normal = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.p = {"embed": normal(len(some), embedding), "wx": normal(embedding, 3 * hidden), "bx": np.zeros(3 * hidden, np.float32), "wh": normal(hidden, 3 * hidden),
                  "cw": normal(hidden, classes), "cb": np.log(by_class.sum(1) / by_class.sum()).astype(np.float32),
                  "ow": normal(classes, hidden, self.size), "ob": np.maximum(inside, -30).astype(np.float32)}

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state for input projections ``x`` and states ``h``, and what backpropagation needs.
        Here and below a column is a lane or a token: sums over classes and gates then run along memory."""
        n = self.hidden
        y = self.p["wh"].T @ h
        gates = x[:2 * n] + y[:2 * n]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        update, reset = gates[:n], gates[n:]
        candidate = reset * y[2 * n:]
        candidate += x[2 * n:]
        np.tanh(candidate, out=candidate)
        after = h - candidate
        after *= update
        after += candidate
        return after, update, reset, candidate, y[2 * n:]

    def by_class(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The order of the targets by class, their classes and places inside them in that order, and where classes begin."""
        kind = (targets // self.size).astype(np.int16)  # short keys are sorted by counting
        order = np.argsort(kind, kind="stable")
        kind = kind[order]
        return order, kind, targets[order] - kind * self.size, np.searchsorted(kind, np.arange(self.classes + 1))

    def log_probs(self, h: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log of each target's probability: its class, then the token inside the class."""
        order, kind, inside, edges = self.by_class(targets)
        h = h.take(order, 1)
        logs = _softmax(self.p["cw"].T @ h + self.p["cb"][:, None], kind)[0]
        for c in range(self.classes):
            some = slice(edges[c], edges[c + 1])
            if edges[c] < edges[c + 1]:
                logs[some] += _softmax(self.p["ow"][c].T @ h[:, some] + self.p["ob"][c][:, None], inside[some])[0]
        out = np.empty_like(logs)
        out[order] = logs
        return out

    def backward(self, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray, end: int) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Gradients over one window (steps x lanes), the state after it (lanes x units), and the mean loss.
        The state starts anew after an end token."""
        p, n, (steps, lanes) = self.p, self.hidden, inputs.shape
        table = np.ascontiguousarray((p["embed"] @ p["wx"] + p["bx"]).T)
        kept, total, asked, goes_on = [], steps * lanes, inputs.ravel(), (inputs != end).astype(table.dtype)
        before, states = np.empty((n, steps, lanes), table.dtype), np.empty((n, steps, lanes), table.dtype)
        h = h.T
        for t in range(steps):
            h = h * goes_on[t]
            before[:, t] = h
            h, *more = self.step(table.take(inputs[t], 1), h)
            kept.append(more)
            states[:, t] = h
        order, kind, inside, edges = self.by_class(targets.ravel())
        flat = states.reshape(n, total).take(order, 1)
        grad = {k: np.zeros_like(p[k]) for k in ("ow", "ob")}

        def output(w: np.ndarray, b: np.ndarray, f: np.ndarray, at: np.ndarray) -> tuple[float, np.ndarray]:
            """The loss of one softmax and its derivatives by the inputs, over all tokens of the window."""
            d = w.T @ f
            d += b[:, None]
            logs, sums = _softmax(d, at)
            d *= 1 / (sums * total)
            d[at, np.arange(len(at))] -= 1 / total
            return -float(logs.sum()), d

        loss, d = output(p["cw"], p["cb"], flat, kind)
        grad["cw"], grad["cb"], dh = flat @ d.T, d.sum(1), p["cw"] @ d
        for c in range(self.classes):
            some = slice(edges[c], edges[c + 1])
            if edges[c] < edges[c + 1]:
                more, d = output(p["ow"][c], p["ob"][c], flat[:, some], inside[some])
                loss += more
                grad["ow"][c], grad["ob"][c] = flat[:, some] @ d.T, d.sum(1)
                dh[:, some] += p["ow"][c] @ d
        back = np.empty_like(order)
        back[order] = np.arange(total)
        dh, carried = dh.take(back, 1).reshape(n, steps, lanes), np.zeros((n, lanes), table.dtype)
        dz = np.empty((4 * n, steps, lanes), table.dtype)  # by candidate, update, reset, and the candidate's share of the state
        for t in reversed(range(steps)):
            update, reset, candidate, y = kept[t]
            g = dh[:, t] + carried
            d_candidate = (1 - update) * g
            d_candidate *= 1 - candidate * candidate
            d_update = before[:, t] - candidate
            g *= update
            d_update *= g
            d_update *= 1 - update
            dz[:n, t], dz[n:2 * n, t] = d_candidate, d_update
            d_candidate *= reset
            dz[3 * n:, t] = d_candidate
            d_candidate *= y
            d_candidate *= 1 - reset
            dz[2 * n:3 * n, t] = d_candidate
            carried = p["wh"] @ dz[n:, t]
            carried += g
            carried *= goes_on[t]
        dz = dz.reshape(4 * n, total)
        dx = dz[:3 * n]
        grad["wh"] = before.reshape(n, total) @ dz[n:].T
        grad["wx"] = np.roll(p["embed"].T.take(asked, 1) @ dx.T, -n, axis=1)
        grad["bx"] = np.roll(dx.sum(1), -n)
        grad["embed"] = np.zeros_like(p["embed"])
        order = np.argsort(asked.astype(np.int16), kind="stable")
        first = np.flatnonzero(np.diff(asked[order], prepend=-1))
        grad["embed"][asked[order[first]]] = np.add.reduceat((dx.T @ np.roll(p["wx"], n, axis=1).T)[order], first, axis=0)
        return grad, h.T, loss / total

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)]).astype(np.float64)

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k in sorted(self.p):
            self.p[k] = flat[at:at + self.p[k].size].reshape(self.p[k].shape).astype(np.float32)
            at += self.p[k].size

    def fit(self, stream: np.ndarray, end: int, lanes: int = 64, window: int = WINDOW, epochs: int = 1, rate: float = 0.01, moments: dict | None = None) -> list[float]:
        """Truncated backpropagation with Adam over one stream of texts, each ended by the end token;
        the stream is cut into ``lanes`` that advance side by side. Gives the mean loss by epoch.
        ``moments`` carries Adam's averages from one call to the next."""
        lanes = max(1, min(lanes, len(stream) // (2 * window)))
        length = len(stream) // lanes
        if length < 1:
            return []
        targets = stream[:lanes * length].reshape(lanes, length).T
        inputs = np.vstack([np.full((1, lanes), end), targets[:-1]])
        kept = {} if moments is None else moments
        m = kept.setdefault("m", {k: np.zeros_like(v) for k, v in self.p.items()})
        v = kept.setdefault("v", {k: np.zeros_like(x) for k, x in self.p.items()})
        losses, done = [], kept.get("done", 0)
        for _ in range(epochs):
            h, seen = np.zeros((lanes, self.hidden), np.float32), []
            for t in range(0, length, window):
                grad, h, loss = self.backward(inputs[t:t + window], targets[t:t + window], h, end)
                seen.append(loss)
                done += 1
                scale = min(1.0, 1.0 / (1e-8 + np.sqrt(sum(float((g ** 2).sum()) for g in grad.values()))))
                for k, g in grad.items():
                    m[k] += 0.1 * (g * scale - m[k])
                    v[k] += 0.001 * ((g * scale) ** 2 - v[k])
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9 ** done)) / (np.sqrt(v[k] / (1 - 0.999 ** done)) + 1e-6)).astype(np.float32)
            losses.append(float(np.mean(seen)))
        kept["done"] = done
        return losses

    def score(self, texts: list[np.ndarray], end: int, lanes: int = LANES, window: int = WINDOW) -> np.ndarray:
        """Natural log-likelihood of each text (numbers of its tokens, the end token last)."""
        out = np.zeros(len(texts))
        table = np.ascontiguousarray((self.p["embed"] @ self.p["wx"] + self.p["bx"]).T)
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        for at in range(0, len(order), lanes):
            group = order[at:at + lanes]
            lengths = np.array([len(texts[i]) for i in group])
            joined, starts = np.concatenate([texts[i] for i in group]).astype(np.int64), np.cumsum(lengths) - lengths
            h, last = np.zeros((self.hidden, len(group)), np.float32), np.full(len(group), end)
            for t in range(0, lengths[0], window):
                live = int((lengths > t).sum())
                h, last = h[:, :live], last[:live]
                steps = np.arange(t, min(t + window, int(lengths[0])))[:, None]
                inside = steps < lengths[:live]
                wanted = joined[starts[:live] + np.minimum(steps, lengths[:live] - 1)]
                states = np.empty((self.hidden, len(steps), live), np.float32)
                for s in range(len(steps)):
                    h = self.step(table.take(last, 1), h)[0]
                    states[:, s] = h
                    last = wanted[s]
                where = np.flatnonzero(inside)
                logs = self.log_probs(states.reshape(self.hidden, -1).take(where, 1), wanted.ravel()[where])
                out[group[:live]] += np.bincount(where % live, logs, minlength=live)
        return out


# ---- counts over the corpus --------------------------------------------------------------------

def _rows(docs: DataFrame, id_col: str, text_col: str, folds: int, held: int) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), (bucket(id_col, folds) == held).alias("out"), text_bytes(text_col).alias("t"))


def token_counts(rows: DataFrame) -> DataFrame:
    """(token binary, c long) over the rows that are not held out."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for some in pieces(pc.binary_length(b.column(0)).to_numpy()):
                yield pc.value_counts(tokens(b.column(0)[some])[0]).flatten()

    return map_partition(rows.filter("NOT out").select("t"), "token binary, c long", run).groupBy("token").agg(F.sum("c").alias("c"))


class Model:
    """What the tasks need: the network, its vocabulary, and the common counts."""

    def __init__(self, network: Network, vocabulary: dict[bytes, int], common: dict[bytes, int], known: np.ndarray, others: float) -> None:
        self.network, self.common = network, pa.array(list(common), pa.binary())
        self.logs, self.floor = np.append(np.log10(known + 1), 0), float(np.log10(others + 1))  # by place among the common tokens; the last is none of them
        self.share = self.logs - self.floor
        self.share[[common[w] for w in vocabulary if w in common] + [-1]] = 0
        self.end, self.other = vocabulary.get(END, 0), len(vocabulary)
        self.number = np.array([*(vocabulary.get(w, self.other) for w in common), self.other], np.int16)

    def places(self, words: pa.Array) -> np.ndarray:
        """Places among the common tokens, -1 for others."""
        return pc.fill_null(pc.index_in(words, value_set=self.common), -1).to_numpy()

    def numbers(self, places: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The network's numbers of the tokens; a text's end token, its ``last``, is always one of them."""
        out = self.number[places]
        out[last] = self.end
        return out


def common_tokens(counts: DataFrame) -> list[tuple[bytes, int]]:
    """The most frequent tokens, ``COMMON`` at most, by count and token. Counts fall into ``STEPS`` bins a doubling; of the
    bin that does not fit whole, tokens by their hash."""
    level = F.floor(F.log2("c") * STEPS).cast("int")
    bins = sorted(((r["b"], r["n"]) for r in counts.groupBy(level.alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True)  # 64 * STEPS at most
    left, split = COMMON, None
    for b, n in bins:
        if n > left:
            split = b
            break
        left -= n
    some = counts if split is None else counts.filter(level > split)
    if split is not None:
        part = F.pmod(F.xxhash64("token"), F.lit(1 << 12))
        sizes = sorted((r["p"], r["n"]) for r in counts.filter(level == split).groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
        upto = 0
        for p, n in sizes:
            if n > left:
                break
            left, upto = left - n, p + 1
        some = some.unionByName(counts.filter((level == split) & (part < upto)))
    return sorted(((bytes(r["token"]), r["c"]) for r in some.select("token", "c").collect()), key=lambda x: (-x[1], x[0]))  # COMMON at most


def prepare(counts: DataFrame) -> tuple[Model, int, int]:
    """(model with an unfitted network, N, V) from the corpus statistics."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = common_tokens(counts)
    common = {w: i for i, (w, _) in enumerate(top)}
    frequent = list(common)[:VOCABULARY - 1]
    if END not in frequent:
        frequent[-1:] = [END]
    vocabulary = {w: i for i, w in enumerate(frequent)}
    known = np.array([c for _, c in top], np.float64)
    own = np.array([known[common[w]] if w in common else 0.0 for w in frequent])
    counted = np.append(own, max(total - own.sum(), 1.0))
    others = max(float(total - own.sum()), 0.0) + max(float(distinct - len(vocabulary)), 0.0)
    return Model(Network(counted), vocabulary, common, known, others), int(total), int(distinct)


def encode(rows: DataFrame, model: Model) -> DataFrame:
    """Every text as two-byte numbers with its counts and sums; ``rest`` lists the tokens outside the common ones."""

    def run(batches: Iterator[pa.RecordBatch]):
        uid = TaskContext.get().partitionId() << 33
        for whole in batches:
            for some in pieces(pc.binary_length(whole.column(3)).to_numpy()):
                batch = whole[some]
                words, lengths = tokens(batch.column(3))
                ends = np.cumsum(lengths)
                starts, at = ends - lengths, model.places(words)
                rest, codes = at < 0, model.numbers(at, ends - 1)
                lists = pa.ListArray.from_arrays(_offsets(np.add.reduceat(rest, starts, dtype=np.int64)), words.filter(pa.array(rest)))
                yield (np.arange(uid, uid + len(batch)), *batch.columns[:3], lengths, np.add.reduceat(~rest, starts, dtype=np.int64), np.add.reduceat(model.logs[at], starts),
                       np.add.reduceat(model.share[at], starts), pa.Array.from_buffers(pa.binary(), len(batch), [None, _offsets(2 * lengths).buffers()[1], pa.py_buffer(codes)]), lists)
                uid += len(batch)

    return _scored(rows.select("id", "out", F.xxhash64("id", "t").alias("h"), "t"),
                   "uid long, id long, out boolean, h long, n long, known long, base double, share double, codes binary", run)


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(sizes)), pa.int32())


def learn(encoded: DataFrame, model: Model, total: int) -> None:
    """Fit the network: on a bounded sample here, then on every training document in rounds."""
    ours = encoded.filter("NOT out")
    sample = ours.filter("id IS NOT NULL").select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)
    drawn = ours.filter(F.col("n") <= SAMPLE_TOKENS).join(F.broadcast(sample), "id").select("id", "codes")  # SAMPLE_DOCS numbers at most
    stream, left = [], SAMPLE_TOKENS
    for r in drawn.orderBy(F.xxhash64("id"), "id", "codes").toLocalIterator():
        x = np.frombuffer(r["codes"], np.int16)
        if len(x) <= left:
            stream.append(x)
            left -= len(x)
    if stream:
        network_fit(model, np.concatenate(stream), 0.01, {})
    for k in range(ROUNDS):
        train_round(ours, model, k, ROUND_RATE / (k + 1), max(1, -(-total // (ROUNDS * BLOCK))))


def network_fit(model: Model, stream: np.ndarray, rate: float, moments: dict, net: Network | None = None) -> None:
    """One pass over a stream, in as many lanes as leave ``UPDATES`` steps of the weights, ``LANES`` at most."""
    stream = stream.astype(np.int64)
    lanes = max(1, min(LANES, len(stream) // (WINDOW * UPDATES)))
    stream = np.append(stream, stream[:-len(stream) % lanes])  # whole lanes, so that no token is left out
    (net or model.network).fit(stream, model.end, lanes=lanes, rate=rate, moments=moments)


def train_round(ours: DataFrame, model: Model, k: int, rate: float, shards: int) -> None:
    """Every shard trains on its documents of round ``k``; the weights move by the average change."""
    start = model.network.flat()

    def run(batches: Iterator[pa.RecordBatch]):
        shard, net, moments, parts, waiting, total = None, model.network, {}, [], 0, 0

        def go_on() -> None:
            nonlocal parts, waiting, total
            if parts:
                network_fit(model, np.concatenate(parts), rate, moments, net)
                total, waiting, parts = total + waiting, 0, []

        def close():
            change = np.rint((net.flat() - start) * UNIT).astype(np.int64) * total
            return np.arange(-1, len(change)), np.append(total, change)

        for batch in batches:
            for own, x in zip(batch.column(0).to_pylist(), batch.column(2)):
                if own != shard:
                    go_on()
                    if total:
                        yield close()
                    shard, moments, total = own, {}, 0
                    net.load(start)
                parts.append(np.frombuffer(x.as_buffer(), np.int16))
                waiting += len(parts[-1])
                if waiting >= BLOCK:
                    go_on()
        go_on()
        if total:
            yield close()

    # integer division: a double would lose the hash's last bits, and even numbers of shards would leave some empty
    mine = ours.filter(F.pmod("h", F.lit(ROUNDS)) == k).select(F.expr(f"pmod((h - pmod(h, {ROUNDS})) div {ROUNDS}, {shards})").alias("shard"), "h", "codes")
    mine = mine.repartition("shard").sortWithinPartitions("shard", "h")
    moved = map_partition(mine, "at long, change long", run).groupBy("at").agg(F.sum("change").alias("change")).toPandas()  # a row a weight
    if len(moved):
        by = moved.sort_values("at")["change"].to_numpy()
        model.network.load(start + by[1:] / (by[0] * UNIT))


def likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``."""
    rows = _rows(docs, id_col, text_col, folds, held)
    counts = stored(token_counts(rows), "lm-counts")
    model, total, distinct = prepare(counts)
    encoded = stored(encode(rows, model), "lm-codes")
    learn(encoded, model, total)
    ln10 = float(np.log(10))

    def run(uids: pa.Array, shares: pa.Array, codes: pa.Array, *rest: pa.Array):
        texts = [np.frombuffer(x.as_buffer(), np.int16) for x in codes]
        return uids, model.network.score(texts, model.end) / ln10 + shares.to_numpy(), *rest

    own = ["id", "out", "n", "known", "base", "left"]
    kept = encoded.withColumn("left", F.size("rest")).select("uid", "share", "codes", *own)

    scored = map_batches(kept, "uid long, score double, id long, out boolean, n long, known long, base double, left int", run)
    others = encoded.select("uid", F.explode("rest").alias("token")).join(counts, "token")
    others = others.groupBy("uid").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("c") + 1)).alias("add"))
    floor = float(np.log10(total + distinct + 1))
    return scored.join(others, "uid", "left").select(
        F.col("id").alias(id_col), F.col("out").alias("held_out"), F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("add", F.lit(0.0)) - F.col("n") * floor).alias("base_score"),
        (F.col("score") + F.coalesce("add", F.lit(0.0)) - F.col("left") * model.floor).alias("score"))


def _scored(rows: DataFrame, schema: str, function) -> DataFrame:
    """``rows`` through ``function``, whose last column lists the tokens outside the common ones."""
    names = [x.split()[0] for x in schema.split(", ")] + ["rest"]

    def run(batches: Iterator[pa.RecordBatch]):
        for made in function(batches):
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in made], names=names)

    return rows.mapInArrow(run, schema + ", rest array<binary>")
