"""Byte-level BPE: a lazily determinised finite-state transducer, and a streaming decoder.

Encoding. A segmentation of a byte string is the one BPE gives exactly if each adjacent pair of
tokens, joined and merged by rank, falls into that pair again. So each prefix of the input has one
last token, and the encoder is a finite-state transducer over bytes. A hypothesis is a token that
has begun but not ended: (node in the trie of tokens, last token before it, tokens not yet written).
A state is a set of hypotheses. On a byte each hypothesis advances in the trie; where a token ends
and fits after its last token, a new hypothesis begins at the root. Tokens that all hypotheses share
are written at once (the residual outputs of determinisation), so a token leaves after a lookahead
bounded by the longest token. States and transitions are made when first met. Once the table is
full, input that leaves it is carried on by the same steps on the hypotheses, without storing them.

Each match of the split pattern is encoded by itself; a match that is a token as a whole is that
token. Matches, and pieces between spaces, met before are looked up in tables that take no more
entries once full.

Texts are streamed: they are cut only before white space that follows something else, where the
pattern always starts a new match, so a chunk at a time is split, encoded, decoded and digested.

Decoding joins the tokens' bytes; ``Utf8Stream`` turns them into text incrementally: its state is
the bytes of a character that has begun, so tokens may end inside characters.

Edge cases: a null text is empty and has no tokens (digests of nothing); a null id is carried
through; repeated rows each keep their row; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import map_batches

CHUNK = 1 << 18
STATES = 20_000
WORDS = 200_000
PAIRS = 400_000
INF = float("inf")


class Transducer:
    """Encodes one match of the split pattern at a time."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.children: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for text, rank in ranks.items():
            node = 0
            for b in text:
                nxt = self.children[node].get(b)
                if nxt is None:
                    nxt = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                node = nxt
            self.token[node] = rank
        self.text = {rank: text for text, rank in ranks.items()}
        self.edges: dict[int, tuple[list, list]] = {}
        self.pairs: dict[int, bool] = {}
        start = ((0, -1, ()),)
        self.number = {start: 0}
        self.states: list[tuple] = [start]
        self.step: list[dict[int, tuple[int, tuple[int, ...]]]] = [{}]

    def merged(self, text: bytes, below: float = INF) -> list[bytes]:
        """BPE by definition, with merges of a rank under ``below`` only: the adjacent pair of the
        smallest rank goes first, the leftmost of equals."""
        parts, ranks = [text[i:i + 1] for i in range(len(text))], self.ranks
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1], INF)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def sides(self, token: int) -> tuple[list, list]:
        """What stands at a token's left and right edge while it is merged, last state first:
        (part, rank of the merge that takes it in; infinite for the token itself). Empty if merging
        never gives the token."""
        found = self.edges.get(token)
        if found is None:
            text = self.text[token]
            found = ([(text, INF)], [(text, INF)])
            for side, pick in ((found[0], 0), (found[1], -1)):
                part = text
                while len(part) > 1:
                    rank = self.ranks[part]
                    halves = self.merged(part, rank)
                    if len(halves) != 2:
                        break
                    part = halves[pick]
                    side.append((part, rank))
                if len(part) > 1:
                    found = ([], [])
                    break
            self.edges[token] = found
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' bytes gives the two tokens: no merge across the border
        comes before the merges that take in what stands on either side of it. Of equal ranks the
        left one goes first."""
        after = self.sides(right)[0]
        if left < 0 or not after:
            return bool(after)
        ranks = self.ranks
        for x, x_goes in self.sides(left)[1]:
            for y, y_goes in after:
                rank = ranks.get(x + y)
                if rank is not None and rank < x_goes and rank <= y_goes:
                    return False
        return True

    def moved(self, hypotheses: list[tuple], byte: int) -> list[tuple]:
        """The hypotheses after a byte; the last one is that a token ends here."""
        children, tokens, pairs = self.children, self.token, self.pairs
        out, ended = [], None
        for node, last, rest in hypotheses:
            node = children[node].get(byte)
            if node is None:
                continue
            if ended is None:
                token = tokens[node]
                if token >= 0:
                    fit = pairs.get(pair := (last << 32) + token)
                    if fit is None:
                        fit = self.fits(last, token)
                        if len(pairs) < PAIRS:
                            pairs[pair] = fit
                    if fit:
                        ended = (0, token, (*rest, token))
            if children[node]:
                out.append((node, last, rest))
        if ended is None:
            raise ValueError("the ranks lack a single byte or are no BPE")
        out.append(ended)
        return out

    def advance(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The state after a byte, and the tokens that are now certain."""
        moved, shared = self.moved(self.states[state], byte), 0
        first = moved[0][2]
        while shared < len(first) and all(len(m[2]) > shared and m[2][shared] == first[shared] for m in moved):
            shared += 1
        key = tuple((node, last, rest[shared:]) for node, last, rest in moved)
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.step.append({})
        return self.number[key], first[:shared]

    def encode(self, text: bytes) -> list[int]:
        whole = self.ranks.get(text)
        if whole is not None or not text:
            return [whole] if text else []
        out: list[int] = []
        state, step, full = 0, self.step, len(self.states) >= STATES
        for at, byte in enumerate(text):
            made = step[state].get(byte)
            if made is None:
                if full:
                    hypotheses = self.states[state]
                    for byte in text[at:]:
                        hypotheses = self.moved(hypotheses, byte)
                    out += hypotheses[-1][2]
                    return out
                made = step[state][byte] = self.advance(state, byte)
            state, tokens = made
            out += tokens
        out += self.states[state][-1][2]
        return out


class Utf8Stream:
    """An incremental UTF-8 decoder. The state is the bytes of a character that has begun; bytes that
    are no UTF-8 become U+FFFD."""

    def __init__(self) -> None:
        self.begun = b""

    def feed(self, data: bytes) -> str:
        data = self.begun + data
        keep = 0
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                keep = back if need > back else 0
                break
            if byte < 0x80:
                break
        self.begun = data[len(data) - keep:]
        return data[:len(data) - keep].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.begun = self.begun, b""
        return rest.decode("utf-8", "replace")


def open_ended(piece: str) -> bool:
    """Empty, or with white space at an end."""
    return not piece or piece[0].isspace() or piece[-1].isspace()


class Codec(dict):
    """Texts to ids and back. As a dict: for a piece between single spaces, the packed ids of the
    space and the piece; None if it is empty or has white space at an end, as matches may then
    reach over it."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        super().__init__()
        self.matches: dict[str, bytes] = {}
        self.transducer, self.pattern = Transducer(ranks), regex.compile(pattern)
        self.cut = regex.compile(r"(?<=\S)\s")
        size = max(ranks.values()) + 1
        self.bytes_of = [self.transducer.text.get(i, b"") for i in range(size)]
        self.digits_of = [str(i).encode() for i in range(size)]

    def __missing__(self, piece: str) -> bytes | None:
        made = None if open_ended(piece) else self.split(" " + piece)
        if len(self) < WORDS and len(piece) < 64:
            self[piece] = made
        return made

    def split(self, text: str) -> bytes:
        """Packed ids of a text: each match of the pattern through the transducer."""
        packed, known = [], self.matches
        for match in self.pattern.findall(text):
            made = known.get(match)
            if made is None:
                made = np.array(self.transducer.encode(match.encode("utf-8", "replace")), "<i4").tobytes()
                if len(known) < WORDS and len(match) < 64:
                    known[match] = made
            packed.append(made)
        return b"".join(packed)

    def chunks(self, text: str, size: int = CHUNK) -> Iterator[str]:
        at = 0
        while len(text) - at > size:
            cut = self.cut.search(text, at + size)
            end = cut.start() if cut else len(text)
            yield text[at:end]
            at = end
        if at < len(text):
            yield text[at:] if at else text

    def encode(self, text: str) -> Iterator[np.ndarray]:
        """Ids of a text, a chunk at a time. The pattern starts a new match at a space that follows
        something else, so pieces between single spaces can be looked up."""
        for chunk in self.chunks(text):
            first, *pieces = chunk.split(" ")
            packed = list(map(self.__getitem__, pieces))
            if pieces and (None in packed or open_ended(first)):
                packed = [self.split(chunk)]
            else:
                packed.insert(0, self.split(first))
            yield np.frombuffer(b"".join(packed), "<i4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """One per worker process, kept for its later tasks."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return Codec(ranks, pattern)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids)."""
    return encode_checked(docs, path, pattern, id_col, text_col).drop("same_text")


def encode_checked(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids, same_text): the ids, and whether the decoder gives the text back from them."""

    def run(ids: pa.Array, texts: pa.Array):
        tool, made, same = codec(path, pattern), [], []
        for t in texts:
            text, stream, at, good, parts = t.as_py(), Utf8Stream(), 0, True, []
            for part in tool.encode(text):
                parts.append(part)
                decoded = stream.feed(tool.decode(part))
                good = good and text.startswith(decoded, at)
                at += len(decoded)
            made.append(np.concatenate([np.zeros(0, "<i4"), *parts]))
            same.append(good and not stream.close() and at == len(text))
        offsets = np.concatenate([[0], np.cumsum([len(m) for m in made])]).astype(np.int32)
        return ids, np.diff(offsets), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(made), pa.int32())), same

    return map_batches(_texts(docs, id_col, text_col), f"{id_col} long, n_tokens long, ids array<int>, same_text boolean", run)


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) from (id_col, ids); null ids count as none."""

    def run(ids: pa.Array, tokens: pa.Array):
        tool, texts = codec(path, pattern), []
        for t in tokens:
            stream, numbers = Utf8Stream(), t.values.to_numpy()
            texts.append("".join([stream.feed(tool.decode(numbers[i:i + CHUNK])) for i in range(0, len(numbers), CHUNK)]) + stream.close())
        return ids, texts

    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")).alias("x"))
    return map_batches(rows, f"{id_col} long, text string", run)


def digest(tool: Codec, text: str) -> tuple[int, str, str, bool]:
    """(number of ids, digest of the ids, digest of the decoded bytes, whether decoding gave the text)."""
    n, same, ids_hash, bytes_hash, stream, at = 0, True, hashlib.sha256(), hashlib.sha256(), Utf8Stream(), 0
    for ids in tool.encode(text):
        numbers = ids.tolist()
        ids_hash.update((b"," if n else b"") + b",".join(map(tool.digits_of.__getitem__, numbers)))
        decoded = b"".join(map(tool.bytes_of.__getitem__, numbers))
        bytes_hash.update(decoded)
        part = stream.feed(decoded)
        same = same and text.startswith(part, at)
        at += len(part)
        n += len(numbers)
    same = same and not stream.close() and at == len(text)
    return n, ids_hash.hexdigest(), bytes_hash.hexdigest(), same


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256, same_text): encode, then decode the ids."""

    def run(ids: pa.Array, texts: pa.Array):
        tool = codec(path, pattern)
        return ids, *zip(*(digest(tool, t.as_py()) for t in texts))

    return map_batches(_texts(docs, id_col, text_col), f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string, same_text boolean", run)
