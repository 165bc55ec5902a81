"""Chat formatting with typed content parts.

A message is a list of parts: text, image, audio or document. A visitor flattens it into one string:
text parts as they are with control strings escaped, the others as ordered placeholders
``<|image:0|>`` numbered by message, whose attachment reference and expanded token count are recorded.
Token counts expand by rule: an image takes one token for each started tile of ``TILE`` by ``TILE``
pixels, audio ``AUDIO_RATE`` for each started second, a document ``PAGE_TOKENS`` a page.

The template writes a turn as ``<|start|>role<|sep|>content<|end|>`` and a newline. Escaping makes every
string reversible: in roles and texts ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so no marker can
come from a text. Assistant content is under the loss mask, without markers.

Turns are formatted where they are read. To read a conversation back, its pieces are sorted by
(conv_id, turn) in Spark's sort, which spills, and a task streams over them: it parses each piece,
and updates running digests, so a conversation that holds a third of all rows needs no more memory
than one turn. Only the digest itself is sequential.

Edge cases: null text or parts are empty, a null role is the empty role, a null turn sorts first, rows
of a null conv_id form one conversation. Rows that share conv_id and turn are ordered by role, then
text. Repeated rows are repeated turns. An empty table gives no rows (only those that ``extra`` adds).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import map_batches, map_partition

# The template's markers and the sizes that token counts expand by.
START, SEP, END = "<|start|>", "<|sep|>", "<|end|>\n"
TILE, AUDIO_RATE, PAGE_TOKENS = 512, 25, 256

PARTS = "array<struct<type:string,text:string,ref:string,width:long,height:long,seconds:double,pages:long>>"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    """Each backslash gives way to the character after it."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


@dataclass
class Flattened:
    content: list[str] = field(default_factory=list)
    attachments: list[tuple[int, str, str, int]] = field(default_factory=list)  # (order, type, reference, tokens)
    tokens: int = 0


class Visitor:
    """One method for each type of part; a part of any other type raises ValueError."""

    def __init__(self) -> None:
        self.out = Flattened()

    def visit(self, part: dict) -> None:
        method = getattr(self, f"visit_{part.get('type') or 'text'}", None)
        if method is None:
            raise ValueError(f"unknown type of content part: {part['type']!r}")
        method(part)

    def visit_text(self, part: dict) -> None:
        self.out.content.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        tiles = [-(-max(1, part.get(side) or 1) // TILE) for side in ("width", "height")]
        self._attach(part, tiles[0] * tiles[1])

    def visit_audio(self, part: dict) -> None:
        self._attach(part, AUDIO_RATE * int(np.ceil(max(0.0, part.get("seconds") or 0.0))))

    def visit_document(self, part: dict) -> None:
        self._attach(part, PAGE_TOKENS * max(1, part.get("pages") or 1))

    def _attach(self, part: dict, tokens: int) -> None:
        order = len(self.out.attachments)
        self.out.attachments.append((order, part["type"], part.get("ref") or "", tokens))
        self.out.content.append(f"<|{part['type']}:{order}|>")
        self.out.tokens += tokens


def flatten(parts: list[dict | None] | None) -> Flattened:
    visitor = Visitor()
    for part in parts or []:
        if part is not None:
            visitor.visit(part)
    return visitor.out


def format_turn(role: str, content: str) -> str:
    return f"{START}{escape(role)}{SEP}{content}{END}"


PLACEHOLDER = re.compile(r"<\|(image|audio|document):\d+\|>")


def parse_turn(piece: str) -> tuple[str, str, str]:
    """(role, text, loss text) read back from a formatted turn; placeholders are no text."""
    if not piece.startswith(START) or not piece.endswith(END):
        raise ValueError("not a formatted turn")
    role, sep, content = piece[len(START):-len(END)].partition(SEP)
    if not sep:
        raise ValueError("not a formatted turn")
    text = unescape(PLACEHOLDER.sub("", content))
    role = unescape(role)
    return role, text, text if role == "assistant" else ""


def format_turns(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", parts_col: str | None = None) -> DataFrame:
    """(conv_id, turn, role, body, piece, loss_start, loss_end, attachments, tokens), one row per message.

    ``loss_start`` and ``loss_end`` bound the loss mask in code points of the piece (equal: none).
    Without ``parts_col`` a message is a single text part."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    parts = F.col(parts_col).cast(PARTS) if parts_col else F.lit(None).cast(PARTS)
    rows = messages.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                           F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), text.alias("body"), parts.alias("parts"))
    single = parts_col is None

    def run(conv: pa.Array, turn: pa.Array, role: pa.Array, body: pa.Array, parts: pa.Array):
        made = []
        for r, t, p in zip(role.to_pylist(), body.to_pylist(), [None] * len(body) if single else parts.to_pylist()):
            flat = flatten([{"type": "text", "text": t}] if single else p)
            content = "".join(flat.content)
            start = len(START) + len(escape(r)) + len(SEP)
            made.append((format_turn(r, content), start, start + len(content) * (r == "assistant"),
                         ",".join(f"{order}:{kind}:{tokens}:{ref}" for order, kind, ref, tokens in flat.attachments), flat.tokens))
        return conv, turn, role, body, *zip(*made)

    return map_batches(rows, "conv_id long, turn long, role string, body string, piece string, loss_start long, loss_end long, attachments string, tokens long", run)


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of each conversation,
    all read from the formatted pieces in order."""

    def run(batches: Iterator[pa.RecordBatch]):
        now, begun = None, False
        n = loss_chars = chars = 0
        turns = loss = hashlib.sha256()

        def row():
            return (now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)

        for batch in batches:
            done = []
            for conv, piece, start, end in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not begun or conv != now:
                    if begun:
                        done.append(row())
                    now, begun, n, loss_chars, chars = conv, True, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                role, text, _ = parse_turn(piece)
                masked = unescape(PLACEHOLDER.sub("", piece[start:end]))
                turns.update(f"{role}\n{text}\n".encode("utf-8", "replace"))
                loss.update(masked.encode("utf-8", "replace"))
                n, loss_chars, chars = n + 1, loss_chars + len(masked), chars + len(piece)
            if done:
                yield list(zip(*done))
        if begun:
            yield [[x] for x in row()]

    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "body")]
    ordered = formatted.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "piece", "loss_start", "loss_end")
    return map_partition(ordered, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long", run)


def format_conversations(messages: DataFrame, extra: list[tuple[int, int, str, str]] = ()) -> DataFrame:
    """Format all conversations of ``messages`` and the ``extra`` (conv_id, turn, role, text) rows, and
    read them back."""
    rows = messages.select("conv_id", "turn", "role", "text")
    if extra:
        rows = rows.unionByName(messages.sparkSession.createDataFrame(list(extra), "conv_id long, turn long, role string, text string"))
    return read_back(format_turns(rows))
