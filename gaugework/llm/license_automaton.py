"""Licence scans: a generalised suffix automaton over licence texts, as word sequences.

The automaton of all templates (texts of licences, and short phrases that name them) is built once
and is as small as the templates. Each document is streamed through it: after each word the
matching statistic is the length of the longest run of words, ending here, that stands in some
template. Where a run cannot go on it is a maximal match. Long matches of one template are chained
in order, with bounded gaps in the document, into covered template spans; every chain that covers
enough of its template is a span and gives its label, and the largest share covered gives the score. Phrases are found in the
same pass: a state knows which phrases are suffixes of what it stands for.

Words are runs of digits, letters a-z (A-Z lower-cased) and characters from U+0080 on. A word pair
that stands in no template ends every match of two words or more, so only stretches of known pairs
are streamed; matches of a single word are of no use to either result.

Edge cases: a null text is empty: no words, no labels, score 0. Labels are distinct and sorted. Null
ids are carried through, repeated rows each keep their row, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugework.llm.common import map_batches, text_bytes

# Phrases that name a licence, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Well-known passages of public licences, and their labels.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
               "the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
               "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
               "specific language governing permissions and limitations under the License."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met:"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
            "disclaimer in the documentation and/or other materials provided with the distribution."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
            "distributed with this file, You can obtain one at"),
]

_SEPARATE = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.lower().translate(_SEPARATE).split()


@dataclass
class State:
    """A state of the automaton: where its strings end in a template, first of all and at every position
    (at most the template's length, and in all states together those of the templates' repeats)."""

    length: int
    link: int
    moves: dict[int, int] = field(default_factory=dict)
    ends: dict[int, int] = field(default_factory=dict)
    places: dict[int, set[int]] = field(default_factory=dict)
    phrases: tuple[int, ...] = ()


class LicenseAutomaton:
    """``scan`` gives the places of phrases and the chained spans of templates of one text."""

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES,
                 least: int = 4, gap: int = 8, cover: float = 0.5) -> None:
        self.phrases = [(words(p.encode()), label) for p, label in phrases.items()]
        self.templates = [(label, words(t.encode())) for label, t in templates]
        self.least, self.gap, self.cover = least, gap, cover
        texts = [p for p, _ in self.phrases] + [t for _, t in self.templates]
        self.ids = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
        self.states = [State(0, -1)]
        numbers = [[self.ids[w] for w in t] for t in texts]
        for k, text in enumerate(numbers):
            last = 0
            for at, symbol in enumerate(text):
                last = self._extend(last, symbol)
                if k >= len(self.phrases):
                    self.states[last].ends.setdefault(k - len(self.phrases), at)
                    self.states[last].places.setdefault(k - len(self.phrases), set()).add(at)
        by_length = sorted(range(1, len(self.states)), key=lambda i: -self.states[i].length)
        for i in by_length:  # what ends here also ends, as a shorter string, at the suffix link
            for k, at in self.states[i].ends.items():
                self.states[self.states[i].link].ends.setdefault(k, at)
            for k, at in self.states[i].places.items():
                self.states[self.states[i].link].places.setdefault(k, set()).update(at)
        for k in range(len(self.phrases)):
            state = 0
            for symbol in numbers[k]:
                state = self.states[state].moves[symbol]
            self.states[state].phrases += (k,)
        for i in reversed(by_length):  # and a state ends in the phrases of its suffixes
            link = self.states[self.states[i].link]
            self.states[i].phrases = tuple(dict.fromkeys(self.states[i].phrases + link.phrases))
        n = len(self.ids) + 1
        self.pairs = np.zeros((n, n), bool)  # the last row and column: unknown words
        for text in numbers:
            self.pairs[text[:-1], text[1:]] = True

    def _extend(self, last: int, symbol: int) -> int:
        """Append a symbol after the state of the text so far; states of earlier texts are shared."""
        states = self.states
        there = states[last].moves.get(symbol)
        if there is not None:
            if states[there].length == states[last].length + 1:
                return there
            return self._split(last, there, symbol)
        new = len(states)
        states.append(State(states[last].length + 1, 0))
        while last >= 0 and symbol not in states[last].moves:
            states[last].moves[symbol] = new
            last = states[last].link
        if last >= 0:
            there = states[last].moves[symbol]
            states[new].link = there if states[there].length == states[last].length + 1 else self._split(last, there, symbol)
        return new

    def _split(self, above: int, there: int, symbol: int) -> int:
        states, copy = self.states, len(self.states)
        old = states[there]
        states.append(State(states[above].length + 1, old.link, dict(old.moves), dict(old.ends), {k: set(at) for k, at in old.places.items()}))
        old.link = copy
        while above >= 0 and states[above].moves.get(symbol) == there:
            states[above].moves[symbol] = copy
            above = states[above].link
        return copy

    def statistics(self, symbols: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length of the longest match ending here) after each symbol."""
        states, state, length = self.states, 0, 0
        for symbol in symbols:
            while state and symbol not in states[state].moves:
                state = states[state].link
                length = states[state].length
            nxt = states[state].moves.get(symbol)
            if nxt is None:
                state, length = 0, 0
            else:
                state, length = nxt, length + 1
            yield state, length

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[tuple[str, float, int, int]]]:
        """(number of words, [(first word, phrase)], [(label, share covered, first word, end word)])."""
        found = words(text)
        known, unknown = self.ids.get, len(self.ids)
        ids = np.array([known(w, unknown) for w in found], np.int32)
        if len(ids) < 2:
            return len(ids), [], []
        good = np.flatnonzero(self.pairs[ids[:-1], ids[1:]])
        if not len(good):
            return len(ids), [], []
        cuts = np.flatnonzero(np.diff(good) > 1) + 1
        places: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int]] = []
        for part in np.split(good, cuts):
            first, stop = int(part[0]), int(part[-1]) + 2
            before = (0, 0)
            for at, (state, length) in enumerate(self.statistics(ids[first:stop].tolist()), first):
                for k in self.states[state].phrases:
                    if length >= len(self.phrases[k][0]):
                        places.append((at - len(self.phrases[k][0]) + 1, k))
                if length <= before[1] and before[1] >= self.least:
                    matches.append((at - before[1], before[1], before[0]))
                before = (state, length)
            if before[1] >= self.least:
                matches.append((stop - before[1], before[1], before[0]))
        return len(ids), sorted(places), self.chains(matches)

    def chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, float, int, int]]:
        """Chain the matches (first word, length, state) of each template in the order of both texts.
        A match that stands at several places of the template goes to the first that continues the open
        chain; otherwise it closes that chain and opens one at its first place."""
        spans = []
        for k, (label, template) in enumerate(self.templates):
            chain: list[int] | None = None  # covered words, end in the template, first and end word

            def close() -> None:
                if chain and chain[0] >= self.cover * len(template):
                    spans.append((label, chain[0] / len(template), chain[2], chain[3]))

            for first, length, state in matches:
                places = self.states[state].places.get(k)
                if not places:
                    continue
                end = None
                if chain and first - chain[3] <= self.gap:
                    end = min((e for e in places if e > chain[1] and e - length + 1 >= chain[1] - self.least), default=None)
                if end is None:
                    close()
                    chain = [length, min(places), first, first + length]
                else:
                    new = length - max(0, chain[1] + length - end, chain[3] - first)
                    chain = [chain[0] + max(0, new), end, chain[2], first + length]
            close()
        return spans


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", automaton: LicenseAutomaton | None = None) -> DataFrame:
    """(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, spans), one row per row.

    ``spans`` lists the covered template spans as label:first word:end word."""
    tool = automaton or LicenseAutomaton()

    def run(ids: pa.Array, texts: pa.Array):
        rows = []
        for t in texts:
            n, places, spans = tool.scan(t.as_buffer().to_pybytes())
            base = {tool.phrases[k][1] for _, k in places}
            score = 1.0 if base else min(1.0, max((s[1] for s in spans), default=0.0))
            rows.append((n, len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted(base)),
                         ",".join(sorted(base | {s[0] for s in spans})), score, ",".join(f"{s[0]}:{s[2]}:{s[3]}" for s in spans)))
        return ids, *zip(*rows)

    schema = f"{id_col} long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"
    return map_batches(docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("t")), schema, run)
