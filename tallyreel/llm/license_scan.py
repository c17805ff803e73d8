"""License scans by template-markup matching.

A template is license wording with markup: ``[...]`` is optional, ``{least,most}`` stands for that many
words of any kind (a name, a year), everything else is mandatory and must stand word for word. All
templates compile into one token automaton over the words of their wording; any other word is one
further symbol. A text is accepted by a template where the automaton reaches its end, started at any
word. Live starts advance together, one word a step, as arrays of (place, state); a start ends when
no wording continues, so the work is linear in the text, and a text longer than a slice hands its
live starts on to the next slice.

Words: A-Z are lowered, then runs of digits, a-z and all signs beyond ASCII count. Rows: one per
row of the table, repeated and NULL ids too. NULL and empty texts have no words and no spans.
Overlapping spans, and one start accepted by several templates, all count; of several ends of one
template from one start the last is kept. An empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyreel.llm.common import CHUNK_BYTES, flat_bytes, text_chunks

# Label and wording. Base phrases are templates without markup.
BASE = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)

# Label and wording of public licenses and of the notices that name them.
TEMPLATES = (
    ("apache-2.0", "apache license [version] 2.0"),
    ("gpl-2.0", "gnu general public license [as published by the free software foundation] [either] version 2"),
    ("gpl-3.0", "gnu general public license [as published by the free software foundation] [either] version 3"),
    ("lgpl-2.1", "gnu lesser general public license [as published by the free software foundation] [either] version 2.1"),
    ("lgpl-3.0", "gnu lesser general public license [as published by the free software foundation] [either] version 3"),
    ("agpl-3.0", "gnu affero general public license [as published by the free software foundation] [either] version 3"),
    ("mpl-2.0", "mozilla public license [v.] [version] 2.0"),
    ("cc0-1.0", "[creative commons] cc0 1.0 [universal]"),
    ("cc-by-4.0", "cc by 4.0"),
    ("cc-by-4.0", "creative commons attribution 4.0 [international] [public] license"),
    ("cc-by-sa-4.0", "cc by sa 4.0"),
    ("cc-by-sa-4.0", "creative commons attribution share alike 4.0 [international] [public] license"),
    ("cc-by-sa-4.0", "creative commons attribution sharealike 4.0 [international] [public] license"),
    ("cc-by-nc-4.0", "cc by nc 4.0"),
    ("cc-by-nc-4.0", "creative commons attribution noncommercial 4.0 [international] [public] license"),
    ("cc-by-nc-4.0", "creative commons attribution non commercial 4.0 [international] [public] license"),
    ("notice", "[this work is] licensed under [the terms of] [the] {1,8} license"),
    ("notice", "[this work is] released under [the terms of] [the] {1,8} license"),
    (
        "mit",
        """[the] [mit license] [copyright {0,24}] permission is hereby granted, free of charge, to any person obtaining a copy of
        this {1,4} and associated documentation files (the "{1,4}"), to deal in the {1,4} without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the {1,4}, and
        to permit persons to whom the {1,4} is furnished to do so, subject to the following conditions: the above copyright
        notice and this permission notice [(including the next paragraph)] shall be included in all copies or substantial
        portions of the {1,4}. the {1,4} is provided "as is", without warranty of any kind, express or implied, including but
        not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. in no event
        shall {1,12} be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise,
        arising from, out of or in connection with the {1,4} or the use or other dealings in the {1,4}.""",
    ),
    (
        "isc",
        """[isc license] [copyright {0,24}] permission to use, copy, modify, and/or distribute this software for any purpose with
        or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies. the software is provided "as is" and {1,8} disclaims all warranties with regard to this software including all
        implied warranties of merchantability and fitness. in no event shall {1,8} be liable for any special, direct, indirect,
        or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of
        contract, negligence or other tortious action, arising out of or in connection with the use or performance of this
        software.""",
    ),
    (
        "bsd-2-clause",
        """redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: [1.] redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. [2.] redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. this software is provided by {1,12} "as is" and any express or implied warranties""",
    ),
    (
        "bsd-3-clause",
        """redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: [1.] redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. [2.] redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution. [3.] neither the name of {1,12} nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission. this software is provided by {1,12}
        "as is" and any express or implied warranties""",
    ),
    (
        "apache-2.0",
        """licensed under the apache license, version 2.0 (the "license"); you may not use this file except in compliance with the
        license. you may obtain a copy of the license at {0,12} unless required by applicable law or agreed to in writing,
        software distributed under the license is distributed on an "as is" basis, without warranties or conditions of any kind,
        either express or implied. see the license for the specific language governing permissions and limitations under the
        license.""",
    ),
)

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_MARKUP = re.compile(r"(?P<open>\[)|(?P<close>\])|\{(?P<least>\d+),(?P<most>\d+)\}|(?P<word>[^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")
SPANS = "array<struct<label: string, base: boolean, mandatory: int, first: long, last: long>>"


@dataclass(frozen=True)
class Gap:
    """A replaceable region: from ``least`` to ``most`` words of any kind."""

    least: int
    most: int


@dataclass(frozen=True)
class Optional:
    parts: tuple


def parse(wording: str) -> tuple:
    """Words, gaps and optional parts of a template."""
    stack: list[list] = [[]]
    for found in _MARKUP.finditer(wording.lower()):
        if found["open"]:
            stack.append([])
        elif found["close"]:
            inner = tuple(stack.pop())
            stack[-1].append(Optional(inner))
        elif found["word"]:
            stack[-1].append(found["word"])
        else:
            stack[-1].append(Gap(int(found["least"]), int(found["most"])))
    (parts,) = stack
    return tuple(parts)


@dataclass
class Automaton:
    """States are places in templates; 0 is the start. ``symbol`` is the word of a place, None for any word."""

    symbol: list[str | None] = field(default_factory=lambda: [None])
    follow: list[set[int]] = field(default_factory=lambda: [set()])
    accepts: dict[int, int] = field(default_factory=dict)

    def _place(self, symbol: str | None, before: set[int]) -> set[int]:
        self.symbol.append(symbol)
        self.follow.append(set())
        for state in before:
            self.follow[state].add(len(self.symbol) - 1)
        return {len(self.symbol) - 1}

    def add(self, parts: tuple, before: set[int]) -> set[int]:
        """The states from which what comes after ``parts`` goes on."""
        for part in parts:
            if isinstance(part, Optional):
                before = before | self.add(part.parts, before)
            elif isinstance(part, Gap):
                ends = set(before) if part.least == 0 else set()
                for count in range(1, part.most + 1):
                    before = self._place(None, before)
                    if count >= part.least:
                        ends |= before
                before = ends
            else:
                before = self._place(part, before)
        return before


class Scanner:
    """The compiled templates: tables from (state, word) to the next states."""

    def __init__(self, templates: tuple[tuple[str, bool, str], ...]):
        parsed = [parse(wording) for _, _, wording in templates]
        self.labels = [label for label, _, _ in templates]
        self.base = [base for _, base, _ in templates]
        self.mandatory = [sum(isinstance(p, str) for p in parts) for parts in parsed]
        automaton = Automaton()
        for number, parts in enumerate(parsed):
            for state in automaton.add(parts, {0}) - {0}:
                automaton.accepts[state] = number
        words = sorted({w for w in automaton.symbol if w is not None})
        self.width = len(words) + 1
        number_of = {w: i + 1 for i, w in enumerate(words)}
        nexts: list[list[int]] = [[] for _ in range(len(automaton.symbol) * self.width)]
        for state, follow in enumerate(automaton.follow):
            for to in sorted(follow):
                symbol = automaton.symbol[to]
                for word in range(self.width) if symbol is None else [number_of[symbol]]:
                    nexts[state * self.width + word].append(to)
        self.begin = np.concatenate([[0], np.cumsum([len(n) for n in nexts])])
        self.next = np.array([to for n in nexts for to in n], np.int64)
        self.accept = np.full(len(automaton.symbol), -1)
        self.accept[list(automaton.accepts)] = list(automaton.accepts.values())
        self.states = len(automaton.symbol)
        self.by_length = {}
        for length in sorted({len(w.encode()) for w in words}):
            these = sorted(w.encode() for w in words if len(w.encode()) == length)
            numbers = np.array([number_of[w.decode()] for w in these])
            self.by_length[length] = np.array(these, f"S{length}"), numbers

    def _numbers(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each word, 0 for words of no template; whole words are compared."""
        out = np.zeros(len(starts), np.int64)
        for length, (known, numbers) in self.by_length.items():
            at = np.flatnonzero(sizes == length)
            raw = np.ascontiguousarray(data[starts[at][:, None] + np.arange(length)]).view(f"S{length}").ravel()
            place = np.minimum(np.searchsorted(known, raw), len(known) - 1)
            out[at] = np.where(known[place] == raw, numbers[place], 0)
        return out

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of each text, and rows (text, template, first word, last word) of what is accepted."""
        texts = len(offsets) - 1
        data = _LOWER[data]
        counts = np.zeros(texts, np.int64)
        found, live, done = [], np.zeros((3, 0), np.int64), 0
        for low, high in _slices(data):
            # Ends of texts cut words as well, which matters only where one text directly follows another.
            inside = _WORD[data[low:high]]
            change = np.flatnonzero(np.diff(inside, prepend=False, append=False))
            heads = offsets[1:-1][(offsets[1:-1] > low) & (offsets[1:-1] < high)] - low
            heads = np.unique(heads[inside[heads] & inside[heads - 1]])
            starts = np.sort(np.concatenate([change[::2], heads]))
            sizes = np.sort(np.concatenate([change[1::2], heads])) - starts
            rows = np.searchsorted(offsets, starts + low, side="right") - 1
            numbers = self._numbers(data[low:high], starts, sizes)
            counts += np.bincount(rows, minlength=texts)
            accepted, live = self._run(numbers, rows, live, done)
            found.append(accepted)
            done += len(starts)
        spans = np.concatenate([np.zeros((4, 0), np.int64), *found], axis=1)
        first = np.cumsum(counts) - counts
        spans[2:] -= first[spans[0]]
        # Of several ends from one start the last.
        spans = spans[:, np.lexsort(spans[[3, 1, 2, 0]])]
        longest = np.ones(spans.shape[1], bool)
        longest[:-1] = (spans[:3, 1:] != spans[:3, :-1]).any(axis=0)
        return counts, spans[:, longest]

    def _run(self, numbers: np.ndarray, rows: np.ndarray, live: np.ndarray, done: int) -> tuple[np.ndarray, np.ndarray]:
        """Accepted spans of one slice, and the starts (text, first word, state) that go on behind its end."""
        opens = self.begin[numbers + 1] > self.begin[numbers]
        at = np.concatenate([np.zeros(live.shape[1], np.int64), np.flatnonzero(opens)])
        fresh = np.flatnonzero(opens)
        text, first, state = np.concatenate([live, [rows[fresh], fresh + done, np.zeros(len(fresh), np.int64)]], axis=1)
        found, waiting = [], []
        while len(at):
            late = at == len(numbers)
            if late.any():
                waiting.append(np.stack([text, first, state])[:, late])
                at, text, first, state = (x[~late] for x in (at, text, first, state))
            same = rows[at] == text
            at, text, first, state = (x[same] for x in (at, text, first, state))
            cell = state * self.width + numbers[at]
            many = self.begin[cell + 1] - self.begin[cell]
            which = np.repeat(np.arange(len(at)), many)
            within = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
            state = self.next[self.begin[cell][which] + within]
            at, text, first = at[which] + 1, text[which], first[which]
            # Two ways to one place are one.
            _, keep = np.unique(first * self.states + state, return_index=True)
            at, text, first, state = (x[keep] for x in (at, text, first, state))
            template = self.accept[state]
            hit = template >= 0
            if hit.any():
                found.append(np.stack([text[hit], template[hit], first[hit], at[hit] - 1 + done]))
        none = np.zeros((4, 0), np.int64)
        return np.concatenate([none, *found], axis=1), np.concatenate([none[:3], *waiting], axis=1)


def _slices(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of a bounded size that end between words; a word longer than a slice stays whole."""
    low = 0
    while low < len(data):
        high = min(low + 2 * CHUNK_BYTES, len(data))
        while high < len(data) and _WORD[data[high]]:
            ahead = np.flatnonzero(~_WORD[data[high : high + CHUNK_BYTES]])
            high = high + int(ahead[0]) if len(ahead) else min(high + CHUNK_BYTES, len(data))
        yield low, high
        low = high


@lru_cache(maxsize=4)
def compiled(templates: tuple[tuple[str, bool, str], ...]) -> Scanner:
    return Scanner(templates)


def all_templates() -> tuple[tuple[str, bool, str], ...]:
    return tuple((label, True, words) for label, words in BASE) + tuple((label, False, words) for label, words in TEMPLATES)


def find_licenses(docs: DataFrame, templates: tuple[tuple[str, bool, str], ...] | None = None) -> DataFrame:
    """(doc_id, n_words, spans): where each text is accepted; words count from 0, ``last`` included."""
    templates = templates or all_templates()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = compiled(templates)
        label, base, mandatory = pa.array(scanner.labels), pa.array(scanner.base), pa.array(scanner.mandatory, pa.int32())
        for part in text_chunks(batches, "text"):
            counts, (text, template, first, last) = scanner.scan(*flat_bytes(part.column("text")))
            kinds = pa.array(template)
            span = pa.StructArray.from_arrays(
                [label.take(kinds), base.take(kinds), mandatory.take(kinds), pa.array(first), pa.array(last)],
                names=["label", "base", "mandatory", "first", "last"],
            )
            ends = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
            spans = pa.ListArray.from_arrays(pa.array(ends), span)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts), spans], names=["doc_id", "n_words", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, n_words long, spans {SPANS}")


def license_labels(found: DataFrame) -> DataFrame:
    """Labels, base places and score of each row: the largest share of its words that one accepted template demands."""
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    starts = F.transform(base, lambda s: s["first"])
    demanded = F.coalesce(F.array_max(F.transform("spans", lambda s: s["mandatory"])), F.lit(0))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("spans")).alias("labels"),
        F.when(F.col("n_words") > 0, demanded / F.col("n_words")).otherwise(0.0).alias("score"),
    )


def scan_sql() -> str:
    """The same rows in DuckDB SQL: templates as regular expressions over the words, one space between them."""

    def expression(parts: tuple) -> str:
        out = ""
        for part in parts:
            if isinstance(part, Optional):
                out += f"(?:{expression(part.parts)})?"
            elif isinstance(part, Gap):
                out += f"(?:[^ ]+ ){{{part.least},{part.most}}}"
            else:
                out += f"{part} "
        return out

    def listed(rows: list[str]) -> str:
        return f"array_to_string(list_sort(list_distinct(list_filter([{', '.join(rows)}], lambda x: x IS NOT NULL))), ',')"

    cases = {"base": [], "all": [], "demanded": []}
    for label, base, wording in all_templates():
        parts = parse(wording)
        match = f"CASE WHEN regexp_matches(flat, ' {expression(parts)}') THEN"
        cases["all"].append(f"{match} '{label}' END")
        cases["base"] += [cases["all"][-1]] if base else []
        cases["demanded"].append(f"{match} {sum(isinstance(p, str) for p in parts)} ELSE 0 END")
    places = []
    for _, wording in BASE:
        same = " AND ".join(f"w[i + {n}] = '{word}'" for n, word in enumerate(parse(wording), 1))
        places.append(f"list_filter(range(len(w)), lambda i: {same})")
    return rf"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
placed AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS flat, flatten([{", ".join(places)}]) AS places FROM words)
SELECT doc_id, len(w) AS n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
       {listed(cases["base"])} AS base_labels,
       {listed(cases["all"])} AS labels,
       CASE WHEN len(w) > 0 THEN greatest({", ".join(cases["demanded"])})::double / len(w) ELSE 0 END AS score
FROM placed"""
