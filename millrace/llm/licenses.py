"""License texts and notices found by template markup compiled to token automata.

A template is a license text in which ``<<beginOptional>>``...``<<endOptional>>`` encloses
wording that may be missing (such regions may be nested), and ``<<var;name="holder";words="0-20">>``
stands for wording that may be replaced by any words within the stated numbers. Everything
else is mandatory: a text is accepted where its words (lower-cased letters and digits, whatever
stands between them) equal the template's one by one.

``Automaton`` has a state for each word of the template and for each replaceable one, and the
states that may follow each: optional regions and replaceable words are skipped, so one state
may have many followers. A document is read from each place whose first two words can begin a
template (found for all words of a batch at once); from there on the set of states that are
alive moves on word by word until it is empty. Of the matches of one template from one place
the longest counts, and the search goes on behind it, so that its matches don't overlap.

Base phrases are found on the side, as places where their words stand consecutively.

Defined results: a null or empty text has no words and no labels. Repeated rows give equal
rows; an empty table gives an empty result; other columns are ignored. A document is worked on
by itself in linear time: the states alive are bounded by the template. Words are compared by
64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import ALNUM, Words, mix, pieces, split_words, string_array

# The phrases of the base labels.
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}

# Public license texts and notices, marked up.
TEMPLATES = {
    "mit-notice": """<<var;name="use";words="0-1">> under the <<beginOptional>>terms of the<<endOptional>>
        <<beginOptional>>Expat or<<endOptional>> MIT License""",
    "mit-text": """<<beginOptional>><<beginOptional>>The<<endOptional>> MIT License <<beginOptional>>(MIT)<<endOptional>><<endOptional>>
        <<beginOptional>>Copyright <<var;name="holder";words="0-20">><<endOptional>>
        Permission is hereby granted, free of charge, to any person obtaining a copy of
        <<var;name="thing";words="1-8">> (the "Software"), to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
        to do so, subject to the following conditions: The above copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or
        substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;name="owner";words="1-12">> BE LIABLE FOR
        ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc-text": """<<beginOptional>>ISC License<<endOptional>> <<beginOptional>>Copyright <<var;name="holder";words="0-20">><<endOptional>>
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name="owner";words="1-12">> DISCLAIMS ALL WARRANTIES WITH REGARD
        TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.""",
    "bsd-text": """<<beginOptional>>Copyright <<var;name="holder";words="0-20">><<endOptional>>
        <<beginOptional>>All rights reserved.<<endOptional>> Redistribution and use in source and binary forms, with
        or without modification, are permitted provided that the following conditions are met:
        <<var;name="bullet";words="0-1">> Redistributions of source code must retain the above copyright notice,
        this list of conditions and the following disclaimer. <<var;name="bullet";words="0-1">> Redistributions in
        binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
        in the documentation and/or other materials provided with the distribution.
        <<beginOptional>><<var;name="bullet";words="0-1">> Neither the name of <<var;name="owner";words="1-12">> nor
        the names of its contributors may be used to endorse or promote products derived from this software without
        specific prior written permission.<<endOptional>>""",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0
        <<beginOptional>>(the "License"); you may not use this file except in compliance with the License.
        <<beginOptional>>You may obtain a copy of the License at <<var;name="address";words="4-10">><<endOptional>>
        <<endOptional>>""",
    "gpl-notice": """<<beginOptional>>is free software: you can redistribute it and/or modify it<<endOptional>>
        <<beginOptional>>licensed<<endOptional>> under the <<beginOptional>>terms of the<<endOptional>> GNU <<beginOptional>><<var;name="kind";words="1-1">><<endOptional>> General Public License
        <<beginOptional>>as published by the Free Software Foundation<<endOptional>>
        <<beginOptional>>, either<<endOptional>> version <<var;name="version";words="1-2">>""",
    "cc-by-nc-4.0-notice": """Licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>Creative
        Commons<<endOptional>> CC BY-NC 4.0""",
    "public-domain-notice": """This is free and unencumbered software released into the public domain.""",
}

SCAN_SCHEMA = (
    "doc_id long, n_words long, base array<struct<label:string,start:long>>, "
    "found array<struct<label:string,start:long,end:long>>"
)

_BASE = pa.struct([("label", pa.string()), ("start", pa.int64())])
_FOUND = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

_MARK = re.compile(r'<<(beginOptional|endOptional|var;name="[^"]*";words="(\d+)-(\d+)")>>')


@dataclass(frozen=True)
class Any:
    """Between ``least`` and ``most`` words, whichever they are."""

    least: int
    most: int


# A template is a list of words, of replaceable stretches, and of lists that may be left out.
Region = list


def words_of(text: str) -> list[str]:
    """The words of a text as ``text.ALNUM`` tells them apart."""
    found = split_words(pa.array([text]), ALNUM)
    data = found.data.tobytes().lower()  # of bytes: A-Z alone
    return [data[a:b].decode() for a, b in zip(found.starts, found.ends, strict=True)]


def parse(markup: str) -> Region:
    """The regions of a marked-up text."""
    stack: list[Region] = [[]]
    at = 0
    for mark in _MARK.finditer(markup):
        stack[-1].extend(words_of(markup[at : mark.start()]))
        at = mark.end()
        if mark[1] == "beginOptional":
            stack.append([])
        elif mark[1] == "endOptional":
            if len(stack) < 2:
                raise ValueError("endOptional without beginOptional")
            inner = stack.pop()
            stack[-1].append(inner)
        else:
            stack[-1].append(Any(int(mark[2]), int(mark[3])))
    rest = markup[at:]
    if "<<" in rest or ">>" in rest or len(stack) > 1:
        raise ValueError("unknown or unclosed markup")
    stack[-1].extend(words_of(rest))
    return stack[0]


@dataclass
class Automaton:
    """States with the word each consumes (None: any), those that may follow each, first ones and last ones."""

    label: str
    words: list[int | None] = field(default_factory=list)
    follow: list[list[int]] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    final: set[int] = field(default_factory=set)

    @classmethod
    def compile(cls, label: str, markup: str) -> Automaton:
        machine = cls(label)
        machine.first, last, empty = machine._region(parse(markup))
        machine.final = set(last)
        pairs, alone = machine.openings()
        if empty or (None, None) in pairs or any(machine.words[s] is None for s in alone):
            raise ValueError(f"template {label} has no mandatory word among the first two")
        return machine

    def _state(self, word: int | None) -> int:
        self.words.append(word)
        self.follow.append([])
        return len(self.words) - 1

    def _region(self, items: Region) -> tuple[list[int], list[int], bool]:
        """First and last states of a sequence, and whether it may be empty."""
        first: list[int] = []
        last: list[int] = []
        empty = True
        for item in items:
            if isinstance(item, list):
                f, m, e = *self._region(item)[:2], True
            elif isinstance(item, Any):
                f, m, e = self._replaceable(item)
            else:
                state = self._state(hash_of(item))
                f, m, e = [state], [state], False
            for state in last:
                self.follow[state].extend(f)
            first = first + f if empty else first
            last = last + m if e else m
            empty = empty and e
        return first, last, empty

    def _replaceable(self, item: Any) -> tuple[list[int], list[int], bool]:
        states = [self._state(None) for _ in range(item.most)]
        for a, b in zip(states, states[1:]):
            self.follow[a].append(b)
        return states[:1], states[max(item.least - 1, 0) :], item.least == 0

    def longest(self, words: list[int], start: int) -> int | None:
        """The end of the longest accepted stretch from ``start`` on."""
        alive, end, at = set(self.first), None, start
        while alive and at < len(words):
            word = words[at]
            alive = {s for s in alive if self.words[s] is None or self.words[s] == word}
            at += 1
            if not self.final.isdisjoint(alive):
                end = at
            alive = {f for s in alive for f in self.follow[s]}
        return end

    def openings(self) -> tuple[set[tuple[int | None, int | None]], set[int]]:
        """The first two words of what is accepted (None: any), and the states at which one word is enough."""
        pairs = {(self.words[s], self.words[f]) for s in self.first for f in self.follow[s]}
        return pairs, self.final.intersection(self.first)


def hash_of(word: str) -> int:
    return int(split_words(pa.array([word]), ALNUM).hashes[0])


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first) + second


def _starts(machine: Automaton, found: Words) -> np.ndarray:
    """Places in the batch from which the automaton's first two words fit."""
    h = found.hashes
    pairs, alone = machine.openings()
    last = np.zeros(len(h), bool)
    ends = found.bounds[1:][np.diff(found.bounds) > 0] - 1
    last[ends] = True
    second = np.append(h[1:], h[:1])
    fits = np.zeros(len(h), bool)
    both = np.array([(a, b) for a, b in pairs if a is not None and b is not None], np.uint64).reshape(-1, 2)
    if len(both):
        fits |= np.isin(_pair(h, second), _pair(both[:, 0], both[:, 1]))
    for a, b in pairs:
        if a is None:
            fits |= second == np.uint64(b)
        elif b is None:
            fits |= h == np.uint64(a)
    fits &= ~last
    if alone:
        fits |= np.isin(h, np.array([machine.words[s] for s in alone], np.uint64))
    return np.flatnonzero(fits)


def _scan(batches: Iterator[pa.RecordBatch], machines: list[Automaton], phrases: list[tuple[str, list[int]]]):
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for low, piece in pieces(string_array(batch.column(1))):
            found = split_words(piece, ALNUM)
            h, bounds = found.hashes, found.bounds
            base: list[list[dict]] = [[] for _ in range(len(piece))]
            matched: list[list[dict]] = [[] for _ in range(len(piece))]
            for label, words in phrases:
                n = len(words)
                here = np.ones(max(len(h) - n + 1, 0), bool)
                for k, word in enumerate(words):
                    here &= h[k : k + len(here)] == np.uint64(word)
                at = np.flatnonzero(here)
                doc = np.searchsorted(bounds, at, "right") - 1
                inside = at + n <= bounds[doc + 1]
                for i, start in zip(doc[inside].tolist(), (at - bounds[doc])[inside].tolist(), strict=True):
                    base[i].append({"label": label, "start": start})
            for machine in machines:
                at = _starts(machine, found)
                doc = np.searchsorted(bounds, at, "right") - 1
                own, words, behind = -1, [], 0
                for i, start in zip(doc.tolist(), (at - bounds[doc]).tolist(), strict=True):
                    if i != own:
                        own, words, behind = i, h[bounds[i] : bounds[i + 1]].tolist(), 0
                    if start < behind:
                        continue
                    end = machine.longest(words, start)
                    if end is not None:
                        matched[i].append({"label": machine.label, "start": start, "end": end})
                        behind = end
            for rows in base + matched:
                rows.sort(key=lambda r: (r["start"], r["label"]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[low : low + len(piece)], pa.int64()),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(base, pa.list_(_BASE)),
                    pa.array(matched, pa.list_(_FOUND)),
                ],
                names=["doc_id", "n_words", "base", "found"],
            )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
) -> DataFrame:
    """Per row: doc_id, n_words, places of the base phrases, and the spans (in words) the templates accept."""
    machines = [Automaton.compile(label, markup) for label, markup in templates.items()]
    wanted = [(label, [hash_of(word) for word in words_of(text)]) for label, text in phrases.items()]
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col))
    return rows.mapInArrow(partial(_scan, machines=machines, phrases=wanted), SCAN_SCHEMA)


def pattern(items: Region) -> str:
    """A regular expression for words that are each followed by one space, which accepts what the automaton does."""
    parts = []
    for item in items:
        if isinstance(item, list):
            parts.append(f"(?:{pattern(item)})?")
        elif isinstance(item, Any):
            parts.append(f"(?:[^ ]+ ){{{item.least},{item.most}}}")
        else:
            parts.append(f"{item} ")
    return "".join(parts)
