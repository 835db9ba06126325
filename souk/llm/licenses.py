"""Licence scans: a generalised suffix automaton of licence words gives matching statistics.

One automaton holds every template (notices of licences, and the phrases that name one). The words
of a text are streamed through it: at each word it knows the longest run of words up to there that
occurs in any template, and by its suffix links the longest such run for every single template. Long
runs are chained per template, in text and template order with bounded gaps, and the part of the
template that the best chain covers decides on the label.

Before that, a vectorised pass cuts the words where two neighbours are not neighbours in any template:
no run of two words or more crosses such a place, so only the pieces in between are streamed.

Defined results: a null text counts as empty and has no words; equal rows are scanned alike; an empty
table gives an empty result; rows without an id stay. Words are compared as they are; their hashes
only choose what is looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from souk.llm.common import corpus, lowered, prefix_sums, slices, span_hashes

# Phrases that name a licence, with the labels they stand for.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# The notices by which works name their licence, as their licences word them.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
     "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
     'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
     "the specific language governing permissions and limitations under the License."),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
     "and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
     "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
     "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
     "details."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
     "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
     "any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
     "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
     "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
     "distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LONG = 3  # words that a run has at least to be chained
GAP = 12  # words that may stand between two runs of a chain, in the text and in the template
COVERED = 0.75  # part of a template that gives its label


def words_of(text: str) -> list[bytes]:
    return WORD.findall(bytes(lowered(np.frombuffer(text.encode(), np.uint8))))


@dataclass
class State:
    length: int
    link: int
    step: dict[int, int] = field(default_factory=dict)
    ends: list[tuple[int, int]] = field(default_factory=list)  # (template, place of its last word)


class Automaton:
    """The generalised suffix automaton of several sequences of word numbers."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.states = [State(0, -1)]
        for number, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word)
                self.states[last].ends.append((number, place))
        # the ends of a state are its own and those of all states that link to it
        for i in sorted(range(1, len(self.states)), key=lambda i: -self.states[i].length):
            s = self.states[i]
            if s.link > 0:
                parent = self.states[s.link]
                parent.ends = parent.ends + [e for e in s.ends if e not in parent.ends]

    def _extend(self, last: int, word: int) -> int:
        states = self.states
        known = states[last].step.get(word)
        if known is not None:  # another sequence has been here
            if states[known].length == states[last].length + 1:
                return known
            return self._split(last, word, known)
        new = len(states)
        states.append(State(states[last].length + 1, 0))
        at = last
        while at >= 0 and word not in states[at].step:
            states[at].step[word] = new
            at = states[at].link
        if at >= 0:
            known = states[at].step[word]
            states[new].link = known if states[known].length == states[at].length + 1 else self._split(at, word, known)
        return new

    def _split(self, at: int, word: int, known: int) -> int:
        """A state of its own for the shorter strings of ``known``."""
        states = self.states
        copy = len(states)
        states.append(State(states[at].length + 1, states[known].link, dict(states[known].step)))
        states[known].link = copy
        while at >= 0 and states[at].step.get(word) == known:
            states[at].step[word] = copy
            at = states[at].link
        return copy

    def statistics(self, sequence: Sequence[int]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest run that ends at each word."""
        at, length, states = 0, 0, self.states
        for word in sequence:
            while at and word not in states[at].step:
                at = states[at].link
                length = states[at].length
            if word in states[at].step:
                at, length = states[at].step[word], length + 1
            yield at, length


@dataclass
class Found:
    """What a text holds: places of phrases and, per template, the words its best chain covers."""

    places: list[tuple[int, int]] = field(default_factory=list)  # (first word, phrase)
    covered: dict[int, int] = field(default_factory=dict)


class Scanner:
    """Templates and phrases as one automaton, with the tables that choose what to stream."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.phrases, self.templates = phrases, templates
        sequences = [words_of(text) for text in (*(p for p, _ in phrases), *(t for _, t in templates))]
        self.word_no = {w: i for i, w in enumerate(dict.fromkeys(w for s in sequences for w in s))}
        numbered = [[self.word_no[w] for w in s] for s in sequences]
        self.sizes = [len(s) for s in numbered]
        self.automaton = Automaton(numbered)
        many = len(self.word_no)
        self.neighbours = np.zeros((many + 1, many + 1), bool)  # the last number stands for all other words
        for s in numbered:
            self.neighbours[s[:-1], s[1:]] = True
        joined = np.frombuffer(b" ".join(self.word_no), np.uint8)
        sizes = np.array([len(w) for w in self.word_no])
        ends = np.cumsum(sizes + 1) - 1
        hashes = span_hashes(prefix_sums(joined), ends - sizes, ends)
        self.by_hash = np.argsort(hashes)
        self.hashes = hashes[self.by_hash]
        self.states = [self._of_state(i) for i in range(len(self.automaton.states))]

    def _of_state(self, i: int) -> tuple[list, list]:
        """The phrases that a state's strings end with, and its ends in templates per suffix length.

        An end that only shorter suffixes have is listed with the longest suffix that has it.
        """
        phrases, ends, seen, states = [], [], set(), self.automaton.states
        while i > 0:
            s = states[i]
            for number, place in s.ends:
                if (number, place) in seen:
                    continue
                seen.add((number, place))
                if number >= len(self.phrases):
                    ends.append((number, place, s.length))
                elif place + 1 == self.sizes[number] and s.length >= place + 1:
                    phrases.append((number, place + 1))
            i = s.link
        return phrases, ends

    def pieces(self, data: np.ndarray, offsets: np.ndarray):
        """Words per text, and the runs of words worth streaming: (text, number of the first word, words)."""
        inside = IN_WORD[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        text = np.searchsorted(offsets, starts, side="right") - 1
        n_words = np.bincount(text, minlength=len(offsets) - 1)
        hashes = span_hashes(prefix_sums(data), starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        number = np.where(self.hashes[at] == hashes, self.by_hash[at], len(self.hashes))
        close = np.flatnonzero(self.neighbours[number[:-1], number[1:]] & (text[1:] == text[:-1]))
        first = close[np.diff(close, prepend=-2) != 1]
        last = close[np.diff(close, append=len(starts) + 2) != 1] + 1
        begin = np.cumsum(n_words) - n_words
        runs = [
            (text[i], int(i - begin[text[i]]), [data[s:e].tobytes() for s, e in zip(starts[i : j + 1], ends[i : j + 1])])
            for i, j in zip(first.tolist(), last.tolist())
        ]
        return n_words, runs

    def scan(self, runs: list[tuple[int, list[bytes]]]) -> Found:
        """``runs``: (number of the first word, words) of one text, in order."""
        found, matches = Found(), {}
        for first, words in runs:
            numbers = [self.word_no.get(w, -1) for w in words]
            open_runs: dict[tuple[int, int], int] = {}  # (template, diagonal) -> first word in the text
            for at, (state, length) in enumerate(self.automaton.statistics(numbers), first):
                phrases, ends = self.states[state]
                found.places += [(at - size + 1, p) for p, size in phrases if length >= size]
                going = {}
                for number, place, most in ends:
                    if (size := min(most, length)) >= LONG:
                        diagonal = (number, place - at)
                        going[diagonal] = open_runs.get(diagonal, at - size + 1)
                for (number, shift), start in open_runs.items():
                    if (number, shift) not in going:
                        matches.setdefault(number, []).append((start, at, start + shift))
                open_runs = going
            stop = first + len(words)
            for (number, shift), start in open_runs.items():
                matches.setdefault(number, []).append((start, stop, start + shift))
        found.covered = {number: best_chain(found_runs) for number, found_runs in matches.items()}
        return found

    def coverage(self, found: Found) -> dict[int, float]:
        return {number: words / self.sizes[number] for number, words in found.covered.items()}


def best_chain(runs: list[tuple[int, int, int]]) -> int:
    """Most template words that a chain of runs ``(start, stop, template start)`` covers.

    Runs follow each other in text and template with gaps of at most ``GAP`` words; where two overlap
    the later one counts from the end of the overlap. Only runs that ended less than a gap ago are looked
    at, so a long text costs what its neighbouring runs cost.
    """
    best, chains = 0, []  # chains: (stop in the text, stop in the template, words covered)
    for start, stop, there in sorted(runs):
        size = stop - start
        chains = [c for c in chains if c[0] >= start - GAP]
        covered = size
        for text_stop, template_stop, words in chains:
            overlap = max(0, text_stop - start, template_stop - there)
            if overlap < size and there - template_stop <= GAP:
                covered = max(covered, words + size - overlap)
        chains.append((stop, there + size, covered))
        best = max(best, covered)
    return best


_scanners: list[Scanner] = []


def scanner() -> Scanner:
    """One scanner per worker process."""
    if not _scanners:
        _scanners.append(Scanner())
    return _scanners[0]


RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    s = scanner()
    for part, data, offsets in slices(batches):
        n_words, runs = s.pieces(lowered(data), offsets)
        n = part.num_rows
        n_base, scores = np.zeros(n, np.int64), np.zeros(n)
        first, last, base, labels = [None] * n, [None] * n, [""] * n, [""] * n
        by_text: dict[int, list] = {}
        for text, at, words in runs:
            by_text.setdefault(int(text), []).append((at, words))
        for text, pieces in by_text.items():
            found = s.scan(pieces)
            covered = s.coverage(found)
            named = {s.phrases[p][1] for _, p in found.places}
            more = {s.templates[t - len(s.phrases)][0] for t, part_of in covered.items() if part_of >= COVERED}
            n_base[text] = len(found.places)
            if found.places:
                places = [at for at, _ in found.places]
                first[text], last[text] = min(places), max(places)
            base[text], labels[text] = ",".join(sorted(named)), ",".join(sorted(named | more))
            scores[text] = max(covered.values(), default=0.0)
        yield pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(n_words.astype(np.int64)), pa.array(n_base), pa.array(first, pa.int64()),
             pa.array(last, pa.int64()), pa.array(base, pa.string()), pa.array(labels, pa.string()), pa.array(scores)],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
        )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Labels, places and coverage per document; one pass over the texts, nothing is shuffled."""
    return corpus(docs).mapInArrow(_scan, RESULT)


def covered_spans(docs: DataFrame) -> DataFrame:
    """One row per document and template that has a chain: the words covered and their part of it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scanner()
        for part, data, offsets in slices(batches):
            by_text: dict[int, list] = {}
            for text, at, words in s.pieces(lowered(data), offsets)[1]:
                by_text.setdefault(int(text), []).append((at, words))
            rows = [
                (text, number - len(s.phrases), words, part_of)
                for text, pieces in by_text.items()
                for found in [s.scan(pieces)]
                for (number, words), part_of in zip(found.covered.items(), s.coverage(found).values())
            ]
            text, template, words, part_of = ([r[k] for r in rows] for k in range(4))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(text, pa.int64())), pa.array([s.templates[t][0] for t in template], pa.string()),
                 pa.array(template, pa.int32()), pa.array(words, pa.int64()), pa.array(part_of, pa.float64())],
                ["doc_id", "label", "template", "words", "coverage"],
            )

    return corpus(docs).mapInArrow(work, "doc_id long, label string, template int, words long, coverage double")
