"""Licence scans by a generalised suffix automaton over the words of licence templates.

A document's words stream through the automaton, which gives at each word the longest
run ending there that stands in some template (the matching statistics). Long maximal runs
are placed in their templates and chained, in order on both sides, into covered spans.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradevigil.llm import words

#: Shortest run that is placed, largest gap in a chain (document words), and the share of a
#: template, by weight of its words, that a chain must cover for its label.
LEAST_RUN, MOST_GAP, COVERED = 3, 40, 0.6

#: Phrases that always label; fixed values.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Public licence notices; fixed values.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
]


class Automaton:
    """Generalised suffix automaton over sequences of small integers."""

    def __init__(self, sequences: list[list[int]]):
        self.sequences = sequences
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for sequence in sequences:
            last = 0
            for symbol in sequence:
                last = self._extend(last, symbol)
        #: (sequence, past-the-last place) of the occurrences of each state's runs
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for number, sequence in enumerate(sequences):
            state = 0
            for place, symbol in enumerate(sequence, 1):
                state = up = self.next[state][symbol]
                while up > 0:
                    self.ends[up].append((number, place))
                    up = self.link[up]
        self._ended: dict[tuple[int, int | None, int], list[tuple[int, int, int]]] = {}

    def _state(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, state: int, symbol: int) -> int:
        """The state of runs that end in `symbol` after `state`, of that length alone."""
        to = self.next[state][symbol]
        if self.length[to] == self.length[state] + 1:
            return to
        copy = self._state(self.length[state] + 1, dict(self.next[to]), self.link[to])
        self.link[to] = copy
        while state >= 0 and self.next[state].get(symbol) == to:
            self.next[state][symbol] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, symbol: int) -> int:
        if symbol in self.next[last]:
            return self._split(last, symbol)
        new = self._state(self.length[last] + 1, {}, 0)
        while last >= 0 and symbol not in self.next[last]:
            self.next[last][symbol] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, symbol)
        return new

    def runs(self, symbols: list[int], places: list[int], least: int) -> Iterator[tuple[int, int, int]]:
        """Start, length and state of each run of at least `least` that cannot go on.

        `symbols` are the known ones of a text and `places` where they stand in it.
        """
        state = length = 0
        before = -2
        for symbol, place in zip(symbols, places, strict=True):
            s, n = (state, length) if place == before + 1 else (0, 0)
            while s and symbol not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            to = self.next[s].get(symbol)
            s, n = (to, n + 1) if to is not None else (0, 0)
            if n != length + 1 and length >= least or place != before + 1 and length >= least:
                yield before - length + 1, length, state
            state, length, before = s, n, place
        if length >= least:
            yield before - length + 1, length, state


    def ended(self, state: int, symbol: int | None, least: int) -> list[tuple[int, int, int]]:
        """Sequence, past-the-last place in it and length (0: the whole run) of each run of at
        least `least` that ends a run of this state and does not go on with `symbol` there."""
        found = self._ended.get((state, symbol, least))
        if found is None:
            found, seen, up = [], set(), state
            while up > 0 and self.length[up] >= least:
                for number, place in self.ends[up]:
                    own = self.sequences[number]
                    if (number, place) not in seen and (symbol is None or place == len(own) or own[place] != symbol):
                        found.append((number, place, 0 if up == state else self.length[up]))
                    seen.add((number, place))
                up = self.link[up]
            self._ended[state, symbol, least] = found
        return found

    def placed(self, symbols: list[int], places: list[int], least: int) -> Iterator[tuple[int, int, int, int]]:
        """Sequence, start in the text, length and start in the sequence of each run of at least
        `least` that cannot go on in that sequence on either side, also where it goes on in another."""
        state = length = 0
        before = -2
        for symbol, place in zip([*symbols, None], [*places, -1], strict=True):
            joined = place == before + 1
            if length >= least:
                for number, end, n in self.ended(state, symbol if joined else None, least):
                    n = n or length
                    yield number, before - n + 1, n, end - n
            s, n = (state, length) if joined else (0, 0)
            while s and symbol not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            to = self.next[s].get(symbol)
            state, length, before = (to, n + 1, place) if to is not None else (0, 0, place)


class Scanner:
    """Spans of templates, and places of phrases, in whole texts."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        parts = [words.split(text, words.ALNUM) for _, text in templates]
        wanted = [(words.split(p, words.ALNUM), label) for p, label in phrases.items()]
        known = {w for p in parts for w in p} | {w for p, _ in wanted for w in p}
        self.codes = {w: i for i, w in enumerate(sorted(known))}
        self.labels = [label for label, _ in templates]
        own = Counter(w for p in parts for w in set(p))
        weights = {w: round(1000 * log(1 + len(parts) / n)) for w, n in own.items()}
        #: weight of the words before each place of a template
        self.weights = [[0, *accumulate(weights[w] for w in p)] for p in parts]
        self.automaton = Automaton([[self.codes[w] for w in p] for p in parts])
        self.phrases = [([self.codes[w] for w in p], label) for p, label in wanted]

    def scan(self, text: str | None) -> tuple[int, list[int], set[str], list[tuple[str, int, int, float]]]:
        """Number of words; starts and labels of phrases; label, first and past-the-last word
        and covered share of each template's chains: the best, and all others that reach `COVERED`,
        but for those inside a fuller span of another label."""
        parts = words.split(text, words.ALNUM)
        codes = np.fromiter((self.codes.get(w, -1) for w in parts), dtype=np.int64, count=len(parts))
        starts, labels = [], set()
        for phrase, label in self.phrases:
            here = np.ones(max(0, len(codes) - len(phrase) + 1), dtype=bool)
            for i, code in enumerate(phrase):
                here &= codes[i : i + len(here)] == code
            if here.any():
                starts += np.flatnonzero(here).tolist()
                labels.add(label)
        places = np.flatnonzero(codes >= 0)
        placed: dict[int, list[tuple[int, int, int]]] = {}
        for template, start, n, at in self.automaton.placed(codes[places].tolist(), places.tolist(), LEAST_RUN):
            placed.setdefault(template, []).append((start, n, at))
        spans = [(t, *chain) for t, hits in sorted(placed.items()) for chain in _chains(hits, self.weights[t])]
        return len(parts), starts, labels, [(self.labels[t], *rest) for t, *rest in self._told_apart(spans)]

    def _told_apart(self, spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
        """All but spans that lie inside one of another label which covers more of its template:
        templates share words, and the fuller match explains them."""
        kept, last = [], {}  # last: per template its full span that reaches furthest so far
        for span in sorted(spans, key=lambda s: (s[1], -s[2], -s[3])):
            t, _, end, covered = span
            if not any(e >= end and c > covered and self.labels[o] != self.labels[t] for o, (e, c) in last.items()):
                kept.append(span)
            if covered >= COVERED and end > last.get(t, (0, 0))[0]:
                last[t] = end, covered
        return sorted(kept)


def _chains(hits: list[tuple[int, int, int]], weights: list[int]) -> list[tuple[int, int, float]]:
    """First and past-the-last document word, and covered share, of the best chain and of all
    others that reach `COVERED`, in order of the document.

    `hits`: start in the document, length, start in the template. A chain goes on in both,
    over gaps of at most `MOST_GAP` document words; of equal chains the first wins. Chains
    share no word: further ones are built of the hits outside those found. A word's share is by
    its weight in the template, which is larger the fewer templates have it.
    """
    hits, size = sorted(hits), weights[-1]
    found: list[tuple[int, int, float]] = []
    while hits:
        best = _linked(hits, weights)
        origin = hits[0][0]
        taken = bytearray(max(s + n for s, n, _ in hits) - origin)
        before = len(found)
        for top in sorted(range(len(hits)), key=lambda i: (-best[i][0], i)):
            if found and best[top][0] < COVERED * size:
                break
            chain, i = [], top
            while i >= 0:
                chain.append(hits[i])
                i = best[i][1]
            if any(any(taken[s - origin : s - origin + n]) for s, n, _ in chain):
                continue
            for s, n, _ in chain:
                taken[s - origin : s - origin + n] = b"\1" * n
            found.append((chain[-1][0], chain[0][0] + chain[0][1], best[top][0] / size))
        if len(found) == before:
            break
        hits = [h for h in hits if not any(taken[h[0] - origin : h[0] - origin + h[1]])]
    return sorted(found)


def _linked(hits: list[tuple[int, int, int]], weights: list[int]) -> list[tuple[int, int]]:
    """Weight covered by the best chain that ends with each hit, and the hit before it or -1."""
    best: list[tuple[int, int]] = []
    low, size = 0, len(weights) - 1
    for i, (start, n, at) in enumerate(hits):
        own = weights[at + n] - weights[at]
        while hits[low][0] + size + MOST_GAP < start:
            low += 1
        covered, last = own, -1
        for j in range(low, i):
            s, m, a = hits[j]
            if s + m <= start <= s + m + MOST_GAP and a + m <= at and best[j][0] + own > covered:
                covered, last = best[j][0] + own, j
        best.append((covered, last))
    return best


_SPANS = "array<struct<label:string,first_word:int,end_word:int,covered:double>>"


def scanned(docs: DataFrame, templates=None, phrases=None) -> DataFrame:
    """Per row: `doc_id`, `n_words`, `starts` and `phrase_labels` of phrases, `spans` of templates.

    Templates and phrases are short lists that the caller gives. NULL text is empty;
    repeated rows each get a row.
    """
    scanner = Scanner(TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scanner.scan(text.as_py()) for text in batch.column(1)]
            spans = [[dict(zip(names, s, strict=True)) for s in f[3]] for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.list_(pa.int64())),
                    pa.array([sorted(f[2]) for f in found], pa.list_(pa.string())),
                    pa.array(spans, pa.list_(pa.struct(list(zip(names, kinds, strict=True))))),
                ],
                ["doc_id", "n_words", "starts", "phrase_labels", "spans"],
            )

    names = ["label", "first_word", "end_word", "covered"]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.float64()]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words bigint, starts array<bigint>, phrase_labels array<string>, spans {_SPANS}"
    )


def report(docs: DataFrame) -> DataFrame:
    """The columns of `op4_license_scan`; `score` is the largest share of a template covered."""
    own = F.transform(F.filter("spans", lambda s: s["covered"] >= COVERED), lambda s: s["label"])
    labels = F.array_sort(F.array_union("phrase_labels", own))
    covered = F.array_max(F.transform("spans", lambda s: s["covered"]))
    return scanned(docs).select(
        "doc_id",
        "n_words",
        F.size("starts").cast("bigint").alias("n_base"),
        F.array_min("starts").alias("first_word"),
        F.array_max("starts").alias("last_word"),
        F.array_join("phrase_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.coalesce(covered, F.lit(0.0)).alias("score"),
    )
