"""Licence scan by matching statistics against a suffix automaton of licence templates.

One automaton holds all templates. A text streams through it word by word; for each
word it knows the longest part of any template that ends there. Long matches that follow
one another both in the text and in a template are chained to spans, and a span that
covers enough of its template names the licence. A whole template, and a short phrase,
stands wherever the current match ends with it, also if the text goes on as a longer template does.
"""

from bisect import bisect_left, bisect_right
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_text
from .words import words

# Phrases and their labels are part of the contract.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Wording of public licence notices.
TEMPLATES = {
    "apache-2.0": (
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at""",
        "Licensed under the Apache License, Version 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met""",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by": (
        "This work is licensed under the Creative Commons Attribution 4.0 International License",
        "licensed under a Creative Commons Attribution",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "gpl": (
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the
        License, or (at your option) any later version""",
        "This work is licensed under the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "isc": (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear
        in all copies""",
    ),
    "mit": (
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction""",
        "Released under the MIT License",
        "Licensed under the MIT License",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
}


class SuffixAutomaton:
    """Suffix automaton of several word sequences, set apart by tokens that no text has."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]
        last = 0
        for number, sequence in enumerate(sequences):
            for place, token in enumerate(sequence):
                last = self._extend(last, token)
                ends += [[] for _ in range(len(self.next) - len(ends))]
                ends[last].append((number, place + 1))
            last = self._extend(last, number)  # an int never equals a word
            ends += [[] for _ in range(len(self.next) - len(ends))]
        # Where the strings of a state end: its own and those of all states that link to it.
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                ends[self.link[state]].extend(ends[state])
        self.ends = [sorted(set(places)) for places in ends]

    def _extend(self, last: int, token) -> int:
        state = self._new(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and token not in self.next[at]:
            self.next[at][token] = state
            at = self.link[at]
        if at >= 0:
            target = self.next[at][token]
            if self.length[target] == self.length[at] + 1:
                self.link[state] = target
            else:
                clone = self._new(self.length[at] + 1, self.link[target], dict(self.next[target]))
                while at >= 0 and self.next[at].get(token) == target:
                    self.next[at][token] = clone
                    at = self.link[at]
                self.link[target] = self.link[state] = clone
        return state

    def _new(self, length: int, link: int, edges: dict) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def state_of(self, sequence: list[bytes]) -> int:
        state = 0
        for token in sequence:
            state = self.next[state][token]
        return state


@dataclass
class Span:
    """A chain of matches of a template: word range of the text, words covered."""

    template: int
    start: int
    end: int
    template_end: int
    covered: int


class LicenceIndex:
    """All templates and phrases in one automaton."""

    def __init__(
        self,
        phrases: Mapping[str, str] = PHRASES,
        templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
        min_match: int = 3,
        max_gap: int = 12,
        min_coverage: float = 0.75,
    ):
        named = [(label, words(text)) for label, texts in templates.items() for text in texts]
        short = [(label, words(text)) for text, label in phrases.items()]
        self.labels = [label for label, _ in named]
        self.sizes = [len(sequence) for _, sequence in named]
        self.min_match, self.max_gap, self.min_coverage = min_match, max_gap, min_coverage
        self.automaton = SuffixAutomaton([s for _, s in named] + [s for _, s in short])
        self.phrase_labels = [label for label, _ in short]
        self.vocabulary = frozenset(word for _, s in named + short for word in s)
        self.phrases_at = self._wholes_at([sequence for _, sequence in short])
        self.templates_at = self._wholes_at([sequence for _, sequence in named])

    def _wholes_at(self, sequences: list[list[bytes]]) -> list[tuple[tuple[int, int], ...]]:
        """For each state the sequences that its longest string ends with, as (sequence, length)."""
        own: dict[int, list[tuple[int, int]]] = {}
        for number, sequence in enumerate(sequences):
            if sequence:
                own.setdefault(self.automaton.state_of(sequence), []).append((number, len(sequence)))
        found: list[tuple[tuple[int, int], ...]] = [()] * len(self.automaton.next)
        for state in sorted(range(1, len(found)), key=lambda s: self.automaton.length[s]):
            found[state] = (*own.get(state, ()), *found[self.automaton.link[state]])
        return found

    def scan(self, text: list[bytes]) -> tuple[list[tuple[int, int]], list[Span]]:
        """Places of phrases as (start, phrase), and all whole templates and chains of template matches."""
        known = [at for at, word in enumerate(text) if word in self.vocabulary]
        places: list[tuple[int, int]] = []
        matches: list[tuple[int, int, int]] = []  # text end, length, state
        wholes: list[Span] = []
        edges, link, length_of = self.automaton.next, self.automaton.link, self.automaton.length
        state = size = 0
        previous = -2
        for at in known:
            if at != previous + 1:  # a word that no template has ends every match
                if size >= self.min_match:
                    matches.append((previous + 1, size, state))
                state = size = 0
            previous, word = at, text[at]
            if word in edges[state]:
                state, size = edges[state][word], size + 1
            else:
                if size >= self.min_match:
                    matches.append((at, size, state))
                while state and word not in edges[state]:
                    state = link[state]
                size = length_of[state]
                if word in edges[state]:
                    state, size = edges[state][word], size + 1
            for phrase, length in self.phrases_at[state]:
                if size >= length:
                    places.append((at - length + 1, phrase))
            for template, length in self.templates_at[state]:
                if size >= length:
                    wholes.append(Span(template, at - length + 1, at + 1, length, length))
        if size >= self.min_match:
            matches.append((previous + 1, size, state))
        chains = self._chains(matches)
        return places, chains + self._unchained(wholes, chains)

    def _unchained(self, wholes: list[Span], chains: list[Span]) -> list[Span]:
        """The whole templates that no chain covering all of the same template has within it."""
        full: dict[int, list[tuple[int, int]]] = {}
        for chain in sorted(chains, key=lambda c: c.start):
            if chain.covered >= self.sizes[chain.template]:
                full.setdefault(chain.template, []).append((chain.start, chain.end))
        out = []
        for whole in wholes:
            ranges = full.get(whole.template, [])
            before = bisect_right(ranges, whole.start, key=lambda r: r[0])
            if not before or ranges[before - 1][1] < whole.end:
                out.append(whole)
        return out

    def _chains(self, matches: list[tuple[int, int, int]]) -> list[Span]:
        """Chain matches in text order: each goes on with the open chain of its template, or opens one."""
        open_chains: dict[int, Span] = {}
        closed: list[Span] = []
        for end, size, state in matches:
            by_template: dict[int, list[int]] = {}
            for template, template_end in self.automaton.ends[state]:
                if template < len(self.sizes):
                    by_template.setdefault(template, []).append(template_end)
            for template, ends in by_template.items():
                chain = open_chains.get(template)
                if chain and end - size - chain.end <= self.max_gap:
                    # The nearest occurrence that brings the chain forward.
                    place = bisect_left(ends, chain.template_end + 1)
                    if place < len(ends):
                        chain.covered += min(size, ends[place] - chain.template_end, end - chain.end)
                        chain.template_end, chain.end = ends[place], end
                        continue
                if chain:
                    closed.append(chain)
                open_chains[template] = Span(template, end - size, end, ends[0], size)
        return closed + list(open_chains.values())

    def row(self, text: str) -> tuple:
        found = words(text)
        places, chains = self.scan(found)
        starts = [start for start, _ in places]
        base = {self.phrase_labels[phrase] for _, phrase in places}
        spans = []
        best = 1.0 if places else 0.0
        for chain in sorted(chains, key=lambda c: (c.start, c.end, c.template)):
            coverage = chain.covered / self.sizes[chain.template]
            best = max(best, coverage)
            if coverage >= self.min_coverage:
                spans.append((self.labels[chain.template], chain.start, chain.end, coverage))
        labels = base | {label for label, *_ in spans}
        return (
            len(found),
            len(places),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(labels)),
            best,
            spans,
        )


def scan_licenses(
    docs: DataFrame, index: LicenceIndex | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Licence phrases and template spans of every whole text.

    ``score`` is the largest share of a template that a chain covers, and 1 where a phrase
    or a whole template stands, also within a longer template; ``found`` has the spans of at least ``min_coverage`` in words. A null or
    empty text has no words, empty labels and score 0. Repeated rows give repeated rows, an
    empty table none, null ids stay null; other columns are ignored.
    """
    index = index or LicenceIndex()
    schema = (
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, found array<struct<label:string,start:long,end:long,coverage:double>>"
    )
    shared = docs.sparkSession.sparkContext.broadcast(index)
    scanned = docs.select(
        F.col(id_col).alias("id"), per_text(lambda text: shared.value.row(text), schema)(text_col).alias("s")
    )
    return scanned.select(F.col("id").alias(id_col), "s.*")
