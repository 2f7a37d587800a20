"""Licence scan by a generalised suffix automaton of licence tokens.

The automaton holds all runs of words of the templates (notices of licences) and phrases.  A text is
streamed through it word by word: at each word it has the longest run ending there that some template
contains (the matching statistic), and the places of that run in the templates.  Runs that cannot be
made longer and have MIN_MATCH words are chained, in the order of text and template, over gaps of at
most MAX_GAP words on both sides; a chain that covers MIN_SHARE of its template is a span of
that licence.  A phrase stands where it is a suffix of the longest run: one of the automaton's links.

Words that begin no run of two words of any template leave the automaton at its start, so only
stretches of words that follow each other in templates are streamed; numpy finds these.  Texts are
read once, nothing is shuffled, and the automaton is as large as the templates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import RID, RID_TYPE, byte_slices, numbered
from txnlake.llm.words import buffers, cuts_between_words, words_of

CHUNK_BYTES = 1 << 20
MIN_MATCH = 3
MAX_GAP = 8
MIN_SHARE = 0.75
REMEMBERED = 20_000  # stretches of at most LONGEST_REMEMBERED words
LONGEST_REMEMBERED = 64

# Phrases that are looked for word by word, and their labels.
PHRASES = [
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
]

# Sentences of the notices that the licences themselves recommend, and their labels.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of "
        "the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation",
    ),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    (
        "cc-by-sa",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    (
        "cc-by-nc",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


def template_words(text: str) -> list[str]:
    data = np.frombuffer(text.encode(), np.uint8)
    words = words_of(data, np.array([0, len(data)]))
    return [words.text(i, i + 1) for i in range(len(words.starts))]


class Automaton:
    """Suffix automaton of several sequences of numbers; state 0 is the empty run.

    `length` is the longest run of a state, `link` the state of its longest suffix with more
    places, `places` the (sequence, end) pairs where the runs of a state end.
    """

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.places: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for end, token in enumerate(sequence, 1):
                last = self._extend(last, token)
                self.places[last].add((number, end))
        # What ends at a state's runs ends at their suffixes as well.
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.places[self.link[state]] |= self.places[state]

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.places.append(set())
        return len(self.link) - 1

    def _split(self, above: int, token: int) -> int:
        """The state that `token` leads to from `above`, for runs no longer than one word more."""
        old = self.next[above][token]
        if self.length[old] == self.length[above] + 1:
            return old
        short = self._state(self.length[above] + 1, dict(self.next[old]), self.link[old])
        self.link[old] = short
        while above >= 0 and self.next[above].get(token) == old:
            self.next[above][token] = short
            above = self.link[above]
        return short

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, token)
        new = self._state(self.length[last] + 1, {}, 0)
        above = last
        while above >= 0 and token not in self.next[above]:
            self.next[above][token] = new
            above = self.link[above]
        if above >= 0:
            self.link[new] = self._split(above, token)
        return new

    def stream(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """For each token the state and length of the longest run that ends with it."""
        state = length = 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                length += 1
            yield state, length


@dataclass
class Found:
    """What one text holds; places are word numbers."""

    n_words: int = 0
    phrases: list[tuple[int, int]] = field(default_factory=list)  # (phrase, start)
    spans: list[tuple[int, int, int, int]] = field(default_factory=list)  # template, start, end, n
    score: float = 0.0


class Scanner:
    """Finds phrases and spans of templates; both are (label, text) pairs."""

    def __init__(self, templates, phrases):
        sequences = [template_words(text) for _, text in [*templates, *phrases]]
        if any(len(words) < 2 for words in sequences):
            raise ValueError("templates and phrases need two words")
        vocabulary = sorted({w for words in sequences for w in words})
        numbers = {w: i + 1 for i, w in enumerate(vocabulary)}  # 0 is any other word
        sequences = [[numbers[w] for w in words] for words in sequences]
        self.labels = [label for label, _ in [*templates, *phrases]]
        self.sizes = [len(words) for words in sequences]
        self.n_templates = len(templates)
        self.automaton = Automaton(sequences)
        self._phrases_at()
        self.follows = np.zeros((len(numbers) + 1, len(numbers) + 1), bool)
        for words in sequences:
            self.follows[words[:-1], words[1:]] = True
        self._table(vocabulary)
        self.known: dict[bytes, tuple] = {}

    def _phrases_at(self) -> None:
        """For each state the phrases that end its runs, or its runs of some length on."""
        phrase_of: dict[int, list[tuple[int, int]]] = {}
        for state, places in enumerate(self.automaton.places):
            for number, end in places:
                size = self.sizes[number]
                longest, link = self.automaton.length[state], self.automaton.link[state]
                if number >= self.n_templates and end == size and longest >= size:
                    if self.automaton.length[link] < size:
                        phrase_of.setdefault(state, []).append((number, size))
        self.phrases_at: list[list[tuple[int, int]]] = []
        for state in range(len(self.automaton.link)):
            found, above = [], state
            while above > 0:
                found += phrase_of.get(above, [])
                above = self.automaton.link[above]
            self.phrases_at.append(sorted(found))

    def _table(self, vocabulary: list[str]) -> None:
        """Hashes of the words in order, their numbers, and their bytes, filled up with zeros."""
        data = [w.encode() for w in vocabulary]
        words = words_of(
            np.frombuffer(b" ".join(data), np.uint8), np.array([0, sum(map(len, data)) + len(data) - 1])
        )
        order = np.argsort(words.hashes)
        self.hashes, self.number_of = words.hashes[order], order + 1
        self.bytes = np.zeros((len(data) + 1, max(map(len, data))), np.uint8)
        self.widths = np.array([0, *map(len, data)])
        for i, word in enumerate(data, 1):
            self.bytes[i, : len(word)] = np.frombuffer(word, np.uint8)

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of some texts, 0 where no template has them; first word of each."""
        words = words_of(data, offsets)
        at = np.searchsorted(self.hashes, words.hashes)
        at[at == len(self.hashes)] = 0
        number = np.where(self.hashes[at] == words.hashes, self.number_of[at], 0)
        number[words.ends - words.starts != self.widths[number]] = 0
        # The hash only finds candidates: the bytes decide.
        maybe = np.flatnonzero(number)
        column = np.arange(self.bytes.shape[1])
        inside = column < self.widths[number[maybe]][:, None]
        places = np.minimum(words.starts[maybe][:, None] + column, max(0, len(words.low) - 1))
        own = np.where(inside, words.low[places], 0) if len(maybe) else self.bytes[:0]
        number[maybe[(own != self.bytes[number[maybe]]).any(axis=1)]] = 0
        return number, words.first

    def _streamed(self, tokens: np.ndarray) -> tuple[list, list]:
        """(phrase, start) pairs and (state, start, end) of runs that cannot be made longer."""
        key = tokens.tobytes() if len(tokens) <= LONGEST_REMEMBERED else None
        if key in self.known:
            return self.known[key]
        phrases, runs = [], []
        before = (0, 0)
        for end, (state, length) in enumerate(self.automaton.stream(tokens.tolist()), 1):
            phrases += [(p, end - size) for p, size in self.phrases_at[state] if size <= length]
            if length <= before[1] and before[1] >= MIN_MATCH:
                runs.append((before[0], end - 1 - before[1], end - 1))
            before = (state, length)
        if before[1] >= MIN_MATCH:
            runs.append((before[0], len(tokens) - before[1], len(tokens)))
        if key is not None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[key] = phrases, runs
        return phrases, runs

    def scan(self, tokens: np.ndarray) -> Found:
        """What stands in one text, given as the numbers of its words."""
        found = Found(len(tokens))
        linked = self.follows[tokens[:-1], tokens[1:]]
        edges = np.flatnonzero(np.diff(np.r_[False, linked, False].astype(np.int8)))
        matches: dict[int, list[tuple[int, int, int]]] = {}
        for start, end in zip(edges[::2].tolist(), (edges[1::2] + 1).tolist(), strict=True):
            phrases, runs = self._streamed(tokens[start:end])
            found.phrases += [(p, start + at) for p, at in phrases]
            for state, a, b in runs:
                for template, place in self.automaton.places[state]:
                    if template < self.n_templates:
                        matches.setdefault(template, []).append((start + a, start + b, place))
        for template, own in matches.items():
            self._chain(template, sorted(own), found)
        if found.phrases:
            found.score = 1.0
        found.spans.sort(key=lambda s: (s[1], s[2], s[0]))
        return found

    def _chain(self, template: int, matches: list[tuple[int, int, int]], found: Found) -> None:
        """Chains of matches (start, end, end in the template) of one template."""
        size = self.sizes[template]
        covered, begin, came = [], [], []
        continued = [False] * len(matches)
        reach = 0
        for i, (start, end, place) in enumerate(matches):
            length = end - start
            while matches[reach][0] + size + MAX_GAP < start:
                reach += 1  # too far back for any match, as none is longer than the template
            best, link = length, -1
            for j in range(reach, i):
                start_j, end_j, place_j = matches[j]
                gap, skipped = start - end_j, place - length - place_j
                if start_j < start and end_j < end and place_j < place and gap <= MAX_GAP:
                    if skipped <= MAX_GAP and place_j - (end_j - start_j) < place - length:
                        total = covered[j] + length + min(0, gap, skipped)
                        if total > best:
                            best, link = total, j
            covered.append(best)
            begin.append(start if link < 0 else begin[link])
            came.append(link)
            if link >= 0:
                continued[link] = True
        for i, total in enumerate(covered):
            found.score = max(found.score, total / size)
            if not continued[i] and total >= MIN_SHARE * size:
                found.spans.append((template, begin[i], matches[i][1], total))


def _texts(scanner: Scanner, column: pa.Array) -> Iterator[Found]:
    """One after the other; a text longer than a chunk is cut into pieces, its words put together."""
    data, offsets = buffers(column)
    for a, b in byte_slices(np.diff(offsets).tolist(), CHUNK_BYTES):
        own = data[offsets[a] : offsets[b]]
        if b - a > 1 or len(own) <= CHUNK_BYTES:
            tokens, first = scanner.tokens(own, offsets[a : b + 1] - offsets[a])
            for x, y in zip(first[:-1], first[1:], strict=True):
                yield scanner.scan(tokens[x:y])
        else:
            cuts = cuts_between_words(own, CHUNK_BYTES)
            pieces = [
                scanner.tokens(own[x:y], np.array([0, y - x]))[0].astype(np.int32)
                for x, y in zip(cuts[:-1], cuts[1:], strict=True)
            ]
            yield scanner.scan(np.concatenate(pieces))


def scan(
    docs: DataFrame,
    templates=tuple(TEMPLATES),
    phrases=tuple(PHRASES),
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_words, phrases, spans, score, _rid.

    `phrases` are all places (label, start) of phrases, `spans` the chains that cover enough of a
    template: (label, template, start, stop, covered, share), in the order of the text.  Words are
    runs of digits, letters and non-ASCII characters, A-Z lower-cased, numbered from 0.  `score` is
    the largest share that a chain covers of its template, also of one that covers too little for a
    span, and 1 where a phrase stands.  Null and empty texts have no words, no places and score 0.
    Repeated rows are treated alike; an empty table gives an empty result; other columns are not read.
    """
    rows = numbered(docs, F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(Scanner(templates, phrases))
    kind = rows.schema["doc_id"].dataType.simpleString()
    place = "struct<label: string, start: long>"
    span = (
        "struct<label: string, template: int, start: long, stop: long, covered: long, share: double>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = shared.value
        label, sizes = scanner.labels, scanner.sizes
        types = {f.name: f.type for f in arrow}
        for batch in batches:
            found = list(_texts(scanner, batch.column("text")))
            places = [[{"label": label[p], "start": at} for p, at in f.phrases] for f in found]
            spans = [
                [
                    {"label": label[t], "template": t, "start": a, "stop": b, "covered": n,
                     "share": n / sizes[t]}
                    for t, a, b, n in f.spans
                ]
                for f in found
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(RID),
                    batch.column("doc_id"),
                    pa.array([f.n_words for f in found], pa.int64()),
                    pa.array(places, types["phrases"]),
                    pa.array(spans, types["spans"]),
                    pa.array([f.score for f in found], pa.float64()),
                ],
                names=[RID, "doc_id", "n_words", "phrases", "spans", "score"],
            )

    arrow = pa.schema(
        [
            ("phrases", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))),
            (
                "spans",
                pa.list_(
                    pa.struct(
                        [
                            ("label", pa.string()),
                            ("template", pa.int32()),
                            ("start", pa.int64()),
                            ("stop", pa.int64()),
                            ("covered", pa.int64()),
                            ("share", pa.float64()),
                        ]
                    )
                ),
            ),
        ]
    )
    out = rows.mapInArrow(
        run,
        f"{RID} {RID_TYPE}, doc_id {kind}, n_words long, phrases array<{place}>, "
        f"spans array<{span}>, score double",
    )
    return out.select("doc_id", "n_words", "phrases", "spans", "score", RID)
