"""Licence notices by a generalised suffix automaton of licence tokens.

The automaton holds every run of tokens of all templates. A text is streamed through it once, which
gives its matching statistics: for each word the longest run of words up to it that some template
holds. Matches of at least ``SEED`` words that cannot be lengthened are chained per template, in the
order of the text and of the template, with at most ``GAP`` other words between two links, into spans
with the share of the template they cover. Words count by how telling they are: a word that many
licences use counts less than a name. A span of at least ``MIN_SHARE`` gives its licence's label.

Base phrases are templates too; each place where one ends is read off the automaton's state (the
phrase is a suffix of the words read), so every place is found, overlapping ones included.

Only stretches of words whose neighbouring pairs occur in a template enter the automaton: outside
them no match has two words. Words are bytes a-z, 0-9 and those from 0x80 on, after A-Z is lowered.

Each text is read whole and alone, without a shuffle. The templates are a parameter of at most
``MOST_TOKENS`` tokens (more raise ``ValueError``); the automaton has at most twice as many states and
travels with the tasks. Defined results: a null or empty text has no words, places or spans; repeated
rows give repeated results; a null key is passed through; an empty table gives an empty table. Only
the key and the text are read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Texts, slices

SEED, GAP, MIN_SHARE, MOST_TOKENS = 3, 8, 0.75, 100_000
PHRASE_SCORE = 0.5
BREAK = np.ones(256, dtype=bool)
BREAK[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
TOKEN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

# The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices by which licences are recognised, as their authors publish them.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "bsd": (
        "Released under the BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met: Redistributions of source code must retain the above copyright notice, this"
        " list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above"
        " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution.",
    ),
    "cc-by-4.0": ("Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "cc-by-nd-4.0": ("Licensed under CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "cc0-1.0": ("CC0 1.0 Universal", "To the extent possible under law, the author has waived all copyright and related rights"),
    "gpl-2.0": ("licensed under the GNU General Public License, version 2",),
    "gpl-3.0": (
        "licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    "agpl-3.0": ("licensed under the GNU Affero General Public License, version 3",),
    "lgpl": ("licensed under the GNU Lesser General Public License", "under the terms of the GNU Lesser General Public License"),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "mit": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so",
    ),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
}

PLACE = pa.struct([("label", pa.string()), ("start", pa.int64())])
SPAN = pa.struct([(n, pa.string() if n == "label" else pa.float64() if n == "share" else pa.int64()) for n in ("label", "start", "end", "share")])


def tokens(text: str) -> list[str]:
    return TOKEN.findall("".join(c.lower() if c.isascii() else c for c in text))


class Automaton:
    """Suffix automaton of several token sequences. State 0 is the empty run; ``length`` is the
    longest run of a state and ``link`` the state of its longest suffix elsewhere."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]
        whole = []
        for number, sequence in enumerate(sequences):
            state = 0
            for position, token in enumerate(sequence):
                state = self._extend(state, token)
                while len(ends) < len(self.step):
                    ends.append([])
                ends[state].append((number, position))
            whole.append(state)
        # A run ends wherever a longer run that it is a suffix of ends.
        order = sorted(range(len(self.step)), key=self.length.__getitem__)
        for state in reversed(order[1:]):
            ends[self.link[state]] += ends[state]
        self.ends = [sorted(x) for x in ends]
        self.finished: list[tuple[int, ...]] = [()] * len(self.step)  # sequences that are suffixes of the state's runs
        own = defaultdict(list)
        for number, state in enumerate(whole):
            own[state].append(number)
        for state in order[1:]:
            self.finished[state] = (*own[state], *self.finished[self.link[state]])

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.step) - 1

    def _split(self, state: int, token: int) -> int:
        """The state of ``state``'s longest run followed by ``token``, cut out of a longer one if need be."""
        target = self.step[state][token]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._new(self.length[state] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.step[state].get(token) == target:
            self.step[state][token] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, token: int) -> int:
        if token in self.step[last]:
            return self._split(last, token)
        new = self._new(self.length[last] + 1, {}, 0)
        while last >= 0 and token not in self.step[last]:
            self.step[last][token] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, token)
        return new

    def statistics(self, stretch: Sequence[int]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest run up to each token."""
        state = length = 0
        for token in stretch:
            while state and token not in self.step[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.step[state]:
                state, length = self.step[state][token], length + 1
            yield state, length


class Scanner:
    """The automaton of all phrases and templates with the words' weights."""

    def __init__(self, templates: Mapping[str, Sequence[str]], phrases: Mapping[str, str], seed: int, gap: int):
        self.seed, self.gap = seed, gap
        named = [(label, tokens(t)) for t, label in phrases.items()]
        self.phrases = len(named)
        named += [(label, tokens(t)) for label, texts in templates.items() for t in texts]
        named = [(label, t) for label, t in named if t]
        if sum(len(t) for _, t in named) > MOST_TOKENS:
            raise ValueError(f"templates of more than {MOST_TOKENS} tokens")
        self.labels = [label for label, _ in named]
        vocabulary = sorted({w for _, t in named for w in t})
        number = {w: i for i, w in enumerate(vocabulary)}
        self.sequences = [[number[w] for w in t] for _, t in named]
        self.automaton = Automaton(self.sequences)
        used = Counter(w for label in set(self.labels) for w in {w for name, s in zip(self.labels, self.sequences) if name == label for w in s})
        weights = [[1.0 / used[w] for w in s] for s in self.sequences]
        self.before = [np.concatenate([[0.0], np.cumsum(w)]).tolist() for w in weights]  # weight of the tokens ahead
        raw = [w.encode() for w in vocabulary]
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in raw])]).astype(np.int64)
        hashes = Texts(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets, space=BREAK).word_hash()
        order = np.argsort(hashes)
        self.hashes, self.number = hashes[order], order
        pairs = {a * len(vocabulary) + b for s in self.sequences for a, b in zip(s, s[1:])}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)

    def stretches(self, texts: Texts) -> Iterator[tuple[int, int, list[int]]]:
        """(row, first word, tokens) of every stretch of words whose neighbouring pairs are known."""
        words = texts.word_hash()
        if len(words) < 2 or not len(self.pairs):
            return
        spot = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        token = np.where(self.hashes[spot] == words, self.number[spot], -1)
        left = np.flatnonzero((token[:-1] >= 0) & (token[1:] >= 0) & (texts.doc[:-1] == texts.doc[1:]))
        pair = token[left] * len(self.hashes) + token[left + 1]
        spot = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        left = left[self.pairs[spot] == pair]
        if not len(left):
            return
        cut = np.flatnonzero(np.diff(left) != 1) + 1
        for part in np.split(left, cut):
            a, b = int(part[0]), int(part[-1]) + 2
            row = int(texts.doc[a])
            yield row, a - int(texts.first[row]), token[a:b].tolist()

    def scan(self, stretches: list[tuple[int, list[int]]]) -> tuple[list[dict], list[dict]]:
        """(places, spans) of one text's stretches, in reading order."""
        places, chains, spans = [], {}, []
        automaton = self.automaton

        def close(template: int) -> None:
            start, end, _, covered = chains.pop(template)
            share = min(covered / self.before[template][-1], 1.0)
            spans.append({"label": self.labels[template], "start": start, "end": end, "share": share})

        def link(template: int, start: int, length: int, ends: list[int]) -> None:
            """Add the match of ``length`` words from ``start`` on to the template's chain."""
            chain = chains.get(template)
            if chain and start - chain[1] - 1 > self.gap:
                close(template)
                chain = None
            weight = self.before[template]
            if chain:
                later = [e for e in ends if e > chain[2]]
                if later:
                    end, last = start + length - 1, chain[2]
                    e = later[0]
                    chains[template] = (chain[0], end, e, chain[3] + weight[e + 1] - weight[max(e - length, last) + 1])
                    return
                if ends[0] - length + 1 > 0:
                    return  # a repeated part of the template inside its span
                close(template)
            e = ends[0]
            chains[template] = (start, start + length - 1, e, weight[e + 1] - weight[e + 1 - length])

        for first, stretch in stretches:
            statistics = list(automaton.statistics(stretch))
            for i, (state, length) in enumerate(statistics):
                for number in automaton.finished[state]:
                    size = len(self.sequences[number])
                    if number < self.phrases and size <= length:
                        places.append({"label": self.labels[number], "start": first + i + 1 - size})
                longer = i + 1 < len(statistics) and statistics[i + 1][1] == length + 1
                if length >= self.seed and not longer:
                    by_template = defaultdict(list)
                    for number, e in automaton.ends[state]:
                        if number >= self.phrases:
                            by_template[number].append(e)
                    for number, ends in by_template.items():
                        link(number, first + i + 1 - length, length, ends)
        for template in list(chains):
            close(template)
        return places, spans


def license_scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    seed: int = SEED,
    gap: int = GAP,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """Key, ``n_words``, ``places`` (label, start) of the base phrases in reading order, and ``spans``
    (label, first word, last word, share of the template covered) of at least ``min_share``, by start."""
    kind = dict(docs.dtypes)[key]
    scanner = Scanner(templates, phrases, seed, gap)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in slices(batch.column(1), lower=True, space=BREAK):
                rows = defaultdict(list)
                for row, first, stretch in scanner.stretches(texts):
                    rows[row].append((first, stretch))
                places: list[list] = [[] for _ in range(texts.rows)]
                spans: list[list] = [[] for _ in range(texts.rows)]
                for row, stretches in rows.items():
                    places[row], found = scanner.scan(stretches)
                    places[row].sort(key=lambda p: (p["start"], p["label"]))
                    kept = [s for s in found if s["share"] >= min_share]
                    spans[row] = sorted(kept, key=lambda s: (s["start"], s["end"], s["label"]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high], pa.array(np.diff(texts.first).astype(np.int64)),
                        pa.array(places, pa.list_(PLACE)), pa.array(spans, pa.list_(SPAN)),
                    ],
                    [key, "n_words", "places", "spans"],
                )

    return docs.select(F.col(key), F.col(text).cast("binary")).mapInArrow(
        find,
        f"`{key}` {kind}, n_words long, places array<struct<label:string,start:long>>,"
        " spans array<struct<label:string,start:long,end:long,share:double>>",
    )


def label_digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Key, n_words, the base phrases' places and labels, all labels, and a score from 0 to 1: the
    largest share of a template that a span covers, ``PHRASE_SCORE`` for base phrases alone."""
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    base, more = F.col("places.label"), F.col("spans.label")
    return found.select(
        F.col(key),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, more)).alias("labels"),
        F.greatest(
            F.when(F.size("places") > 0, F.lit(PHRASE_SCORE)).otherwise(F.lit(0.0)),
            F.coalesce(F.array_max("spans.share"), F.lit(0.0)),
        ).alias("score"),
    )
