"""Licence scan: matching statistics of a generalised suffix automaton, chained into spans.

Words are runs of ASCII letters and digits and of all other characters beyond ASCII, with
A-Z in lower case. The automaton holds the words of all templates and base phrases. A file is
streamed through it word by word; at each word the automaton knows the longest stretch that
ends there and occurs in some template. From these statistics come

* base places: a base phrase stands where it is a suffix of the stretch;
* long matches: stretches of at least `least_words` words that the next word does not extend.
  For each template, those whose template places advance with their places in the file, with
  gaps of at most `gap_words`, are chained; a chain that covers at least `coverage` of the
  template's words is a span and labels the file.

Null and empty texts have no words and no labels (empty strings, score 0). The score is the
largest covered share of any template, and 1 where a base phrase stands. Texts are read
whole, in memory that one text bounds; repeated rows are labelled alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import in_batches

# The base phrases and their labels.
BASE_PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"),
                ("cc by nc", "cc-by-nc"))

# Passages of well-known public licences and notices.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software "
     "without restriction, including without limitation the rights to use, copy, modify, merge, "
     "publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
     "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
     "PURPOSE AND NONINFRINGEMENT"),
    ("mit", "This software is released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
     "this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2", "Unless required by applicable law or agreed to in writing, software distributed "
     "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF "
     "ANY KIND, either express or implied"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation; either "
     "version 2 of the License, or (at your option) any later version"),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the "
     "terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met"),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
     "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
     "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
     "or without fee is hereby granted, provided that the above copyright notice and this "
     "permission notice appear in all copies"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
     "If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
     "International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
     "International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
)

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


class SuffixAutomaton:
    """All stretches of several word sequences; states know where the stretches end."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]     # (sequence, place after the stretch)
        for which, sequence in enumerate(sequences):
            last = 0
            for place, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].add((which, place + 1))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                self.ends[self.link[state]] |= self.ends[state]

    def _new(self, length: int, after: dict[int, int], link: int) -> int:
        self.next.append(dict(after))
        self.length.append(length)
        self.link.append(link)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, state: int, below: int, word: int) -> int:
        """A state for the stretches of `below` that are one word longer than `state`."""
        copy = self._new(self.length[state] + 1, self.next[below], self.link[below])
        self.link[below] = copy
        while state >= 0 and self.next[state].get(word) == below:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if (known := self.next[last].get(word)) is not None:  # a stretch of an earlier sequence
            exact = self.length[known] == self.length[last] + 1
            return known if exact else self._split(last, known, word)
        new, state = self._new(self.length[last] + 1, {}, 0), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            below = self.next[state][word]
            exact = self.length[below] == self.length[state] + 1
            self.link[new] = below if exact else self._split(state, below, word)
        return new


@dataclass
class Scan:
    """What a text holds: base places, spans as (label, template, first word, end, share)."""

    n_words: int = 0
    base: list[tuple[int, str]] = field(default_factory=list)
    spans: list[tuple[str, int, int, int, float]] = field(default_factory=list)


class LicenseScanner:
    def __init__(self, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]],
                 least_words: int, gap_words: int, coverage: float):
        self.labels = [label for label, _ in templates]
        self.least, self.gap, self.coverage = least_words, gap_words, coverage
        split = [words(text.encode()) for _, text in templates]
        bases = [words(text.encode()) for text, _ in phrases]
        self.sizes = list(map(len, split))
        self.known = {w: i for i, w in enumerate(dict.fromkeys(w for s in split + bases for w in s), 1)}
        self.automaton = SuffixAutomaton([[self.known[w] for w in s] for s in split + bases])
        whole = ({(i, n): (n, None, i) for i, n in enumerate(self.sizes)}
                 | {(len(split) + i, len(b)): (len(b), phrases[i][1], -1) for i, b in enumerate(bases)})
        # Templates and base phrases that are suffixes of a state's longest stretch, by their end
        # places: also what stands inside a longer template.
        self.whole = [[] for _ in self.automaton.next]
        for state in sorted(range(1, len(self.whole)), key=lambda s: self.automaton.length[s]):
            own = [v for e in self.automaton.ends[state] if (v := whole.get(e))
                   and self.automaton.length[self.automaton.link[state]] < v[0]
                   <= self.automaton.length[state]]
            self.whole[state] = own + self.whole[self.automaton.link[state]]
        self.shortest = min([least_words, *self.sizes, *map(len, bases)])

    def scan(self, text: bytes | None) -> Scan:
        found = words(text)
        out = Scan(len(found))
        ids = np.fromiter(map(self.known.get, found, [0] * len(found)), np.int64, len(found))
        # Only runs of template words can hold a match.
        edges = np.flatnonzero(np.diff(np.concatenate([[0], ids > 0, [0]])))
        matches: list[tuple[int, int, int]] = []
        templates: list[tuple[int, int]] = []
        for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()):
            if b - a >= self.shortest:
                self._walk(ids[a:b].tolist(), a, out, matches, templates)
        if matches or templates:
            # Where spans of different templates overlap, the one that covers most words stays.
            for _, _, span in sorted(self._chained(matches, templates)):
                if all(span[3] <= kept[2] or kept[3] <= span[2] for kept in out.spans):
                    out.spans.append(span)
            out.spans.sort(key=lambda span: span[2])
        return out

    def _walk(self, run: list[int], first: int, out: Scan, matches: list, templates: list) -> None:
        """Matching statistics of one run, which begins at the word `first`; (template, first
        word) of whole templates."""
        after, link, length = self.automaton.next, self.automaton.link, self.automaton.length
        state = size = 0
        for place, word in enumerate(run, first):
            extended = word in after[state]
            if not extended and size >= self.least:
                matches.append((place, size, state))
            while state and word not in after[state]:
                state = link[state]
                size = length[state]
            if word in after[state]:
                state, size = after[state][word], size + 1
            else:
                state = size = 0
            for n, label, template in self.whole[state]:
                if n <= size:
                    if template >= 0:
                        templates.append((template, place + 1 - n))
                    else:
                        out.base.append((place + 1 - n, label))
        if size >= self.least:
            matches.append((first + len(run), size, state))

    def _chained(self, matches: list[tuple[int, int, int]], templates: list[tuple[int, int]]
                 ) -> Iterator[tuple[int, int, tuple[str, int, int, int, float]]]:
        """(minus covered words, words spanned, span): per template, its chains of matches, in
        order in text and template, that cover enough of it."""
        by_template: dict[int, set[tuple[int, int, int]]] = {}
        for template, begin in templates:
            by_template.setdefault(template, set()).add((begin, 0, self.sizes[template]))
        for end, size, state in matches:
            for template, place in self.automaton.ends[state]:
                if template < len(self.labels) and place >= size:
                    by_template.setdefault(template, set()).add((end - size, place - size, size))
        for template, pieces in by_template.items():
            open_chains: list[list] = []                   # file end, template end, covered, begin
            done = []
            for begin, place, size in sorted(pieces):
                best = None
                for chain in open_chains:
                    overlap = max(0, chain[0] - begin, chain[1] - place)
                    if (begin + size > chain[0] and place + size > chain[1]
                            and begin - chain[0] <= self.gap and overlap < size
                            and (best is None or chain[2] - overlap > best[1][2] - best[0])):
                        best = (overlap, chain)
                new = ([begin + size, place + size, best[1][2] + size - best[0], best[1][3]] if best
                       else [begin + size, place + size, size, begin])
                open_chains = [c for c in open_chains if begin - c[0] <= self.gap] + [new]
                done.append(new)
            enough = [c for c in done if c[2] >= self.coverage * self.sizes[template]]
            last = -1
            for end, _, covered, begin in sorted(enough, key=lambda c: (c[3], -c[2], c[0])):
                if begin >= last:
                    last = end
                    yield (-covered, end - begin, (self.labels[template], template, begin, end,
                                                   min(1.0, covered / self.sizes[template])))


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
         templates: Sequence[tuple[str, str]] = TEMPLATES,
         phrases: Sequence[tuple[str, str]] = BASE_PHRASES, least_words: int = 4,
         gap_words: int = 12, coverage: float = 0.75) -> DataFrame:
    """(id, n_words, base, spans) per row.

    `base` holds (start, label) of each place of a base phrase; `spans` (label, template,
    first, end, share), places being words from 0.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    held: list[LicenseScanner] = []

    def scanned(batches):
        if not held:
            held.append(LicenseScanner(templates, phrases, least_words, gap_words, coverage))
        for batch in batches:
            found = [held[0].scan(t.as_py()) for t in batch.column("text")]
            base = [[{"start": a, "label": b} for a, b in f.base] for f in found]
            spans = [[dict(zip(("label", "template", "first", "end", "share"), s)) for s in f.spans]
                     for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([f.n_words for f in found], pa.int64()),
                 pa.array(base, _BASE), pa.array(spans, _SPANS)], ["id", "n_words", "base", "spans"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return (in_batches(texts, scanned, f"id {kind}, n_words long, "
                       "base array<struct<start:bigint,label:string>>, spans array<struct<"
                       "label:string,template:bigint,first:bigint,end:bigint,share:double>>")
            .withColumnRenamed("id", id_col))


_BASE = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
_SPANS = pa.list_(pa.struct([("label", pa.string()), ("template", pa.int64()),
                             ("first", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]))


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One line per row of a scan: counts, first and last base place, labels and score."""
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    base = F.col("base.label")
    return found.select(
        id_col, "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"), F.array_max("base.start").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.col("spans.label"))).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(
            F.coalesce(F.array_max("spans.share"), F.lit(0.0))).alias("score"))
