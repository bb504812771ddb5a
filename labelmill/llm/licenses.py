"""License scans by patience alignment of template and text.

A template covers a stretch of a text as far as its words align with it: words
unique to both sides are anchors, the longest increasing run of anchors is kept,
and the gaps between kept anchors are aligned in the same way, with equal words at
a gap's ends matched first. Coverage is the share of the template's words that
are matched.

Where to align follows from the coverage asked for: if all but a few of a
template's words must be matched, then of any one more than those few, one is.
So the template words that the text has least often, one more than may be
missed, lead to every stretch that can reach the coverage.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelmill.llm.common import pieces, text_of, texts_of
from labelmill.llm.decontaminate import words_of

COVERAGE = 0.8
#: Words a stretch may hold besides the template's, as a share of its length, on either side.
SLACK = 0.25

# Notices of public licences, as their publishers word them.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "mit-line": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "isc-permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd-conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by their first, whose seconds rise."""
    ends: list[int] = []
    tops: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, b) in enumerate(pairs):
        at = bisect_left(ends, b)
        if at == len(ends):
            ends.append(b)
            tops.append(k)
        else:
            ends[at], tops[at] = b, k
        back[k] = tops[at - 1] if at else -1
    out, k = [], tops[-1] if tops else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(left: list, right: list) -> list[tuple[int, int]]:
    """Matched places of two word lists, rising on both sides."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(left), 0, len(right))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and left[a] == right[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1] == right[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(left[a:b]), Counter(right[c:d])
        place = {w: c + k for k, w in enumerate(right[c:d]) if there[w] == 1}
        anchors = _increasing([(a + k, place[w]) for k, w in enumerate(left[a:b]) if here[w] == 1 and w in place])
        if not anchors:
            continue
        out += anchors
        for (p, q), (r, s) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)]):
            if p + 1 < r and q + 1 < s:
                todo.append((p + 1, r, q + 1, s))
    return sorted(out)


class Scanner:
    """Templates ready to be looked for."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.coverage = coverage
        self.templates = [(name, words_of(text.encode())) for name, text in sorted(templates.items())]
        self.templates = [(name, words, Counter(words)) for name, words in self.templates if words]
        self.vocabulary = {w for _, words, _ in self.templates for w in words}

    def scan(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """(template, first word, number of words, coverage) of each stretch, by template and place."""
        if not self.vocabulary.intersection(words):
            return []
        places: dict[bytes, list[int]] = {}
        for k, w in enumerate(words):
            if w in self.vocabulary:
                places.setdefault(w, []).append(k)
        found = []
        for name, template, counts in self.templates:
            needed = -int(-self.coverage * len(template) // 1)
            if sum(n for w, n in counts.items() if w in places) < needed:
                continue
            # one place of the template more than may be missed
            leads = sorted(range(len(template)), key=lambda k: (len(places.get(template[k], ())), k))[: len(template) - needed + 1]
            slack = int(SLACK * len(template)) + 1
            windows = sorted({(max(0, p - k - slack), p + len(template) - k + slack, p) for k in leads for p in places.get(template[k], ())})
            best: list[tuple[int, int, int]] = []
            for first, last, _ in windows:
                stretch = words[first:last]
                if sum((Counter(w for w in stretch if w in counts) & counts).values()) < needed:
                    continue
                matched = align(template, stretch)
                if len(matched) >= needed:
                    begin, end = first + matched[0][1], first + matched[-1][1] + 1
                    best.append((-len(matched), begin, end))
            taken: list[tuple[int, int]] = []
            for score, begin, end in sorted(set(best), key=lambda x: (x[0], x[2] - x[1], x[1])):
                if all(end <= a or begin >= b for a, b in taken):
                    taken.append((begin, end))
                    found.append((name, begin, end - begin, -score / len(template)))
        return sorted(found)


SPANS = "array<struct<template:string,first:bigint,words:bigint,coverage:double>>"


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, id_column: str = "doc_id", text_column: str = "text", coverage: float = COVERAGE,
) -> DataFrame:
    """A row per row of ``docs``: id, n_words, spans (template, first word, number of words, coverage).

    Words are runs of letters, digits and signs beyond ASCII, ASCII capitals made
    small. Of overlapping stretches of one template the one with more matched
    words counts, then the shorter, then the first; different templates may
    overlap. Null and empty texts have no words and no spans. Repeated rows are
    one row each, a null id stays null, other columns are not read; an empty table
    stays empty. The templates (default: TEMPLATES) are a parameter of bounded size.
    """
    given = dict(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(given, coverage)
        kind = pa.list_(pa.struct([("template", pa.string()), ("first", pa.int64()), ("words", pa.int64()), ("coverage", pa.float64())]))
        for whole in batches:
            for batch in pieces(whole):
                split = [words_of(t) for t in texts_of(batch)]
                spans = [[dict(zip(("template", "first", "words", "coverage"), s)) for s in scanner.scan(w)] for w in split]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array([len(w) for w in split], pa.int64()), pa.array(spans, kind)], names=["id", "n_words", "spans"]
                )

    read = docs.select(F.col(id_column).cast("long").alias("id"), text_of(text_column).alias("text"))
    return read.mapInArrow(run, f"id long, n_words long, spans {SPANS}").withColumnRenamed("id", id_column)
