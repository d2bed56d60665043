"""Licence texts and notices in documents, by patience alignment.

Words that occur once in the text and once in a template are its anchors; the longest run of anchors that rises in
both is kept, and the gaps between them are aligned in the same way, in which further words are unique. Coverage is
the share of the template's words that are aligned. Where a stretch may hold several copies, so that words are not
unique, the copies are told apart first.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame

from furrow.llm.tables import documents, values

# Notices and licence texts as they are published.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0",
    "all-rights-reserved": "All rights reserved",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met"
    ),
    "Apache-2.0": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
        " CONDITIONS OF ANY KIND, either express or implied"
    ),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/"
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain",
}

LEAST_COVERAGE = 0.9
GAP = 10  # words without template words that end a passage
WORD = re.compile(r"[^\W_]+")
RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("license", pa.string()),
        ("coverage", pa.float64()),
        ("n_matched", pa.int64()),
        ("start", pa.int64()),
        ("end", pa.int64()),
    ]
)
RESULT_SCHEMA = "doc_id long, license string, coverage double, n_matched long, start long, end long"


def longest_rise(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, sorted by their first value, whose second values rise: by patience sorting."""
    tops: list[int] = []
    top_at: list[int] = []
    before: list[int | None] = []
    for i, (_, value) in enumerate(pairs):
        pile = bisect_left(tops, value)
        before.append(top_at[pile - 1] if pile else None)
        if pile == len(tops):
            tops.append(value)
            top_at.append(i)
        else:
            tops[pile], top_at[pile] = value, i
    out, at = [], top_at[-1] if top_at else None
    while at is not None:
        out.append(pairs[at])
        at = before[at]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Aligned positions ``(in text, in template)``, rising in both."""
    out, todo = [], [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:  # what a gap has in common at its ends is aligned first
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            out.append((b - 1, d - 1))
            b, d = b - 1, d - 1
        if a == b or c == d:
            continue
        counts, place = Counter(template[c:d]), {w: c + i for i, w in enumerate(template[c:d])}
        here = Counter(w for w in text[a:b] if w in place)
        anchors = [(a + i, place[w]) for i, w in enumerate(text[a:b]) if here[w] == 1 and counts[w] == 1]
        anchors = longest_rise(anchors)
        out.extend(anchors)
        if anchors:
            ends = [(a - 1, c - 1), *anchors, (b, d)]
            todo.extend((i + 1, j, k + 1, m) for (i, k), (j, m) in zip(ends, ends[1:]))
    return sorted(out)


@dataclass
class Template:
    """Words of one licence text and what a text must hold to cover enough of them."""

    name: str
    words: list[str]
    least: int
    keys: list[bytes]


def prepare(texts: dict[str, str], coverage: float) -> list[Template]:
    """A text without any of a template's ``keys`` lacks too many of its words."""
    out = []
    for name, text in texts.items():
        words = WORD.findall(text.lower())
        least = ceil(coverage * len(words) - 1e-9)
        distinct = sorted(set(words), key=lambda w: (-len(w), w))
        out.append(Template(name, words, least, [w.encode("utf-8") for w in distinct[: len(words) - least + 1]]))
    return out


def passages(words: list[str], template: Template) -> Iterator[tuple[int, int]]:
    """Stretches of the text dense in template words and with enough of them."""
    wanted, start, last, n = set(template.words), 0, None, 0
    for i, word in enumerate(words):
        if word in wanted:
            if last is None or i - last > GAP:
                if n >= template.least:
                    yield start, last + 1
                start, n = i, 0
            last, n = i, n + 1
    if n >= template.least:
        yield start, last + 1


def common(text: Iterable[str], places: dict[str, int], size: int) -> Iterator[int]:
    """Longest common subsequence of a template and the first words of the text, after each word.

    ``places`` has a bit per position of the template; a position that the subsequence has used up is a zero of ``row``.
    """
    row = full = (1 << size) - 1
    for word in text:
        hit = row & places.get(word, 0)
        row = ((row + hit) | (row - hit)) & full
        yield size - row.bit_count()


def locate(words: list[str], template: Template) -> list[tuple[int, int]]:
    """Disjoint spans of at most twice the template's length that hold enough of it in order, as many as there can be.

    Always the span that ends first, and of those the shortest, is taken next. Counting words, in any order, leaves out
    nearly all places before the order is looked at.
    """
    size, places, back = len(template.words), {}, {}
    for k, word in enumerate(template.words):
        places[word] = places.get(word, 0) | 1 << k
        back[word] = back.get(word, 0) | 1 << size - 1 - k
    wanted = Counter(template.words)
    spans, at, here, n = [], 0, Counter(), 0
    for end, word in enumerate(words, 1):
        if word in wanted:
            here[word] += 1
            n += here[word] <= wanted[word]
        for gone in words[at : max(at, end - 2 * size)]:
            if gone in wanted:
                n -= here[gone] <= wanted[gone]
                here[gone] -= 1
            at += 1
        if word in wanted and n >= template.least:
            before = common(reversed(words[at:end]), back, size)
            length = next((i for i, k in enumerate(before, 1) if k >= template.least), None)
            if length is not None:
                spans.append((end - length, end))
                at, here, n = end, Counter(), 0
    out = []
    for (first, stop), (following, _) in zip(spans, [*spans[1:], (len(words), 0)]):
        # The rest of the licence follows, as far as it is not part of the next copy.
        longest = list(common(words[first : min(first + 2 * size, following)], places, size))
        out.append((first, max(stop, first + longest.index(longest[-1]) + 1)))
    return out


def matches(words: list[str], template: Template) -> list[tuple[int, int, int]]:
    """``(first word, end, aligned words)`` of every passage that covers enough of the template.

    A stretch that can hold more than one copy, or in which too little is aligned, is searched for the spans of single
    copies, and each of them is aligned. Where repeated words leave patience too few anchors, the longest common
    subsequence counts.
    """
    size, found = len(template.words), []
    wanted, places = set(template.words), {}
    for k, word in enumerate(template.words):
        places[word] = places.get(word, 0) | 1 << k
    for start, end in passages(words, template):
        part = words[start:end]
        if sum(w in wanted for w in part) < 2 * template.least:  # no room for two
            aligned = align(part, template.words)
            if len(aligned) >= template.least and aligned[-1][0] - aligned[0][0] < 2 * size:
                found.append((start + aligned[0][0], start + aligned[-1][0] + 1, len(aligned)))
                continue
        for first, stop in locate(part, template):
            aligned = align(part[first:stop], template.words)
            n = len(aligned)
            if n < template.least:
                *_, n = common(part[first:stop], places, size)
            found.append((start + first, start + stop, n))
    return found


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    coverage: float = LEAST_COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, license, coverage, n_matched, start, end)`` of every licence passage; ``start`` and ``end`` in characters.

    Words are runs of letters and digits in lower case. A row without a passage, or with null text, gives none.
    Repeated rows give repeated results; an empty table gives an empty one; other columns take no part.
    """
    prepared = prepare(TEMPLATES if templates is None else templates, coverage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, text in zip(*map(values, batch.columns)):
                if text is not None:
                    rows.extend((name, *found) for found in licences(text, prepared))
            columns = zip(*rows) if rows else [[] for _ in RESULT]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RESULT)], schema=RESULT)

    return documents(docs, id_col, text_col).mapInArrow(run, RESULT_SCHEMA)


def licences(text: bytes, prepared: list[Template]) -> Iterator[tuple[str, float, int, int, int]]:
    """Name, coverage, aligned words and character span of the licences in one text."""
    plain = text.lower() if text.isascii() else text.decode("utf-8", "replace").lower().encode("utf-8")
    possible = [t for t in prepared if any(key in plain for key in t.keys)]
    if not possible:
        return
    # Lower case word by word, so that positions are those of the text.
    spans = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text.decode("utf-8", "replace"))]
    words = [w for w, _, _ in spans]
    for template in possible:
        for first, stop, n in matches(words, template):
            yield template.name, n / len(template.words), n, spans[first][1], spans[stop - 1][2]
