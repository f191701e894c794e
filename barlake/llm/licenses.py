"""License notices found by patience alignment against templates.

A worker maps a text to word hashes and looks for stretches that hold enough of
a template's words. Such a stretch is aligned with the template: words that occur
once in both are anchors, the longest increasing subsequence of the anchors'
places is kept, and the gaps between them are aligned the same way. The share of
the template's words that are matched, in order, is its coverage.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .decontamination import Words
from .words import utf8

MIN_COVERAGE = 0.8

# Public license notices.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
        "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License."),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution."),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details."),
    "mit": "Released under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
}


def increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence (patience piles)."""
    tops: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for k, v in enumerate(values):
        pile = bisect_left(tops, v)
        before.append(last[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            last.append(k)
        else:
            tops[pile], last[pile] = v, k
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched places (in a, in b), increasing in both: equal words at the ends of
    a stretch, unique common words between, and their gaps in turn."""
    out = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: k for k, w in enumerate(b[b0:b1], b0)}
        both = [(k, place[a[k]]) for k in range(a0, a1) if once_a[a[k]] == 1 == once_b.get(a[k])]
        anchors = [both[k] for k in increasing([j for _, j in both])]
        out += anchors
        if anchors:
            ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:])]
    return sorted(out)


class Scanner:
    """The templates as word hashes. ``find`` yields (license, coverage, start,
    stop) in words, for stretches that do not overlap per license."""

    def __init__(self, templates: Mapping[str, str], min_coverage: float):
        words = Words()
        self.least = min_coverage
        self.templates = {name: words.of(text.encode()) for name, text in templates.items()}
        self.templates = {name: w for name, w in self.templates.items() if len(w)}
        self.known = np.unique(np.concatenate([np.empty(0, np.uint64), *self.templates.values()]))

    def find(self, text: np.ndarray) -> Iterator[tuple[str, float, int, int]]:
        if not len(self.known) or not len(text):
            return
        slot = np.minimum(np.searchsorted(self.known, text), len(self.known) - 1)
        at = np.flatnonzero(self.known[slot] == text)
        for name, template in self.templates.items():
            yield from self._find(name, template, text, at[np.isin(text[at], template)])

    def _find(self, name: str, template: np.ndarray, text: np.ndarray, hits: np.ndarray) -> Iterator[tuple[str, float, int, int]]:
        """``hits``: places of the template's words. A stretch begins at a hit and
        is half as long again as the template, for inserted words."""
        need, span = max(1, int(np.ceil(self.least * len(template)))), len(template) + len(template) // 2
        if len(hits) < need:
            return
        inside = np.searchsorted(hits, hits + span) - np.arange(len(hits))
        done, goal = 0, template.tolist()
        for k in np.flatnonzero(inside >= need):
            start = int(hits[k])
            if start < done:
                continue
            pairs = aligned(text[start:start + span].tolist(), goal)
            if len(pairs) >= need and pairs[0][0] == 0:
                done = start + pairs[-1][0] + 1
                yield name, len(pairs) / len(goal), start, done


def license_scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text",
                 min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(id, license, coverage, start, stop): one row for every notice found, with
    its place in words (lower-cased, ASCII punctuation ignored).

    ``templates`` is a short list of known notices, sent along with the code.
    Defined cases: null and empty texts, and templates without words, match
    nothing; ids may be null or repeated (every row is scanned); a notice that
    occurs several times gives several rows; other columns are not looked at; an
    empty table gives an empty result."""
    templates = dict(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, scanner = Words(), Scanner(templates, min_coverage)
        for batch in batches:
            out = [(key, *hit) for key, text in zip(batch.column("id").to_pylist(), utf8(batch.column("t")))
                   for hit in scanner.find(words.of(text))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, (
                    batch.column("id").type, pa.string(), pa.float64(), pa.int64(), pa.int64()))],
                names=["id", "license", "coverage", "start", "stop"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, license string, coverage double, start long, stop long").withColumnRenamed("id", id_col)
