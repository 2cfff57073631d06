"""License scans: winnowed fingerprints find candidates, banded alignment measures them.

Texts and templates are sequences of lower-cased words.  Of every ``WINNOW``
consecutive runs of ``GRAM`` template words the one with the least hash goes
into the inverted index, so any GRAM + WINNOW - 1 words that a text shares with
a template meet an entry.  The index is as large as the templates, a parameter,
and goes to the tasks with the function.

Hits of one template that go on from each other on neighbouring diagonals are
one candidate.  From its first hit the alignment with the template is extended
to both sides within a band around the hit's diagonal (matching words count
one, gaps cost a little); if the matched words cover enough of the template and
have the numbers and words that tell it from its siblings, the match is reported with its coverage and its span in the text.  Of matches
that overlap, the one with the most words stands.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM, WINNOW = 3, 3
#: Words that an alignment may stray from its candidate's diagonals.
BAND = 8
#: Least share of a template's words that a match covers.
COVERAGE = 0.8
GAP = 0.25
WORD = re.compile(r"[^\W_]+")
#: Characters of a text scanned at a time, and by how many two parts overlap.
PART, OVERLAP = 1 << 20, 1 << 15

#: Parts of the BSD licenses, which differ in the clauses between the first and the last.
BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.")
BSD_THIRD = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission.")
BSD_ADVERTISING = (
    " All advertising materials mentioning features or use of this software must display the following "
    "acknowledgement: This product includes software developed by the organization.")
BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE.")


def gnu(thing: str, name: str, version: str) -> str:
    """The usual header of a GNU license."""
    return (f"This {thing} is free software; you can redistribute it and/or modify it under the terms of the GNU "
            f"{name} Public License as published by the Free Software Foundation; either version {version} of the "
            "License, or (at your option) any later version.")


#: Words that tell a license from its nearest siblings, as all numbers do: a
#: match has every one that the template has.
TELLING = frozenset("advertising affero endorse lesser nc nd neither noderivatives noncommercial sa sharealike".split())

#: Short notices and the usual headers of public licenses.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "AGPL-3.0": (
        gnu("program", "Affero General", "3"),),
    "BSD-2-Clause": (
        BSD_HEAD,
        "Licensed under the BSD 2-Clause License.",
        BSD_HEAD + BSD_DISCLAIMER),
    "BSD-3-Clause": (
        BSD_HEAD + BSD_THIRD,
        "Licensed under the BSD 3-Clause License.",
        BSD_HEAD + BSD_THIRD + BSD_DISCLAIMER),
    "BSD-4-Clause": (
        BSD_HEAD + BSD_ADVERTISING + BSD_THIRD,
        BSD_HEAD + BSD_ADVERTISING + BSD_THIRD + BSD_DISCLAIMER),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0."),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0."),
    "CC-BY-NC-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0."),
    "CC-BY-ND-4.0": (
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Licensed under CC BY-ND 4.0."),
    "CC-BY-NC-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International "
        "License.",
        "Licensed under CC BY-NC-SA 4.0."),
    "CC-BY-NC-ND-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International "
        "License.",
        "Licensed under CC BY-NC-ND 4.0."),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        gnu("program", "General", "2")),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "LGPL-2.0": (
        gnu("library", "Library General", "2"),),
    "LGPL-2.1": (
        gnu("library", "Lesser General", "2.1"),),
    "LGPL-3.0": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation; either version 3 of the "
        "License, or (at your option) any later version.",),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",),
}


@dataclass(frozen=True)
class Match:
    license: str
    coverage: float
    start: int
    end: int
    words: int


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def grams(words: list[str]) -> Iterator[tuple[str, ...]]:
    return zip(*(words[k:] for k in range(GRAM)))


def winnowed(words: list[str]) -> list[tuple[int, tuple[str, ...]]]:
    """(place, run) of the runs with the least hash of any WINNOW in a row, rightmost of equals."""
    runs = list(grams(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(r)) for r in runs]
    chosen = set()
    for k in range(max(1, len(runs) - WINNOW + 1) if runs else 0):
        window = range(k, min(k + WINNOW, len(runs)))
        chosen.add(min(window, key=lambda i: (hashes[i], -i)))
    return [(i, runs[i]) for i in sorted(chosen)]


class Scanner:
    """The templates' inverted index and the scan of one text."""

    def __init__(self, templates: dict[str, tuple[str, ...]], coverage: float = COVERAGE) -> None:
        self.templates = [(name, words_of(text)) for name in sorted(templates) for text in templates[name]]
        self.coverage = coverage
        self.telling = [{w for w in words if w in TELLING or w.isdigit()} for _, words in self.templates]
        self.index: dict[tuple[str, ...], list[tuple[int, int]]] = defaultdict(list)
        for k, (_, words) in enumerate(self.templates):
            for place, run in winnowed(words):
                self.index[run].append((k, place))

    def scan(self, text: str) -> list[Match]:
        """All matches in a whole text, in order; long texts part by part."""
        found: list[Match] = []
        start = 0
        while True:
            found += self._part(text[start:start + PART], start)
            if start + PART >= len(text):
                break
            start += PART - OVERLAP
        best: list[Match] = []
        for m in sorted(set(found), key=lambda m: (-m.words, -m.coverage, m.start, m.license)):
            # of matches that overlap, the one with the most words stands
            if not any(b.start < m.end and m.start < b.end for b in best):
                best.append(m)
        return sorted(best, key=lambda m: m.start)

    def _part(self, text: str, base: int) -> list[Match]:
        if self.index.keys().isdisjoint(grams(words_of(text))):
            return []
        # lower-casing one character at a time keeps places in the text
        places = [(m.start(), m.end()) for m in WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in places]
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for at, run in enumerate(grams(words)):
            for k, place in self.index.get(run, ()):
                hits[k].append((at, at - place))
        return [m for k in sorted(hits) for m in self._aligned(k, hits[k], words, places, base)]

    def _aligned(self, k: int, hits: list[tuple[int, int]], words: list[str],
                 places: list[tuple[int, int]], base: int) -> Iterator[Match]:
        name, template = self.templates[k]
        groups: list[list[tuple[int, int]]] = []
        for at, diagonal in sorted(hits):
            # a place in the template that does not go on from the last one begins another copy
            last = groups[-1][-1] if groups else None
            if last and abs(diagonal - last[1]) <= BAND and at - diagonal > last[0] - last[1]:
                groups[-1].append((at, diagonal))
            else:
                groups.append([(at, diagonal)])
        for group in groups:
            at, diagonal = group[0]
            place = at - diagonal
            reach = len(template) + BAND
            before = pairs(template[:place][::-1], words[max(0, at - reach):at][::-1])
            after = pairs(template[place + GRAM:], words[at + GRAM:at + GRAM + reach])
            n = len(before) + GRAM + len(after)
            met = {*template[place:place + GRAM], *(template[place - 1 - i] for i, _ in before),
                   *(template[place + GRAM + i] for i, _ in after)}
            if n >= self.coverage * len(template) and self.telling[k] <= met:
                first = at - 1 - before[-1][1] if before else at
                last = at + GRAM + after[-1][1] if after else at + GRAM - 1
                yield Match(name, n / len(template), base + places[first][0], base + places[last][1], n)


def extension(template: list[str], words: list[str], band: int = BAND) -> list[int]:
    """Places of the words of ``pairs``."""
    return [j for _, j in pairs(template, words, band)]


def pairs(template: list[str], words: list[str], band: int = BAND) -> list[tuple[int, int]]:
    """Words (template, text) matched by the best alignment that goes on from a hit, within a band around it.

    A match counts 1, a word left out or exchanged costs GAP; the alignment
    ends where its score is highest.
    """
    out = float("-inf")
    width = 2 * band + 1
    score = [[out] * (width + 2) for _ in range(len(template) + 1)]
    step = [[0] * (width + 2) for _ in range(len(template) + 1)]
    best, where = 0.0, None
    for i in range(len(template) + 1):
        row, above = score[i], score[i - 1] if i else None
        for c in range(1, width + 1):
            j = i + c - band - 1            # words of the text used up
            if j < 0 or j > len(words):
                continue
            value, move = (0.0, 0) if i == j == 0 else (out, 0)
            if i and j and above[c] > out:
                same = template[i - 1] == words[j - 1]
                value, move = above[c] + (1 if same else -GAP), 1 if same else 2
            if i and above[c + 1] - GAP > value:
                value, move = above[c + 1] - GAP, 3
            if row[c - 1] - GAP > value:
                value, move = row[c - 1] - GAP, 4
            row[c], step[i][c] = value, move
            if value > best:
                best, where = value, (i, c)
    matched = []
    while where:
        i, c = where
        move = step[i][c]
        if move == 1:
            matched.append((i - 1, i + c - band - 2))
        where = {1: (i - 1, c), 2: (i - 1, c), 3: (i - 1, c + 1), 4: (i, c - 1)}.get(move)
    return matched[::-1]


def scanned(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, doc_id: str = "doc_id",
            text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """One row per match: (doc_id, license, coverage, start, end, n_words).

    ``start`` and ``end`` are code points of the whole text.  NULL and empty
    texts have no match; repeated rows repeat their matches; an empty table
    gives an empty table.
    """
    own = templates or TEMPLATES
    names = ["doc_id", "license", "coverage", "start", "end", "n_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(own, coverage)
        for batch in batches:
            rows = [(row, m) for row, value in enumerate(batch.column(1))
                    for m in scanner.scan(value.as_py() or "")]
            at = pa.array([row for row, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array([m.license for _, m in rows], pa.string()),
                 pa.array([m.coverage for _, m in rows], pa.float64()),
                 pa.array([m.start for _, m in rows], pa.int64()),
                 pa.array([m.end for _, m in rows], pa.int64()),
                 pa.array([m.words for _, m in rows], pa.int64())], names)

    return docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
                       F.col(f"`{text}`").alias("text")).mapInArrow(
        run, "doc_id bigint, license string, coverage double, start bigint, end bigint, n_words bigint")
