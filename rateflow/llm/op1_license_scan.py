"""Licence scan: Dice coefficient over word bigrams against licence templates.

Every window of a text's words is a candidate, so a licence may run over lines
and paragraphs or stand inside one with other words; the whole text and each of its
lines and paragraphs are looked at too. A candidate is
normalised (lower case; words of letters, digits and inner dots; copyright lines
dropped) and compared with the templates whose size allows the threshold: with
a bigrams in the candidate and t in the template, Dice = 2 x common / (a + t)
cannot reach d unless d/(2 - d) <= a/t <= (2 - d)/d, so other templates are
not looked at. Within those bounds a match holds more than d/(2 - d) of the
template's bigrams; so a text without any word of a chosen set that covers the
other 1 - d/(2 - d) of them (``Templates.keywords``) needs no comparison.

Per document, for each licence found: the best coefficient and where (number of the first line, 0 for the
whole text). Null and empty texts have no licence. Ties go to the first
template by name.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rateflow.llm.common import arrow_ids, id_and_text, null_ids_back, read, ship, text_strings

THRESHOLD = 0.8

# Notices and short texts of public licences.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "MIT text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MIT line": "Released under the MIT License.",
    "ISC text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "GPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0 line": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL line": "This library is licensed under the GNU Lesser General Public License.",
    "AGPL-3.0 line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "BSD-3-Clause line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0 line": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0 notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense notice": "This is free and unencumbered software released into the public domain.",
}

_COPYRIGHT = re.compile(r"(?im)^[ \t]*(?:copyright\b|\(c\)|©).*$")
_WORD = re.compile(r"[a-z0-9]+(?:\.[a-z0-9]+)*")


def bigrams(text: str) -> frozenset[tuple[str, str]]:
    """The distinct word bigrams of a normalised text."""
    words = _WORD.findall(_COPYRIGHT.sub("", text).lower())
    return frozenset(zip(words, words[1:]))


@dataclass(frozen=True)
class Templates:
    """Templates with their bigrams, the licences that hold each bigram, and the sizes that can match."""

    names: list[str]
    sets: list[frozenset[tuple[str, str]]]
    sizes: list[int]
    holders: dict[tuple[str, str], list[int]]
    threshold: float

    @classmethod
    def of(cls, texts: dict[str, str], threshold: float) -> Templates:
        names = sorted(texts)
        sets = [bigrams(texts[n]) for n in names]
        holders: dict[tuple[str, str], list[int]] = {}
        for i, s in enumerate(sets):
            for b in s:
                holders.setdefault(b, []).append(i)
        return cls(names, sets, [len(s) for s in sets], holders, threshold)

    def bounds(self, i: int) -> tuple[float, float]:
        ratio = (2 - self.threshold) / self.threshold
        return self.sizes[i] / ratio, self.sizes[i] * ratio

    def fits(self, size: int) -> list[int]:
        """Templates that a candidate of ``size`` bigrams can match at the threshold."""
        return [i for i in range(len(self.names)) if self.bounds(i)[0] <= size <= self.bounds(i)[1]]

    def keywords(self) -> list[str]:
        """Words of which any matching candidate holds one.

        A match shares d/(2 - d) of a template's bigrams at least; the words
        chosen for it, longest first, touch more bigrams than may be missing.
        """
        share = self.threshold / (2 - self.threshold)
        chosen: set[str] = set()
        for i, size in enumerate(self.sizes):
            own = {b for b, holders in self.holders.items() if i in holders}
            for word in sorted({w for b in own for w in b}, key=lambda w: (w not in chosen, -len(w), w)):
                if len(own) < share * size - 1e-9:
                    break
                own = {b for b in own if word not in b}
                chosen.add(word)
        return sorted(w for w in chosen if not any(v != w and v in w for v in chosen))

    def matches(self, candidate: frozenset) -> list[tuple[int, float]]:
        """(template, Dice) of those that reach the threshold."""
        fit = set(self.fits(len(candidate)))
        common: dict[int, int] = {}
        for b in candidate if fit else ():
            for i in self.holders.get(b, ()):
                if i in fit:
                    common[i] = common.get(i, 0) + 1
        dice = ((i, 2 * n / (len(candidate) + self.sizes[i])) for i, n in common.items())
        return [(i, d) for i, d in dice if d >= self.threshold]


def candidates(text: str) -> Iterator[tuple[int, str]]:
    """The whole text (0), its paragraphs of several lines and its lines, by first line number."""
    yield 0, text
    line = 1
    for paragraph in text.split("\n\n") if "\n" in text else ():
        lines = paragraph.split("\n")
        if len(lines) > 1:
            yield line, paragraph
        yield from ((line + k, x) for k, x in enumerate(lines) if x)
        line += len(lines) + 1


def licences(text: str, templates: Templates, keywords: list[str]) -> list[tuple[str, float, int]]:
    """(licence, best Dice, line) of each licence found, by name."""
    best: dict[int, tuple[float, int]] = {}
    if not any(map(text.lower().__contains__, keywords)):
        return []
    for line, piece in candidates(text):
        if not any(map(piece.lower().__contains__, keywords)):
            continue
        for i, dice in templates.matches(bigrams(piece)):
            if i not in best or (-dice, line) < (-best[i][0], best[i][1]):
                best[i] = (dice, line)
    return [(templates.names[i], *best[i]) for i in sorted(best)]


def best_windows(pairs: list[tuple[str, str]], own: frozenset[tuple[str, str]], threshold: float) -> list[tuple[float, int, int]]:
    """(Dice, start, end) of the best window from each start among a text's bigrams, the shortest of equal ones, at the threshold or above."""
    share = threshold / (2 - threshold)
    least, most = share * len(own) - 1e-9, len(own) / share + 1e-9
    hits = [k for k, b in enumerate(pairs) if b in own]
    again: dict[int, int] = {}  # where the bigram of a hit comes next
    later: dict[tuple[str, str], int] = {}
    for k in reversed(hits):
        again[k] = later.get(pairs[k], len(pairs))
        later[pairs[k]] = k
    found = []
    held: dict[tuple[str, str], int] = {}
    common = at = end = 0
    for start in hits:
        while at < min(start, end):
            b = pairs[at]
            held[b] -= 1
            if not held[b]:
                del held[b]
                common -= b in own
            at += 1
        at, end = start, max(start, end)
        while end < len(pairs) and (pairs[end] in held or len(held) + 1 <= most):
            b = pairs[end]
            if b not in held:
                held[b] = 0
                common += b in own
            held[b] += 1
            end += 1
        if common < least:
            continue
        seen: set[tuple[str, str]] = set()
        shared, best = 0, (0.0, start, start)
        for k in range(start, min(end, again[start])):
            b = pairs[k]
            if b in seen:
                continue
            seen.add(b)
            if b in own:
                shared += 1
                dice = 2 * shared / (len(seen) + len(own))
                if dice > best[0]:
                    best = (dice, start, k + 1)
        if best[0] >= threshold:
            found.append(best)
    return found


def licences_anywhere(text: str, templates: Templates, keywords: list[str]) -> list[tuple[str, float, int]]:
    """As ``licences``, over every window of the text's words too."""
    if not any(map(text.lower().__contains__, keywords)):
        return []
    best = {name: (dice, line) for name, dice, line in licences(text, templates, keywords)}
    plain = _COPYRIGHT.sub("", text)
    share = templates.threshold / (2 - templates.threshold)
    for body in {plain: 0, text: 0}:
        words = _WORD.findall(body.lower())
        pairs = list(zip(words, words[1:]))
        known = templates.holders.keys() & set(pairs)
        common = Counter(i for b in known for i in templates.holders[b])
        reach = [i for i, n in common.items() if n >= share * templates.sizes[i] - 1e-9]
        found = sorted((-dice, -templates.sizes[i], start, end, i) for i in reach for dice, start, end in best_windows(pairs, templates.sets[i], templates.threshold))
        starts: list[int] = []  # of windows that matched, none inside another: their ends are in order too
        ends: list[int] = []
        matched: set[int] = set()
        for dice, _, start, end, i in found:
            k = bisect_right(starts, start)
            if k and ends[k - 1] >= end:
                continue
            if i not in matched and -dice > best.get(templates.names[i], (0.0, 0))[0]:
                lower = body.lower()
                first = next(islice(_WORD.finditer(lower), start, None)).start()
                best[templates.names[i]] = (-dice, lower.count("\n", 0, first) + 1)
            matched.add(i)
            lo, hi = bisect_left(starts, start), bisect_right(ends, end)
            starts[lo : max(lo, hi)], ends[lo : max(lo, hi)] = [start], [end]
    return [(name, *best[name]) for name in sorted(best)]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the best licence, its coefficient and line, and all licences found."""
    ship(docs.sparkSession)
    known = Templates.of(TEMPLATES if templates is None else templates, threshold)
    keywords = known.keywords()

    def run(batches):
        for batch in batches:
            ids = arrow_ids(batch.column("doc_id"))
            for lo, hi, texts in text_strings(batch):
                found = [licences_anywhere(t, known, keywords) for t in texts]
                best = [min(x, key=lambda m: (-m[1], m[0])) if x else (None, None, None) for x in found]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": null_ids_back(ids[lo:hi]), "license": pa.array([b[0] for b in best], pa.string()),
                    "dice": pa.array([b[1] for b in best], pa.float64()), "line": pa.array([b[2] for b in best], pa.int32()),
                    "licenses": pa.array([[m[0] for m in x] for x in found], pa.list_(pa.string())),
                })

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, license string, dice double, line int, licenses array<string>")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences of every whole text of ``documents``."""
    return scan(read(spark, sf_dir, "documents"))
