"""License scans by patience alignment.

A license template is aligned with a stretch of text: words that occur once
in both are anchors, the longest increasing subsequence of the anchors is
kept, and the gaps between them are aligned in the same way. Coverage is the
share of the template's words that the alignment finds. The words that tell a
template from its neighbours (a version, NonCommercial, Lesser, MIT) must be
aligned, and none of another template's may stand inside the span; short
notices have no other words inside at all. A text is first cut into stretches
that could reach the wanted coverage at all, by counting template words, which
loses no copy that spans up to twice the template's length.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Notices and short texts of well-known licenses, as their publishers word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "MIT-notice": "Released under the MIT License",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed "
        "in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies."),
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed "
        "in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "GPL-3.0-name": "GNU General Public License, version 3",
    "GPL-2.0-name": "GNU General Public License, version 2",
    "LGPL-3.0-name": "GNU Lesser General Public License, version 3",
    "LGPL-2.1-name": "GNU Lesser General Public License, version 2.1",
    "AGPL-3.0-name": "GNU Affero General Public License, version 3",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "BSD-notice": "Released under the BSD License",
    "ISC-notice": "Released under the ISC License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0",
    "CC-BY-ND-4.0-short": "Licensed under CC BY-ND 4.0",
    "CC-BY-NC-SA-4.0-short": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-NC-ND-4.0-short": "Licensed under CC BY-NC-ND 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-NC-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "CC-BY-NC-ND-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "all-rights-reserved": "All rights reserved",
}
#: Words that tell licenses apart. A template's own ones must be found, all others must not be in its span.
TELLING = frozenset(
    "1 2 3 4 5 affero apache bsd by cc cc0 gnu gpl isc lesser lgpl agpl mit mozilla mpl nc nd noderivatives noderivs noncommercial sa "
    "sharealike".split())
#: Words of further names that stand for another license where they are inside a notice.
FOREIGN = frozenset("artistic eclipse eupl library epl cddl unlicense zlib wtfpl beerware proprietary commercial".split())
#: Notices of fewer words have no other words inside.
SHORT = 8
#: Words between two aligned ones that may part a stray word from a notice.
STRAY = 2
COVERAGE = 0.8
#: Share of a stretch's words between its first and last aligned word that the template must explain.
DENSITY = 0.5

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs (i, j) with a[i] == b[j], both increasing: the patience alignment of two word lists."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        lo, hi, low, high = work.pop()
        while lo < hi and low < high and a[lo] == b[low]:
            out.append((lo, low))
            lo, low = lo + 1, low + 1
        while lo < hi and low < high and a[hi - 1] == b[high - 1]:
            hi, high = hi - 1, high - 1
            out.append((hi, high))
        if lo == hi or low == high:
            continue
        once_a, once_b = ({w for w, n in Counter(x).items() if n == 1} for x in (a[lo:hi], b[low:high]))
        both = once_a & once_b
        if not both:
            continue
        place = {b[j]: j for j in range(low, high) if b[j] in both}
        anchors = _increasing([(i, place[a[i]]) for i in range(lo, hi) if a[i] in both])
        out += anchors
        ends = [(lo - 1, low - 1), *anchors, (hi, high)]
        work += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:])]
    return sorted(out)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest subsequence that increases in the second part (the first increases already)."""
    tails: list[int] = []
    piles: list[int] = []
    before = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        before.append(piles[at - 1] if at else -1)
        if at == len(tails):
            tails.append(j)
            piles.append(k)
        else:
            tails[at], piles[at] = j, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


@dataclass(frozen=True)
class Found:
    license: str
    coverage: float
    start: int  # words
    end: int


class Scanner:
    """Templates ready to be looked for in many texts."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.coverage = coverage
        self.words = {k: words_of(t) for k, t in templates.items()}
        self.counts = {k: Counter(w) for k, w in self.words.items()}
        self.vocabulary = frozenset(w for c in self.counts.values() for w in c)
        self.need = {k: max(1, -int(-coverage * len(w) // 1)) for k, w in self.words.items()}
        # in a long text "by", "4" and the like are plain words
        self.telling = {k: TELLING & set(w) if len(w) < 2 * SHORT else (TELLING - {"by", "1", "4", "5"}) & set(w) for k, w in self.words.items()}

    def stretches(self, text: list[str], name: str) -> list[tuple[int, int]]:
        """Windows of text that hold enough template words to reach the coverage.

        A notice that spans up to twice the template's length lies whole inside
        some window: windows start every half length and are two and a half
        lengths wide. Short notices have nothing between their words.
        """
        size, own = len(self.words[name]), self.counts[name]
        hits = np.fromiter((w in own for w in text), np.int64, len(text))
        upto = np.concatenate([[0], np.cumsum(hits)])
        step = max(1, size // 2) if size >= SHORT else 1
        width = 2 * size + step if size >= SHORT else size
        starts = np.arange(0, len(text), step)
        ends = np.minimum(starts + width, len(text))
        full = upto[ends] - upto[starts] >= self.need[name]
        return list(zip(starts[full].tolist(), ends[full].tolist()))

    def holds(self, name: str, text: list[str], pairs: list[tuple[int, int]]) -> bool:
        """The alignment is that notice, and no neighbour of it."""
        if len(pairs) < self.need[name]:
            return False
        words, aligned = self.words[name], {i for i, _ in pairs}
        span = range(pairs[0][0], pairs[-1][0] + 1)
        inside = [text[i] for i in span if i not in aligned]
        if len(pairs) < DENSITY * len(span) or inside and len(words) < SHORT:
            return False
        if not self.telling[name] <= {words[j] for _, j in pairs}:
            return False
        foreign = (TELLING | FOREIGN) - set(words)
        if len(words) >= 2 * SHORT:  # other notices' short words and numbers are plain words in a long text
            foreign = foreign - {"by", "1", "2", "3", "4", "5", "commercial", "library"}
        return not any(w in foreign for w in inside)

    def aligned(self, name: str, text: list[str]) -> list[tuple[int, int]] | None:
        """The best alignment of a notice with a part of the window that holds; None without one.

        If the whole window's alignment does not hold, all parts that begin and
        end at the notice's words are tried where those are few, and stray
        words at the ends are left out where they are many.
        """
        words = self.words[name]
        if not self.telling[name] <= set(text):
            return None
        pairs = patience(text, words)
        if self.holds(name, text, pairs):
            return self._tight(name, text, pairs)
        if len(words) < 2 * SHORT:
            own = [i for i, w in enumerate(text) if w in self.counts[name]]
            best = None
            for k, a in enumerate(own):
                for b in own[k + self.need[name] - 1:]:
                    part = [(a + i, j) for i, j in patience(text[a:b + 1], words)]
                    if self.holds(name, text, part) and (best is None or (len(part), a - b) > best[0]):
                        best = (len(part), a - b), part
            return best and best[1]
        lo, hi = 0, len(text)
        while len(pairs) >= self.need[name]:
            # the gap with the fewest aligned words on one side: those stray from the notice
            gaps = [(min(k, len(pairs) - k), k) for k in range(1, len(pairs)) if pairs[k][0] - pairs[k - 1][0] > STRAY + 1]
            if not gaps:
                return None
            _, k = min(gaps)
            lo, hi = (pairs[k - 1][0] + 1, hi) if 2 * k <= len(pairs) else (lo, pairs[k][0])
            pairs = [(lo + i, j) for i, j in patience(text[lo:hi], words)]
            if self.holds(name, text, pairs):
                return self._tight(name, text, pairs)
        return None

    def _tight(self, name: str, text: list[str], pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """An alignment with as many words on one side of a gap, if there is one: words before the gap were another notice's."""
        k = 1
        while k < len(pairs):
            (left, _), (right, _) = pairs[k - 1], pairs[k]
            if right - left > STRAY + 1:
                for a, b in ((left + 1, pairs[-1][0] + 1), (pairs[0][0], right)):
                    part = [(a + i, j) for i, j in patience(text[a:b], self.words[name])]
                    if len(part) >= len(pairs) and self.holds(name, text, part):
                        pairs, k = part, 0
                        break
            k += 1
        return pairs

    def scan(self, text: list[str]) -> list[Found]:
        """Every notice found, in order.

        Where several overlap, the one with most aligned words stays (then
        coverage, then name). The words of what is found are blanked and the
        rest is scanned again, until nothing more is found, so copies of one
        notice side by side are all found.
        """
        there = Counter(w for w in text if w in self.vocabulary)
        names = [k for k, own in self.counts.items() if sum(min(n, there[w]) for w, n in own.items()) >= self.need[k]]
        out: list[Found] = []
        rest: list = list(text)
        while names:
            found = []
            for name in names:
                words = self.words[name]
                for a, b in self.stretches(rest, name):
                    pairs = self.aligned(name, rest[a:b])
                    if pairs:
                        found.append((len(pairs), Found(name, len(pairs) / len(words), a + pairs[0][0], a + pairs[-1][0] + 1)))
            found.sort(key=lambda f: (-f[0], -f[1].coverage, f[1].license, f[1].start))
            taken = np.zeros(len(text), bool)
            new = []
            for _, f in found:
                if not taken[f.start:f.end].any():
                    taken[f.start:f.end] = True
                    new.append(f)
            if not new:
                break
            out += new
            for f in new:
                rest[f.start:f.end] = [""] * (f.end - f.start)
        return sorted(out, key=lambda f: f.start)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, notices) of every document; notices has license, coverage and the span start, end in code points.

    Null and empty texts have no notices. Whole texts are scanned; a text of
    any length costs memory for its words. Repeated rows are scanned alike,
    extra columns are not read, and an empty table gives an empty one.
    """
    templates = TEMPLATES if templates is None else templates
    notice = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int32()), ("end", pa.int32())])
    schema = docs.select("doc_id", F.lit(None).cast("array<struct<license:string,coverage:double,start:int,end:int>>").alias("notices")).schema

    def run(batches):
        scanner = Scanner(templates, coverage)

        def notices(text: str) -> list[dict]:
            lower = text.lower()
            found = scanner.scan(_WORD.findall(lower))
            if not found:
                return []
            # lower-casing may change the length of a text, so spans are looked up in the text itself
            spans = [m.span() for m in _WORD.finditer(lower if len(lower) == len(text) else text)]
            return [{"license": f.license, "coverage": f.coverage, "start": spans[min(f.start, len(spans) - 1)][0],
                     "end": spans[min(f.end, len(spans)) - 1][1]} for f in found]

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([notices(t) if t else [] for t in (v.as_py() for v in batch.column(1))], pa.list_(notice))],
                                             names=["doc_id", "notices"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def summary(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, license, coverage, n_notices, licenses): the best notice of every document (nulls without one) and all names in order."""
    best = F.expr("array_max(transform(notices, n -> struct(n.coverage, n.end - n.start as size, n.license)))")
    return scan(docs, templates, coverage).select(
        "doc_id", best["license"].alias("license"), best["coverage"].alias("coverage"), F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.col("notices.license"), ",").alias("licenses"))
