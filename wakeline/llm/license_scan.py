"""License scans: Dice coefficient over word bigrams against licence templates.

A text is cut into units: its lines, its paragraphs (between blank lines) and
the whole of it.  A unit and a template are normalised the same way (lower
case, everything but letters, digits and dots inside numbers is a space, so
comment marks go) and become multisets of neighbouring word pairs.  Their Dice
coefficient is 2 |A and B| / (|A| + |B|).  A unit names the licence of the
template with the largest coefficient, if that is at least ``LEAST`` (of equal
ones each).

Notices also stand inside a unit: in a longer line, in a comment block, before
code.  So every passage, any run of words of the whole text whatever its lines,
is compared too.  A passage that reaches ``LEAST`` names its licence unless
half of it or more lies in a unit that names one at least as closely, or in a
closer passage.  Against a template of fewer than ``SHORT`` pairs a passage has
as many pairs at least, else the version could be left off ("CC BY 3.0" would
name CC-BY-4.0).

The passages are found without trying all: one that reaches t has t / 2 (|A| +
|B|) common pairs, so it holds at least one of the rarer pairs of the template
(its anchors, as many as cannot all be missing); a text without an anchor is
done.  Where the common pairs are dense enough, every window that begins and
ends with one is counted.

A coefficient of t needs |A| between t / (2 - t) |B| and (2 - t) / t |B|, so a
unit is compared only with the templates whose size allows it.

One pass over the documents, without a shuffle; the templates are constants:
customary notices, and the complete texts of the licences in ``licence_texts``.

Cases: a null text is empty and matches nothing.  Repeated rows get their rows
each.  A unit that is line, paragraph and text at once counts once, as a line.
Long texts are compared whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .licence_texts import TEXTS

LEAST = 0.8
#: Pairs in a stretch of the look-up of found places.
NEAR = 64
#: Pairs in a stretch of the look-up of found places.
NEAR = 64
#: Pairs from which on a passage may be shorter than the template.
SHORT = 20

_MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_FREE = "This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2} as published by the Free Software Foundation{3} either version {4} of the License, or (at your option) any later version."

#: Customary notices of public licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", _ISC),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", _MIT),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    # complete texts
    ("MIT", _MIT + " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", _ISC + " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_END),
    *TEXTS,
    # further notices: licences that a shorter passage would take for one of the above
    ("MIT", "Distributed under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Licensed under the terms of the MIT License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("GPL-2.0", _FREE.format("program", ";", "General Public License", ";", "2")),
    ("LGPL-2.1", _FREE.format("library", ";", "Lesser General Public License", ";", "2.1")),
    ("LGPL-3.0", _FREE.format("program", ":", "Lesser General Public License", ",", "3")),
    ("AGPL-3.0", _FREE.format("program", ":", "Affero General Public License", ",", "3")),
]

#: Words that say little about a licence; pairs of them are anchors last.
_COMMON = frozenset("a all an and any are as at be but by can for from has have if in is it its may no not of on or other such that the their these this to under was which will with you your".split())
_OTHER = re.compile(r"(?<!\d)\.|\.(?!\d)|[^\w.\n]|_")


def pairs(text: str) -> list[tuple[str, str]]:
    w = _OTHER.sub(" ", text.lower()).split()
    return list(zip(w, w[1:]))


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], least: float):
        self.least = least
        sized = sorted(((len(p), name, Counter(p)) for name, t in templates if (p := pairs(t))), key=lambda x: x[0])
        self.sizes = [x[0] for x in sized]
        self.templates = [x[1:] for x in sized]
        self.factor = least / (2 - least)
        self.smallest = self.factor * self.sizes[0] - 1e-9
        self.largest = self.sizes[-1] / self.factor + 1e-9
        spread = Counter(p for _, _, template in sized for p in template)
        self.anchors: dict[tuple[str, str], list[int]] = defaultdict(list)
        for k, (size, _, template) in enumerate(sized):
            missing = size - least / 2 * (size + self.factor * size) + 1e-9  # so many can be missing, not more
            rare = sorted(template, key=lambda p: (sum(x in _COMMON for x in p), spread[p], -len(p[0]) - len(p[1]), p))
            for p in rare:
                self.anchors[p].append(k)
                missing -= template[p]
                if missing < 0:
                    break

    def compare(self, found: list[tuple[str, str]]) -> list[tuple[str, float]]:
        """The licences whose template is closest, if close enough, with the coefficient."""
        n = len(found)
        if not self.smallest <= n <= self.largest or self.anchors.keys().isdisjoint(found):
            return []
        have, out = Counter(found), []
        low = bisect_left(self.sizes, n * self.factor - 1e-9)
        for size, (name, template) in zip(self.sizes[low:], self.templates[low:]):
            if size > n / self.factor + 1e-9:
                break
            common = sum(min(k, template[p]) for p, k in have.items() if p in template)
            dice = 2 * common / (n + size)
            if dice >= self.least and (not out or dice >= out[0][1]):
                out = [x for x in out if x[1] == dice and x[0] != name] + [(name, dice)]
        return out

    def windows(self, found: list[tuple[str, str]], k: int) -> list[tuple[float, int, int, str]]:
        """The closest passages, without overlap, for one template: coefficient, first pair, end, licence."""
        size, (name, template), part = self.sizes[k], self.templates[k], self.least / 2
        places = [i for i, p in enumerate(found) if p in template]
        # a passage is close enough if its common pairs less ``part`` of its pairs come to ``part`` of the template;
        # without the limit on repeats this is a largest sum, which nowhere needs what goes before a sum of 0
        regions, total, start, enough = [], 0.0, 0, False
        for j, i in enumerate(places):
            total -= part * (i - places[j - 1] - 1) if j else 0
            if total <= 0:
                if enough:
                    regions.append((start, j))
                total, start, enough = 0.0, j, False
            total += 1 - part
            enough |= total >= part * size - 1e-9
        if enough:
            regions.append((start, len(places)))
        out: list[tuple[float, int, int, str]] = []
        shortest, longest = size if size < SHORT else 0, size / self.factor + 1e-9
        for first, end in regions:
            at = np.array(places[first:end])
            low = np.searchsorted(at, at - longest + 1)
            common, seen = np.zeros(len(at), np.int64), defaultdict(list)
            for j in range(len(at)):
                p = found[at[j]]
                seen[p].append(j)
                before = seen[p][-template[p] - 1] + 1 if len(seen[p]) > template[p] else 0
                a = low[j]
                common[max(before, a):j + 1] += 1  # from these places on, the pair is not yet used up
                dice = 2 * common[a:j + 1] / (np.maximum(at[j] - at[a:j + 1] + 1, shortest) + size)
                best = int(dice.argmax())
                if dice[best] >= self.least:
                    x = (float(dice[best]), int(at[a + best]), int(at[j]) + 1, name)
                    if not out or x[1] >= out[-1][2]:
                        out.append(x)
                    elif x[0] > out[-1][0]:
                        out[-1] = x
        return out

    def scan(self, text: str | None) -> list[tuple[str, float, int]]:
        """(licence, best coefficient, units and passages that name it), by licence."""
        text = text or ""
        lines = [x.split() for x in _OTHER.sub(" ", text.lower()).split("\n")]
        w = [x for line in lines for x in line]
        found = list(zip(w, w[1:]))
        if self.anchors.keys().isdisjoint(found):
            return []
        starts = [0, *np.cumsum([len(x) for x in lines]).tolist()]
        units = [(k, k + 1) for k in range(len(lines))]
        paragraphs, at = re.split(r"\n[^\S\n]*\n", text), 0
        for p in paragraphs:
            n = p.count("\n") + 1
            if n > 1:
                units.append((at, at + n))
            at += n + 1  # the blank line
        if len(lines) > 1 and paragraphs != [text]:
            units.append((0, len(lines)))
        best: dict[str, float] = {}
        n_units: Counter = Counter()
        named: list[tuple[float, int, int, str]] = []
        for first, last in units:
            a, b = starts[first], max(starts[first], starts[last] - 1)
            named += [(dice, a, b, name) for name, dice in self.compare(found[a:b])]
        passages = [x for k in sorted({k for p in found if p in self.anchors for k in self.anchors[p]}) for x in self.windows(found, k)]
        named += _uncovered(sorted(passages, key=lambda x: (-x[0], x[1] - x[2], x[1], x[3])), sorted(named, key=lambda y: -y[0]))
        for dice, _, _, name in named:
            best[name] = max(dice, best.get(name, 0.0))
            n_units[name] += 1
        return [(name, best[name], n_units[name]) for name in sorted(best)]


def _uncovered(passages: list[tuple[float, int, int, str]], named: list[tuple[float, int, int, str]]) -> list[tuple[float, int, int, str]]:
    """The passages, best first, of which no half lies in one found with as much
    or more (in ``named``, best first, or before it); the same place under
    another name with as much does not count.

    What holds half of a passage holds its middle, so found places are looked
    up by the stretch of ``NEAR`` pairs that the middle is in."""
    kept, found, taken = [], defaultdict(list), 0

    def enter(y: tuple[float, int, int, str]) -> None:
        for k in range(y[1] // NEAR, y[2] // NEAR + 1):
            found[k].append(y)

    for x in passages:
        while taken < len(named) and named[taken][0] >= x[0]:
            enter(named[taken])
            taken += 1
        beside = found.get((x[1] + x[2]) // 2 // NEAR, ())
        if all(y[:3] == x[:3] and y[3] != x[3] for y in beside if 2 * (min(x[2], y[2]) - max(x[1], y[1])) >= x[2] - x[1]):
            kept.append(x)
            enter(x)
    return kept


def find_licences(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """One row per document and licence: doc_id, licence, dice, n_units."""
    schema = pa.schema([("doc_id", pa.int64()), ("licence", pa.string()), ("dice", pa.float64()), ("n_units", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                rows += [(doc_id.as_py(), *x) for x in scanner.scan(text.as_py())]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, licence string, dice double, n_units int")
