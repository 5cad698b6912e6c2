"""Licence scan: normalised text against licence templates by Dice coefficient over word bigrams.

Every document is compared as a whole, by paragraph (runs of lines without an
empty one) and by line. For a unit with a bigrams and a template with b,
Dice = 2 * shared / (a + b) (bigrams counted as a multiset), so it can reach
``least`` only if

    b * least / (2 - least)  <=  a  <=  b * (2 - least) / least

These size bounds prune the templates of each unit before any bigram is
compared, and units that hold no bigram of any template are never compared.

A notice need not be a unit: it may run over several paragraphs of a longer text
or stand within a line. So, with ``windows``, outside the units that match a template, every window
of words that the size bounds allow is compared with it, and of windows that
overlap the one of highest Dice is kept, if no unit shows another template better
in most of its words. A window can reach ``least`` only if it
holds b * least / (2 - least) bigrams of the template, and its Dice is highest
where it begins and ends with one, so only such windows are looked at.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_NO_NAME = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
THE POSSIBILITY OF SUCH DAMAGE."""

# Public licence notices, (licence, text). Several texts may stand for one licence.
TEMPLATES = (
    ("MIT", _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required
by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version."""),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
version."""),
    ("BSD-2-Clause", f"{_BSD} {_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD} {_NO_NAME} {_BSD_END}"),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means."""),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)


@dataclass(frozen=True)
class Params:
    least: float = 0.8
    windows: bool = False         # notices that are no unit, too (the registered query asks for them)
    templates: tuple[tuple[str, str], ...] = field(default=TEMPLATES)


# A-Z lowered, digits, letters and every byte above ASCII stay; other marks separate words; a newline stays
_NORMAL = np.full(256, 0x20, dtype=np.uint8)
for _c in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100), 0x0A):
    _NORMAL[_c] = _c
_NORMAL[0x41:0x5B] = np.arange(0x61, 0x7B)
UNITS = ("text", "paragraph", "line")


class Units:
    """Normalised words of a run of documents, and their whole texts, paragraphs and lines."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        w = tx.Words(_NORMAL[data], offsets)
        h = w.hashes()
        self.bigram = tx.combine(h[:-1], h[1:]) if len(h) > 1 else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(offsets) - 1), w.counts())
        # line of a word: newlines before it; a paragraph ends where two lines with words have an empty one between
        line = np.searchsorted(np.flatnonzero(data == 0x0A), w.start)
        new_doc = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
        step = np.diff(line, prepend=line[:1])
        edges = {"text": new_doc, "paragraph": new_doc | (step > 1), "line": new_doc | (step > 0)}
        self.units: list[tuple[int, str, int, int]] = []        # document, kind, first word, end
        self.words, self.owner = w, owner
        self.edges = {k: np.append(np.flatnonzero(v), len(owner)) for k, v in edges.items()}


class Templates:
    def __init__(self, p: Params):
        self.names = [n for n, _ in p.templates]
        data, offsets = tx.utf8(pa.array([" ".join(t.split()) for _, t in p.templates], pa.large_string()))
        units = Units(data, offsets)
        first = units.words.first
        self.bags = [np.unique(units.bigram[a:max(a, b - 1)], return_counts=True) for a, b in zip(first[:-1], first[1:])]
        self.size = np.array([int(n.sum()) for _, n in self.bags])
        self.low = np.ceil(self.size * p.least / (2 - p.least) - 1e-9)
        self.high = np.floor(self.size * (2 - p.least) / p.least + 1e-9)
        every = np.unique(np.concatenate([k for k, _ in self.bags])) if self.bags else np.zeros(0, np.uint64)
        self.every = every
        self.most = np.zeros((len(self.bags), len(every)), dtype=np.int64)       # how often a template holds a bigram
        for row, (k, n) in zip(self.most, self.bags):
            row[np.searchsorted(every, k)] = n
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(every >> np.uint64(44)).astype(np.int64)] = True

    def matches(self, data: np.ndarray, offsets: np.ndarray, p: Params):
        """(document, template, unit kind, dice, first word, end) of every unit and template at ``least`` or more."""
        u = Units(data, offsets)
        hit = np.flatnonzero(self.seen[(u.bigram >> np.uint64(44)).astype(np.int64)])
        hit = hit[np.isin(u.bigram[hit], self.every)]
        done: set[tuple[int, int]] = set()
        found: list[list[tuple[int, int]]] = [[] for _ in self.names]
        better: list[tuple[int, int, float]] = []
        for kind in UNITS:
            edge = u.edges[kind]
            if len(edge) < 2 or not len(hit):
                continue
            unit = np.unique(np.searchsorted(edge, hit, side="right") - 1)
            for a, b in zip(edge[unit].tolist(), edge[unit + 1].tolist()):
                n = b - a - 1
                fits = np.flatnonzero((self.low <= n) & (n <= self.high))
                if not len(fits) or (a, b) in done:         # a line that is the whole text counts as the text
                    continue
                done.add((a, b))
                keys, counts = np.unique(u.bigram[a:b - 1], return_counts=True)
                for t in fits.tolist():
                    own, most = self.bags[t]
                    _, x, y = np.intersect1d(keys, own, assume_unique=True, return_indices=True)
                    dice = 2 * int(np.minimum(counts[x], most[y]).sum()) / (n + int(self.size[t]))
                    if dice >= p.least:
                        found[t].append((a, b))
                        better.append((a, b, dice))
                        base = int(u.words.first[u.owner[a]])
                        yield int(u.owner[a]), t, kind, dice, a - base, b - base
        if not p.windows:
            return
        better.sort()
        longest = max((b - a for a, b, _ in better), default=0)
        key = np.searchsorted(self.every, u.bigram[hit])
        for t, spans in enumerate(found):
            own = self.most[t, key] > 0
            for a, b, dice in self.windows(t, u, hit[own], key[own], spans, p):
                near = better[bisect_left(better, (a - longest,)): bisect_left(better, (b,))]
                if any(d > dice and 2 * (min(b, y) - max(a, x)) > b - a for x, y, d in near):
                    continue                                            # a unit shows another template there
                base = int(u.words.first[u.owner[a]])
                yield int(u.owner[a]), t, "window", dice, a - base, b - base

    def windows(self, t: int, u: Units, at: np.ndarray, key: np.ndarray, spans: list[tuple[int, int]], p: Params):
        """(first word, end, dice) of the windows that match a template outside ``spans``, none overlapping another.

        at, key: positions of the template's bigrams and which ones they are.
        """
        low, high, size = int(self.low[t]), int(self.high[t]), int(self.size[t])
        # a bigram counts in a window unless the window holds it as often as the template already: from ``full`` on
        order = np.argsort(key, kind="stable")
        back = np.arange(len(at)) - self.most[t, key[order]]
        full = np.full(len(at), -1, dtype=np.int64)
        same = (back >= 0) & (key[order[np.maximum(back, 0)]] == key[order])
        full[order[same]] = at[order[back[same]]]
        while len(at) >= low:
            start, end = (np.sort(np.array([x[i] for x in spans], dtype=np.int64)) for i in (0, 1))
            edges = np.sort(np.concatenate([u.words.first, start, end]))
            piece = np.searchsorted(edges, at, side="right")
            inside = np.searchsorted(start, at, side="right") > np.searchsorted(end, at, side="right")
            keep = ~inside & (piece == np.searchsorted(edges, at + 1, side="right"))
            at, full, piece = at[keep], full[keep], piece[keep]
            if len(at) < low:
                return
            reach = np.arange(low - 1, len(at))
            first = np.flatnonzero((at[reach] - at[reach - low + 1] < high) & (piece[reach] == piece[reach - low + 1]))
            if not len(first):
                return
            last = np.minimum(np.searchsorted(at, at[first] + high), np.searchsorted(piece, piece[first], side="right"))
            best: list[tuple[float, int, int]] = []
            rows = max(1, (1 << 20) // int((last - first).max()))
            for i in range(0, len(first), rows):
                f, e = first[i: i + rows, None], last[i: i + rows, None]
                col = f + np.arange(int((e - f).max()))
                valid = col < e
                col = np.minimum(col, len(at) - 1)
                shared = np.cumsum(valid & (full[col] < at[f]), axis=1)
                dice = np.where(valid, 2 * shared / (at[col] - at[f] + 1 + size), 0.0)
                to = dice.shape[1] - 1 - np.argmax(dice[:, ::-1], axis=1)        # the longest of the best
                top = dice[np.arange(len(to)), to]
                ok = np.flatnonzero(top >= p.least)
                best += zip((-top[ok]).tolist(), at[f[ok, 0]].tolist(), (at[col[ok, to[ok]]] + 2).tolist())
            new = []
            for less, a, b in sorted(best, key=lambda x: (x[0], x[1] - x[2], x[1])):
                i = bisect_left(new, (a, b))
                if (i == len(new) or b <= new[i][0]) and (i == 0 or new[i - 1][1] <= a):
                    new.insert(i, (a, b))
                    yield a, b, -less
            if not new:
                return
            spans = spans + new                                     # a shorter window may fit beside those kept


def named(matches: list[dict]) -> set[str]:
    """Licences of the matches, without those whose place is taken by another licence.

    A match gives way to one of another licence that has a higher Dice and most of its words, as
    the first paragraph of one notice may resemble a whole other one.
    """
    out, by_start = set(), sorted(matches, key=lambda m: m["from_word"])
    starts = [m["from_word"] for m in by_start]
    longest = max((m["to_word"] - m["from_word"] for m in matches), default=0)
    for m in matches:
        if m["license"] in out:
            continue
        a, b = m["from_word"], m["to_word"]
        near = by_start[bisect_left(starts, a - longest): bisect_left(starts, b)]
        if not any(x["license"] != m["license"] and x["dice"] > m["dice"]
                   and 2 * (min(b, x["to_word"]) - max(a, x["from_word"])) > b - a for x in near):
            out.add(m["license"])
    return out


MATCH = "struct<license:string,template:int,unit:string,dice:double,from_word:long,to_word:long>"
RESULT = f"doc_id long, license string, dice double, unit string, n_matches long, licenses string, matches array<{MATCH}>"


def _scan(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    templates = Templates(p)
    kind = pa.list_(pa.struct([("license", pa.string()), ("template", pa.int32()), ("unit", pa.string()), ("dice", pa.float64()),
                               ("from_word", pa.int64()), ("to_word", pa.int64())]))
    for batch in batches:
        for rows, data, offsets in tx.runs(batch, "text"):
            found: list[list[dict]] = [[] for _ in range(rows.num_rows)]
            for d, t, unit, dice, a, b in templates.matches(data, offsets, p):
                found[d].append({"license": templates.names[t], "template": t, "unit": unit, "dice": dice, "from_word": a, "to_word": b})
            for f in found:
                f.sort(key=lambda m: (-m["dice"], m["from_word"], m["to_word"], m["template"]))
            best = [f[0] if f else {} for f in found]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([b.get("license") for b in best], pa.string()), pa.array([b.get("dice") for b in best], pa.float64()),
                 pa.array([b.get("unit") for b in best], pa.string()), pa.array([len(f) for f in found], pa.int64()),
                 pa.array([",".join(sorted(named(f))) for f in found], pa.string()), pa.array(found, kind)],
                ["doc_id", "license", "dice", "unit", "n_matches", "licenses", "matches"])


def scan_licenses(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per document: best licence, its Dice and unit, number of matches, all licences, and the matches.

    docs: doc_id, text; further columns are ignored. Words are runs of ASCII letters and digits
    (A-Z lowered) and of other characters above ASCII; from_word and to_word count these. The best
    match has the highest Dice, then the first position, then the first template. ``licenses`` leaves
    out a licence where another one matches the same words better; ``matches`` holds every match.
    Texts without a match, null and empty ones have a null licence and an empty list; repeated rows
    and null doc_ids get a row each.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(partial(_scan, p=params), RESULT)
