import random
import re
from collections import Counter

from seatmeter.llm import licenses

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", text.translate(UP))


def brute(text, least=0.8):
    text = text or ""
    bags = [(n, Counter(zip(w, w[1:]))) for n, t in licenses.TEMPLATES for w in [words(" ".join(t.split()))]]
    units, pos, line_no, start, last, para = {}, 0, 0, 0, None, []
    lines = [words(x) for x in text.split("\n")]
    units[(0, sum(map(len, lines)))] = "text"
    paras, cur, at = [], None, 0
    spans = []
    for w in lines:
        spans.append((at, at + len(w)))
        at += len(w)
    for s, e in spans:
        if s == e:
            if cur:
                paras.append(cur)
            cur = None
        else:
            cur = (cur[0], e) if cur else (s, e)
    if cur:
        paras.append(cur)
    # the words of a paragraph must be on neighbouring lines
    for x in paras:
        units.setdefault(x, "paragraph")
    for s, e in spans:
        if e > s:
            units.setdefault((s, e), "line")
    flat, out = [x for w in lines for x in w], set()
    for (a, b), kind in units.items():
        bag = Counter(zip(flat[a:b], flat[a + 1:b]))
        for t, (name, own) in enumerate(bags):
            if bag:
                dice = 2 * sum((bag & own).values()) / (sum(bag.values()) + sum(own.values()))
                if dice >= least:
                    out.add((name, t, kind, round(dice, 12), a, b))
    return out


def check(df, rows):
    got = licenses.scan_licenses(df).collect()
    assert len(got) == len(rows)
    want = sorted((str((d, sorted(brute(t)))) for d, t in rows))
    assert sorted(str((r.doc_id, sorted((m.license, m.template, m.unit, round(m.dice, 12), m.from_word, m.to_word) for m in r.matches))) for r in got) == want
    for r in got:
        assert r.n_matches == len(r.matches) and (r.license is None) == (not r.matches)
        if r.matches:
            assert r.dice == max(m.dice for m in r.matches) and r.license in r.licenses.split(",")


def test_table(sp, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check(docs, rows)
    assert any(brute(t) for _, t in rows)


def test_edge_rows(sp, frame):
    rng = random.Random(2)
    mit = licenses.TEMPLATES[0][1]
    rows = [(0, None), (1, ""), (2, "\n\n"), (3, mit), (4, "Copyright 2020\n\n" + mit.upper() + "\n\ncode code"), (5, mit.replace(" ", "\n")),
            (6, "x " * 40_000 + "\nReleased under the MIT License.\n" + "y " * 10), (7, "released; UNDER the *MIT* license"), (8, "Licensed under CC BY-NC 4.0."),
            (8, "Licensed under CC BY-NC 4.0."), (None, "Licensed under CC BY 4.0.\r\nLicensed under CC BY-SA 4.0."), (9, "word"), (10, "é ß\né ß")]
    for i in range(60):
        w = rng.choice(licenses.TEMPLATES)[1].split()
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = rng.choice(["foo", "the", "License", "\n", "\n\n"])
        rows.append((100 + i, f"{rng.choice(['', 'a b\n', 'a b\n\n'])}{' '.join(w)}{rng.choice(['', '\nend here', '\n \nend'])}"))
    check(frame(rows, "doc_id long, text string"), rows)


def test_empty_table(sp, frame):
    assert licenses.scan_licenses(frame([], "doc_id long, text string")).collect() == []


NOTICES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    "Apache-2.0": """ * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.""",
    "GPL-3.0": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
    "BSD-3-Clause": licenses._BSD.replace("met: ", "met:\n\n1. ").replace("disclaimer. Red", "disclaimer.\n\n2. Red") + "\n\n3. "
    + licenses._NO_NAME + "\n\n" + licenses._BSD_END,
    "MPL-2.0": licenses.TEMPLATES[[n for n, _ in licenses.TEMPLATES].index("MPL-2.0")][1],
}


def test_notices_inside_long_texts(sp, frame):
    prose = "\n\n".join(" ".join(f"w{(i * 7 + j) % 97}" for j in range(80)) for i in range(40))
    rows, want = [], []
    for name, notice in NOTICES.items():
        for text in (f"{prose}\n\n{notice}\n\n{prose}", f"{prose} {' '.join(notice.split())} {prose}", f"{prose}\n{notice}\n{prose}"):
            want.append((len(rows), name))
            rows.append((len(rows), text))
    twice = f"{prose}\n\n{NOTICES['MIT']}\n\n{NOTICES['MIT']}\n\n{NOTICES['Apache-2.0']} {prose}"
    got = {r.doc_id: r for r in licenses.scan_licenses(frame([*rows, (900, twice), (901, prose), (902, "x to the y")], "doc_id long, text string"), licenses.Params(windows=True)).collect()}
    assert [(i, got[i].license) for i, _ in want] == want
    assert [(i, got[i].licenses) for i, _ in want] == want
    assert all(got[i].dice > 0.95 for i, _ in want)
    at = [(m.license, m.from_word) for m in sorted(got[900].matches, key=lambda m: m.from_word) if m.to_word - m.from_word > 50]
    assert [n for n, _ in at] == ["MIT", "MIT", "Apache-2.0"] and at[0][1] == len(words(prose))
    assert got[901].license is got[902].license is None


def test_windows_against_brute_force():
    rng, p = random.Random(4), licenses.Params(windows=True, templates=(("A", "a b c a b d e f"), ("B", "c a b d")))
    found = licenses.Templates(p)
    for _ in range(400):
        w = [rng.choice("aabbcdefxy") for _ in range(rng.randrange(60))]
        if rng.random() < 0.7:
            at = rng.randrange(len(w) + 1)
            w[at:at] = rng.choice(p.templates)[1].split()
        data, offsets = licenses.tx.utf8(licenses.pa.array(["a b c", " ".join(w), "d e f"], licenses.pa.large_string()))
        got = [m for m in found.matches(data, offsets, p) if m[0] == 1]
        for t, (_, text) in enumerate(p.templates):
            own = Counter(zip(text.split(), text.split()[1:]))
            every = {(a, b): 2 * (Counter(zip(w[a:b], w[a + 1:b])) & own).total() / (b - a - 1 + own.total())
                     for a in range(len(w)) for b in range(a + 2, len(w) + 1)}
            every = {k: v for k, v in every.items() if v >= p.least}
            mine = {(a, b): dice for _, x, _, dice, a, b in got if x == t}
            assert all(every[k] == v for k, v in mine.items())
            # every window of the least Dice overlaps a reported one, and the best ones are among these
            assert all(any(a < y and x < b for x, y in mine) for a, b in every)
            if every and not any(x == t and kind != "window" for _, x, kind, *_ in got):
                assert max(mine.values()) == max(every.values())
