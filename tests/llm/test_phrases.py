import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seatmeter.llm import phrases
from seatmeter.llm import quotient as cqf
from seatmeter.llm.queries import QUERIES
from seatmeter.llm.store import Store

SCHEMA = "doc_id long, lang string, text string"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, shortest=2, longest=3, least=10, percent=50, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UP)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if shortest <= len(p) and a >= least}
        most = Counter()
        for p, a in cand.items():
            for m in range(shortest, len(p)):
                for i in range(len(p) - m + 1):
                    most[p[i:i + m]] = max(most[p[i:i + m]], a)
        rows = []
        for p, a in cand.items():
            if 100 * most[p] >= percent * a:
                continue
            s, _, le, r = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((-s, -a, " ".join(p).encode(), le, r))
        out += [(lang, i + 1, b.decode(), -a, le, r, n[lang], -s) for i, (s, a, b, le, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def run(df, **kw):
    return sorted(tuple(r) for r in phrases.collocations(df, phrases.Params(**kw)).collect())


def test_table(sp, docs):
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op12_phrase_collocations"](sp, "/root/testdata/sf0.001").collect())
    assert got == brute(rows) and len({r[0] for r in got}) > 1


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["Red", "red", "fox", "the", "THE", "é", "漢字", "a", "new", "york", "city", "x" * 300]
    rows = [(i, rng.choice(["en", "de", None, "", "und"]), "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"])
             for _ in range(rng.randrange(60)))) for i in range(120)]
    rows += [(500 + i, "en", "new york city is new york city") for i in range(12)] + [(900, "fr", None), (901, None, ""), (None, "en", "...,"), (902, "en", "\x0b \x0c")]
    return rows + rows[:9]


@pytest.mark.parametrize("params", [{}, {"least": 2, "longest": 4, "percent": 80, "top": 7}, {"least": 3, "part_grams": 16}])
def test_edges(frame, params, monkeypatch):
    rows = made(len(params))
    want = brute([r[1:] for r in rows], **{k: v for k, v in params.items() if k != "part_grams"})
    if "part_grams" in params:
        monkeypatch.setattr(phrases, "FAN", 2)                # several rounds of merging
    assert run(frame(rows, SCHEMA), **params) == want
    assert run(frame([], SCHEMA), **params) == []
    assert run(frame([(1, "en", None)], SCHEMA), **params) == []


def test_words_whose_ids_fall_together(sp, frame, monkeypatch):
    rows = made(9)
    monkeypatch.setattr(phrases, "RESERVED", 8000)            # of 8192 ids: nearly all words become exceptions
    words = frame(rows, SCHEMA).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(phrases._count_words, phrases.WORDS)
    words = words.groupBy("lang", "word", "hash").agg(F.sum("n").alias("n"))
    monkeypatch.setattr(phrases, "WIDTHS", (13, 64))
    named, ids = phrases.word_ids(words, 60)
    assert ids.exceptions and named.select("id").distinct().count() == named.count()
    base = frame(rows, SCHEMA).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    grams = phrases.count_grams(base, phrases.Params(least=2), ids, 1000, Store(sp, "t"))
    name = {r.id: (r.lang, r.word) for r in named.collect()}
    want = Counter()
    for _, lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UP)):
            w = re.findall(r"[^\x20\x09]+", piece)
            want.update((("und" if lang is None else lang), *w[i:i + m]) for m in (2, 3) for i in range(len(w) - m + 1))
    got = {(name[r.ids[0]][0], *(name[i][1] for i in r.ids)): r.f for r in grams.collect()}
    assert got == {k: n for k, n in want.items() if n >= 2}


def test_scores_are_exact(sp):
    a, le, r = 10**15 + 7, 10**17 + 3, 10**15 + 9
    got = sp.range(1).selectExpr(phrases._score(f"{a}L", f"{le}L", f"{r}L") + " AS s").first().s
    assert got == 1_000_000 * a * a // (le * r)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([2, 3]), st.sampled_from([32, 40, 64]), st.integers(0, 400), st.sampled_from([0, 3, 8]))
def test_filters_lose_nothing(seed, n, bits, m, head):
    rng = np.random.default_rng(seed)
    top = np.uint64((1 << bits) - 1)
    grams = [rng.integers(0, 2**63, m).astype(np.uint64) * np.uint64(2) & top for _ in range(n)]
    for g in grams:
        g[: m // 2] %= np.uint64(3)                            # many equal ones
    keys = cqf.permute(grams, bits)
    assert all((a == b).all() for a, b in zip(cqf.unpermute(keys, bits), grams))
    counts = rng.integers(1, 10 ** rng.integers(1, 15), m)
    want = Counter()
    for g, c in zip(zip(*[x.tolist() for x in grams]), counts.tolist()):
        want[g] += c
    half = m // 3
    stacked, got = np.stack(keys), Counter()
    parts = [cqf.gather(stacked[:, :half], counts[:half], bits), cqf.gather(stacked[:, half:], counts[half:], bits)]
    for p in range(1 << head):
        filters = []
        for k, c in parts:
            mine = (k[0] >> np.uint64(bits - head)) == p if head else np.ones(k.shape[1], bool)
            if mine.any():
                filters.append(cqf.encode(k[:, mine], c[mine], bits, head))
        if filters:
            k, c, _ = cqf.merge(filters)
            assert k.shape[1] == len(set(map(tuple, k.T.tolist())))
            for g, x in zip(zip(*[b.tolist() for b in cqf.unpermute(list(k), bits)]), c.tolist()):
                got[g] += x
            some = cqf.encode(k, c, bits, head)
            g = tuple(int(b[0]) for b in cqf.unpermute(list(k[:, :1]), bits))
            assert cqf.lookup(some, list(g)) == want[g]
            strange = [x ^ 1 for x in g]
            assert cqf.lookup(some, strange) == (want[tuple(strange)] if p == int(cqf.permute([np.array([x], np.uint64) for x in strange], bits)[0][0]) >> (bits - head) else 0)
    assert got == want


def test_a_filter_is_small():
    rng = np.random.default_rng(1)
    grams = [rng.integers(0, 1 << 32, 200_000).astype(np.uint64) for _ in range(3)]
    keys, counts = cqf.gather(np.stack(cqf.permute(grams, 32)), np.ones(200_000, np.int64), 32)
    assert len(cqf.encode(keys, counts, 32)) < 200_000 * (2 + 4 + 4 + 1 + 0.5)
