import random
import re

import numpy as np
import pytest

from seatmeter.llm import components, minhash
from seatmeter.llm.store import Store

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, k, percent=80):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(UP))
        sets.append(frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    parent = {d: d for d, _ in rows if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, (d, _) in enumerate(rows):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if d is not None and rows[j][0] is not None and sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(d), find(rows[j][0])
                parent[max(a, b)] = min(a, b)
    return sorted(((d, len(s), None if d is None else find(d), d is None or d == find(d)) for (d, _), s in zip(rows, sets)), key=str)


def run(df, **kw):
    return sorted((tuple(r) for r in minhash.near_duplicates(df, minhash.Params(**kw)).collect()), key=str)


def test_super_minhash_estimates_jaccard_and_ignores_chunking():
    rng = np.random.default_rng(1)
    size, errors = 128, []
    for n, share in ((3, 1 / 3), (40, 0.5), (400, 0.8), (3000, 0.25)):
        for _ in range(20):
            pool = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
            both = int(n * share * 2 / (1 + share))
            a, b = pool[:n], np.concatenate([pool[:both], pool[n: 2 * n - both]])
            first = np.array([0, n, 2 * n])
            sig = minhash.super_minhash(np.concatenate([a, b]), first, size)
            again = minhash.super_minhash(np.concatenate([a, b]), first, size, chunk=7 if n < 50 else 1000)
            assert (sig == again).all()
            errors.append((sig[0] == sig[1]).mean() - both / (2 * n - both))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    empty = minhash.super_minhash(np.zeros(0, np.uint64), np.array([0, 0]), 8)
    assert (empty == np.iinfo(np.uint64).max).all()


@pytest.mark.parametrize("k", [2, 5])
def test_table(sp, docs, k):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, k)
    assert any(not r[3] for r in want)
    assert run(docs, shingle=k) == want


def test_edge_rows_and_chains(sp, frame, monkeypatch):
    rng = random.Random(4)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "One  two"), (7, "x " * 60_000), (8, "x " * 70_000), (None, "one"), (9, "z y"), (9, "z y")]
    words = list(base)
    for i in range(40):                       # a chain: each differs a little from the one before
        for _ in range(3):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        rows.append((100 - i, " ".join(words)))
    for i in range(60):                       # a star: all near one text, not near each other
        w = list(base)
        for _ in range(6):
            w[rng.randrange(len(w))] = f"m{rng.randrange(10**6)}"
        rows.append((200 + i, " ".join(w)))
    monkeypatch.setattr(minhash, "BLOCK", 16)  # buckets are dealt out as pairs of blocks
    df = frame(rows, "doc_id long, text string")
    assert run(df, shingle=2) == brute(rows, 2)


def test_empty_table(sp, frame):
    assert run(frame([], "doc_id long, text string")) == []


def test_components_of_paths_and_stars(sp):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001 + i) for i in range(200)] + [(5000, 5000), (None, 7), (8, None)]
    edges += [(rng.randrange(2000, 2600), rng.randrange(2000, 2600)) for _ in range(300)] * 2
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    df = sp.createDataFrame(edges, "u long, v long").repartition(7)
    got = {r.node: r.component for r in components.components(df, Store(sp, "t")).collect()}
    assert got == {x: find(x) for x in parent}


def test_bitmaps_bound_the_intersection_at_any_width():
    rng = np.random.default_rng(4)
    sizes = [3, 900, 1024, 1025, 1200, 4096, 4097, 5000, 9000]
    pool = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    sets = [pool[rng.permutation(20_000)[:n]] for n in sizes]
    first = np.concatenate([[0], np.cumsum(sizes)])
    words, ends = minhash.bitmaps(np.concatenate(sets), first)
    assert np.diff(ends).tolist() == minhash.widths(np.array(sizes)).tolist() == [16] * 3 + [64] * 3 + [256] * 3
    for i in range(len(sizes)):
        for j in range(i, len(sizes)):
            w = int(np.diff(ends)[i])
            a, b = minhash.folded(words, ends[[i, i + 1]], w)[0], minhash.folded(words, ends[[j, j + 1]], w)[0]
            both = len(set(sets[i].tolist()) & set(sets[j].tolist()))
            bound = min(sizes[i] - np.bitwise_count(a & ~b).sum(dtype=np.int64), sizes[j] - np.bitwise_count(b & ~a).sum(dtype=np.int64))
            assert both <= bound


def test_long_texts_and_pairs_not_sent(sp, frame, monkeypatch):
    rng = random.Random(8)
    long = [f"w{rng.randrange(10**6)}" for _ in range(7000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:6500])), (3, " ".join(long[:1500])), (4, " ".join(long[:1300])), (5, " ".join(long[3000:])),
            (6, " ".join(rng.sample(long, 7000)))] + [(10 + i, " ".join(long[i: 1100 + i])) for i in range(12)]
    want = brute(rows, 2)
    assert len({r[2] for r in want}) < len(want)
    assert run(frame(rows, "doc_id long, text string"), shingle=2) == want
    monkeypatch.setattr(minhash, "SENT", 0)
    assert run(frame(rows, "doc_id long, text string"), shingle=2) == want
