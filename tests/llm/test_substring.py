import random
import re
from collections import Counter

import numpy as np
import pytest

from seatmeter.llm import fmindex, substring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def run(df, **kw):
    rows = substring.dedup_substrings(df, substring.Params(**kw)).collect()
    for r in rows:
        assert sum(x.to_word - x.from_word for x in r.removed) == r.n_removed
    return sorted((tuple(r)[:4] for r in rows), key=str)


def test_index_finds_all_repeated_windows():
    rng = np.random.default_rng(0)
    for _ in range(150):
        sigma, least = int(rng.integers(1, 8)), int(rng.integers(2, 6))
        seqs = [rng.integers(0, sigma, rng.integers(0, 25)) for _ in range(int(rng.integers(1, 12)))]
        words, first = np.concatenate(seqs).astype(np.int64), np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
        if not len(words):
            continue
        seen = Counter(tuple(s[i:i + least]) for s in seqs for i in range(len(s) - least + 1))
        want = {(q, i + j) for q, s in enumerate(seqs) for i in range(len(s) - least + 1) if seen[tuple(s[i:i + least])] > 1 for j in range(least)}
        got = {(q, i) for q, a, b in zip(*fmindex.repeated_intervals(fmindex.FMIndex(words, first, sigma), words, first, least)) for i in range(a, b)}
        assert got == want


def test_wavelet_rank():
    rng = np.random.default_rng(1)
    seq = np.minimum(rng.geometric(0.05, 5000) - 1, 99)
    tree = fmindex.Wavelet(seq, 101)
    symbol, at = rng.integers(0, 101, 2000), rng.integers(0, 5001, 2000)
    assert tree.rank(symbol, at).tolist() == [int((seq[:i] == s).sum()) for s, i in zip(symbol, at)]


def test_table(sp, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows, 35)
    assert any(0 < r[2] < r[1] for r in want)
    assert run(docs) == want
    assert run(docs, hot=1, block_bytes=20_000) == want        # every segment cut into windows, many blocks
    assert run(docs, shard_words=500, anchor=35) == want


@pytest.mark.parametrize("hot", [0, 5, 10**9])
def test_edge_rows(sp, frame, hot):
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(60))
    word = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "a b c"), (4, "x " * 20_000), (5, "a b " * 40), (6, "a b c " * 30), (7, word(30_000)),
            (8, word(34)), (9, word(35)), (None, passage), (10, passage.replace(" ", "  \n")), (10, "same id"), (11, passage.upper())]
    rows += [(20 + i, word(rng.randrange(60)) + " " + passage + " " + word(rng.randrange(60))) for i in range(80)]   # one common passage
    rows += [(200 + i, " ".join(f"é{rng.randrange(3)}" for _ in range(rng.randrange(300)))) for i in range(60)]      # few words
    rows += [(300, passage[: len(passage) // 2] + " end"), (301, "z " + passage), (302, passage + " " + passage)]
    rows += [(400 + i, "copy " * 10 + word(5) if i < 2 else "one text of some words " * 12) for i in range(30)]
    rng.shuffle(rows)
    assert run(frame(rows, "doc_id long, text string"), hot=hot, block_bytes=30_000) == brute(rows, 35)


def test_empty_table(sp, frame):
    assert run(frame([], "doc_id long, text string")) == []
