import random
import re
from collections import Counter

import pytest

from seatmeter.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    t = text or ""
    w = WORD.findall(t)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
    return (*n, n[0] < 20 or 100 * n[4] > 30 * n[0])


def measured(df):
    return quality.judge(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def test_table(sp, docs):
    got = {r.doc_id: r for r in measured(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for d, t in rows:
        assert tuple(got[d])[1:7] == base(t)
        assert not (got[d].kept and got[d].base_failed)


def test_labels_agree(sp):
    folder = "/root/testdata/sf0.01"
    verdict = quality.judge(sp.read.parquet(f"{folder}/documents.parquet"))
    rows = verdict.join(sp.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_edge_rows(sp, frame):
    rng = random.Random(1)
    rows = [(0, None), (1, ""), (2, " \n\t\x0b\x0c\r"), (3, "a " * 30), (4, "one two three four five six seven eight " * 2), (5, "x\n\nx\n \ny\nx"),
            (6, "é😀 # <b> 100% $ & | *\n" * 3), (7, "w " * 40_000), (None, "the cat"), (8, "dup"), (8, "dup"),
            (9, " ".join(f"w{i}" for i in range(20_000))), (10, "a\x0bb\x0cc\rd")]
    rows += [(100 + i, " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for i in range(100)]
    got = measured(frame(rows, "doc_id long, text string")).collect()
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(((d, *base(t)) for d, t in rows), key=str)


def test_carried_columns_come_back(sp, frame):
    df = frame([(i, f"the good text of the {i} with many words and a line to be kept " * 1 + " ".join(f"w{i}{j}" for j in range(40))) for i in range(5)], "doc_id long, text string")
    df = df.withColumnsRenamed({"row": "n_words", "node": "_t", "digest": "p_good"})
    out = quality.filter_quality(df)
    assert out.columns == df.columns and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


def test_empty_table(sp, frame):
    assert quality.judge(frame([], "doc_id long, text string")).collect() == []


def em_by_hand(patterns, p):
    """Expectation-maximisation in plain Python: patterns is a list of (votes, n)."""
    names = [r.name for r in p.rules]
    good, a, b = p.prior_good, {r: p.right_good for r in names}, {r: p.right_bad for r in names}

    def post(v):
        x, y = good, 1 - good
        for r, s in zip(names, v):
            x *= a[r] if s == 1 else 1 - a[r] if s == -1 else 1
            y *= 1 - b[r] if s == 1 else b[r] if s == -1 else 1
        return x / (x + y)
    for _ in range(p.most_steps):
        q = [post(v) for v, _ in patterns]
        new_good = min(max(sum(n * x for (_, n), x in zip(patterns, q)) / sum(n for _, n in patterns), 0.001), 0.999)
        na, nb = {}, {}
        for i, r in enumerate(names):
            s = {(c, v): sum(n * (x if c else 1 - x) for (w, n), x in zip(patterns, q) if w[i] == v) for c in (0, 1) for v in (1, -1)}
            na[r] = min(max((s[1, 1] + p.right_good * p.weight) / (s[1, 1] + s[1, -1] + p.weight), 0.0001), 0.9999)
            nb[r] = max(min(max((s[0, -1] + p.right_bad * p.weight) / (s[0, 1] + s[0, -1] + p.weight), 0.0001), 0.9999), 1 - na[r])
        moved = max([abs(new_good - good), *(abs(na[r] - a[r]) for r in names), *(abs(nb[r] - b[r]) for r in names)])
        good, a, b = new_good, na, nb
        if moved < p.change:
            break
    return good, a, b, post


def test_em_against_plain_python(sp):
    rng = random.Random(9)
    p = quality.Params(rules=tuple(quality.Rule(f"r{i}", "", "") for i in range(4)))
    patterns = [([rng.choice([-1, 0, 1, 1]) for _ in range(4)], rng.randrange(1, 200)) for _ in range(40)]
    df = sp.createDataFrame([(*v, n) for v, n in patterns], ", ".join(f"v_r{i} int" for i in range(4)) + ", n long")
    model = quality.fit(df, p)
    good, a, b, post = em_by_hand(patterns, p)
    assert model.good == pytest.approx(good) and model.right_good == pytest.approx(a) and model.right_bad == pytest.approx(b)
    got = df.withColumn("q", model.posterior()).collect()
    assert [r.q for r in got] == pytest.approx([post(list(r)[:4]) for r in got])


def test_em_recovers_planted_accuracies(sp):
    rng, counts = random.Random(3), Counter()
    right = {"good": [0.98, 0.95, 0.99, 0.97], "bad": [0.9, 0.7, 0.8, 0.6]}
    for _ in range(20_000):
        k = "good" if rng.random() < 0.75 else "bad"
        counts[tuple((1 if (rng.random() < x) == (k == "good") else -1) if rng.random() < 0.8 else 0 for x in right[k])] += 1
    df = sp.createDataFrame([(*v, n) for v, n in counts.items()], ", ".join(f"v_r{i} int" for i in range(4)) + ", n long")
    model = quality.fit(df, quality.Params(rules=tuple(quality.Rule(f"r{i}", "", "") for i in range(4))))
    assert model.good == pytest.approx(0.75, abs=0.03)
    assert list(model.right_bad.values()) == pytest.approx(right["bad"], abs=0.06)


def test_no_python_on_the_main_path(sp, docs):
    plan = quality.judge(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
