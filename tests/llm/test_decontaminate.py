import math
import re

from seatmeter.llm import decontaminate as dc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(UP))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, items):
    sets = {(i, frozenset(shingles(t))) for i, t in items}
    out = []
    for d, t in docs:
        own = shingles(t)
        for i, s in sets:
            if s and 100 * len(s & own) >= 80 * len(s):
                out.append((d, i, len(s), len(s & own)))
    return sorted(out, key=str)


def run(docs, items, **kw):
    return sorted(((r.doc_id, r.item_id, r.item_shingles, r.shared_shingles)
                   for r in dc.find_benchmark_items(docs, items, dc.Params(**kw)).collect()), key=str)


def test_table_in_one_and_in_many_blocks(sp, docs):
    bench = sp.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert want and run(docs, bench) == want
    assert run(docs, bench, block_words=400) == want


def test_edge_rows(sp, frame):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(1, item.upper()), (2, "x " * 30_000 + item + " y" * 30_000), (3, "one two three four five six seven eight nine ten"),
            (4, "one two three four five six seven eight nine"), (5, None), (6, ""), (7, "two words"), (8, "two words more"), (1, item), (None, item),
            (9, " ".join(f"w{i}" for i in range(1000)))]
    items = [(1, item), (1, item), (2, None), (3, ""), (4, "two words"), (None, "w1 w2 w3 w4 w5 w6"), (5, " ".join(f"w{i}" for i in range(400)))]
    got = run(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert got == want and (3, 1, 8, 6) not in got and (2, 1, 8, 8) in got and (7, 4, 1, 1) in got


def test_empty_tables(sp, frame):
    some, none = [(1, "a b c d e f")], []
    for d, i in ((some, none), (none, some), (none, none)):
        assert run(frame(d, "doc_id long, text string"), frame(i, "item_id long, text string")) == []


def test_partitions_decide_the_keys():
    sizes = lambda lo, hi: {(n, -(-n * 80 // 100)) for n in range(lo, hi)}
    got = [dc.sketch_size(sizes(2**k, 2 ** (k + 1)), 1e-7) for k in range(12)]
    assert got[:4] == [1, 1, 2, 4] and got == sorted(got) and got[-1] <= 11
    for n, need in ((7, 6), (15, 12), (63, 51)):
        k = dc.sketch_size({(n, need)}, 1e-7)
        assert math.comb(n - need, k) <= 1e-7 * math.comb(n, k) and (k == 1 or math.comb(n - need, k - 1) > 1e-7 * math.comb(n, k - 1))
