import math

import numpy as np
import pyarrow as pa
import pytest

from seatmeter.llm import mtree
from seatmeter.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k=10, every=100, scale=1024):
    def whole(x):
        return max(-(1 << 63), min((1 << 63) - 1, math.floor(scale * x)))
    ok = [(i, [whole(x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i % every:
            continue
        scores = sorted((-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(q, v)))), j) for j, v in ok if j != i)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def run(df, **kw):
    return sorted(tuple(r) for r in mtree.top_k(df, mtree.Params(**kw)).collect())


def test_table(sp):
    sf = "/root/testdata/sf0.001"
    rows = [(r[0], r[1]) for r in sp.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(tuple(r) for r in QUERIES["op13_exact_top_k"](sp, sf).collect()) == brute(rows)


@pytest.mark.parametrize("params", [{}, {"pivots": 5, "shelf_rows": 16, "page_rows": 4, "query_rows": 2}, {"k": 3, "every": 7, "shelf_rows": 40, "page_rows": 8}])
def test_edges(frame, params):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 6).tolist()) for i in range(1, 150)]
    same = rng.normal(0, 1, 6).tolist()
    rows += [(1000 + i, same) for i in range(100)]                       # a crowd of equal vectors, queries among them
    rows += [(0, [0.0] * 6), (-100, [-0.0003] * 6), (200, [1.0]), (300, []), (400, None), (None, same)]
    rows += [(500, [1.0, None]), (600, [float("nan")] * 6), (700, [float("inf")] * 6), (1000, same), (201, [1.0])]
    want = brute(rows, **{k: v for k, v in params.items() if k in ("k", "every")})
    assert run(frame(rows, SCHEMA), **params) == want
    assert run(frame([], SCHEMA), **params) == []
    assert run(frame([(100, [1.0])], SCHEMA), **params) == []


@pytest.mark.parametrize("size", [2e3, 1e6, 1e12, 1e300])
def test_large_components(frame, size):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, size, 4)).tolist()) for i in range(0, 60)]
    assert run(frame(rows, SCHEMA), every=10, shelf_rows=16, page_rows=4) == brute(rows, every=10)


def test_stored_distances_spare_products():
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 1024, (40, 16))
    rows = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 60, (4000, 16))).astype(np.int64)
    pivots = rows[:1].astype(np.float64)
    table = pa.table({"uid": np.arange(4000), "vec_id": np.arange(4000), "v": pa.array(rows.tolist()), "pivot": pa.array([0] * 4000, pa.int32()),
                      "away": mtree.Space.distance(rows.astype(float), pivots[0]), "shelf": np.zeros(4000, np.int64)})
    pages = mtree._load(table, mtree.Params(), pivots)
    shelf = mtree.Shelf(pages, mtree.Space(16, int(abs(rows).max())), pivots[0])
    for i in range(0, 4000, 200):
        ids, scores = shelf.search(rows[i], i, 10, -np.inf)
        want = sorted((-int(rows[j] @ rows[i]), j) for j in range(4000) if j != i)[:10]
        assert list(zip((-scores).tolist(), ids.tolist())) == want
    assert shelf.products < 0.25 * 20 * 4000
    assert max(len(x) for x in pages["ids"].to_pylist()) <= 64
