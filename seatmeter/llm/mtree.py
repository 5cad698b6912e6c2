"""Exact top-k search by inner product in a paged M-tree.

The tree has three levels, all of metric nodes (router, covering radius, distance
to the parent's router):

1. The root page holds at most ``Params.pivots`` routers, spread over a bounded
   sample by farthest-first choice. Every row hangs below its nearest one.
2. The rows of a root entry are dealt into shelves of about ``shelf_rows`` rows
   each, however many there are, so a crowd of equal vectors has many shelves.
3. A shelf is bulk loaded in one task: farthest-first routers, each with leaf
   pages of at most ``page_rows`` objects ordered by their distance to it.

The metric is Euclidean; scores are inner products. With D the query's distance
to a router, t an object's stored distance to it, and |q|, |o| the norms,
    q.o <= q.router + |q| t      and      q.o <= (|q|^2 + |o|^2 - (D - t)^2) / 2
(the second is the triangle inequality); a node's bound takes its covering
radius for t. A query first searches one shelf of its nearest root entry, which
gives a score that k objects reach; it is then sent to the shelves of those root
entries whose bound does not fall short of it. Inside a shelf it goes through
the leaf pages best bound first and stops at the first one that cannot matter.
Stored distances spare most products; no row is left out that could count.

Queries meet shelves in groups of bounded size on both sides: pages of one shelf,
and at most about ``query_rows`` of the queries sent there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .store import Store
from .text import trim

ROOT_BYTES = 8 << 20          # of the root page, which goes to every task
SAMPLE_BYTES = 32 << 20       # of the sample, which goes to the driver


@dataclass(frozen=True)
class Params:
    k: int = 10
    scale: int = 1024             # components are floor(scale * x)
    every: int = 100              # queries are the rows whose id this divides
    pivots: int = 256             # most entries of the root page
    sample_rows: int = 8192       # rows that the root's routers are chosen from
    shelf_rows: int = 8192        # rows of a shelf, about
    page_rows: int = 64           # most objects of a leaf page
    query_rows: int = 8192        # queries that meet a shelf in one group, about


# ---------------------------------------------------------------- exact products and distances

class Space:
    """Products of integer vectors, exact at any magnitude; results beyond 64 bits are cut to their range."""

    def __init__(self, dim: int, largest: int):
        most = dim * max(largest, 1) ** 2
        self.exact_float = most < 1 << 53
        self.kind = np.float64 if self.exact_float else np.int64 if most < 1 << 62 else object

    def matrix(self, rows: np.ndarray) -> np.ndarray:
        return rows.astype(self.kind)

    def dot(self, rows: np.ndarray, v: np.ndarray) -> np.ndarray:
        out = rows @ v
        return np.clip(out, -(1 << 63), (1 << 63) - 1).astype(np.int64) if self.kind is object else out.astype(np.int64)

    def norm(self, rows: np.ndarray) -> np.ndarray:
        real = rows.astype(np.float64)
        return np.sqrt(np.einsum("ij,ij->i", real, real))

    @staticmethod
    def distance(rows: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Distances of float rows to a float vector."""
        apart = rows - v
        return np.sqrt(np.einsum("ij,ij->i", apart, apart))


def spread(real: np.ndarray, most: int) -> np.ndarray:
    """Farthest-first choice of at most ``most`` different rows; the first is row 0."""
    if not len(real):
        return np.zeros(0, np.int64)
    chosen, near = [0], Space.distance(real, real[0])
    while len(chosen) < most and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, Space.distance(real, real[chosen[-1]]))
    return np.array(chosen)


def nearest(real: np.ndarray, routers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and distance to each row's nearest router (ties: the first)."""
    at, best = np.zeros(len(real), np.int64), np.full(len(real), np.inf)
    for i, r in enumerate(routers):
        d = Space.distance(real, r)
        closer = d < best
        at[closer], best[closer] = i, d[closer]
    return at, best


def bound(space: Space, product, q_norm, distance, near, far, top_norm):
    """Largest inner product with objects whose distance to the router lies in near .. far.

    Rounding is covered by a margin; a node of radius 0 has its router's product itself.
    """
    gap = np.maximum(0.0, np.maximum(distance - far, near - distance))
    square = q_norm * q_norm + top_norm * top_norm
    loose = np.minimum(product + q_norm * far, (square - gap * gap) / 2) + 1e-9 * (square + q_norm * far) + 1e-6
    return np.where(far > 0, loose, product) if space.exact_float else loose


# ---------------------------------------------------------------- building

def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), dim)


def _assign(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """uid, vec_id, v -> and pivot, distance to it."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at, far = nearest(_vectors(batch.column(2), pivots.shape[1]).astype(np.float64), pivots)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int32)), pa.array(far)],
                                         ["uid", "vec_id", "v", "pivot", "away"])


PAGES = ("pivot int, shelf long, router array<long>, away double, far double, top_norm double, "
         "ids array<long>, objects array<long>, parts array<double>")


def _lists(values: np.ndarray, ends: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.array([0, *ends], dtype=np.int32)), pa.array(values))


def _load(table: pa.Table, params: Params, pivots: np.ndarray) -> pa.Table:
    """The leaf pages of one shelf (rows: uid, vec_id, v, pivot, away, shelf)."""
    dim = pivots.shape[1]
    table = table.sort_by([("vec_id", "ascending"), ("uid", "ascending")])
    ids, rows = table["vec_id"].to_numpy(), _vectors(table["v"], dim)
    pivot, real = table["pivot"][0].as_py(), rows.astype(np.float64)
    chosen = spread(real, -(-2 * len(ids) // params.page_rows))
    at, near = nearest(real, real[chosen])
    order = np.lexsort((ids, near, at))
    ids, rows, at, near, norm = ids[order], rows[order], at[order], near[order], Space(dim, 1).norm(real[order])
    first = np.searchsorted(at, np.arange(len(chosen) + 1))
    cuts = [a for s, e in zip(first[:-1], first[1:]) for a in range(s, e, params.page_rows)]
    spans = list(zip(cuts, [*cuts[1:], len(ids)]))
    routers = chosen[at[cuts]]
    apart = Space.distance(real[routers], pivots[pivot])
    ends = [e for _, e in spans]
    return pa.table({
        "pivot": pa.array([pivot] * len(spans), pa.int32()), "shelf": pa.array([table["shelf"][0].as_py()] * len(spans), pa.int64()),
        "router": _lists(_vectors(table["v"], dim)[routers].reshape(-1), [dim * (i + 1) for i in range(len(spans))]),
        "away": pa.array(apart), "far": pa.array([near[e - 1] for e in ends]), "top_norm": pa.array([norm[s:e].max() for s, e in spans]),
        "ids": _lists(ids, ends), "objects": _lists(rows.reshape(-1), [dim * e for e in ends]), "parts": _lists(near, ends)})


# ---------------------------------------------------------------- searching

class Shelf:
    """The pages of one shelf, ready for queries."""

    def __init__(self, pages: pa.Table, space: Space, pivot: np.ndarray):
        dim = len(pivot)
        self.space, self.pivot = space, pivot
        raw = _vectors(pages["router"], dim)
        self.routers, self.real = space.matrix(raw), raw.astype(np.float64)
        self.away, self.far, self.top = (pages[c].to_numpy() for c in ("away", "far", "top_norm"))
        ids = pages["ids"].combine_chunks()
        self.first = ids.offsets.to_numpy().astype(np.int64) - ids.offsets[0].as_py()
        self.ids, self.parts = ids.flatten().to_numpy(), pages["parts"].combine_chunks().flatten().to_numpy()
        objects = pages["objects"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        self.objects, self.norms = space.matrix(objects), space.norm(objects)
        self.products = 0             # computed so far

    def search(self, query: np.ndarray, own: int, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of up to k best objects but those of id ``own``; ones below ``floor`` may be left out."""
        q, space = query.astype(np.float64), self.space
        exact = space.matrix(query[None])[0]
        q_norm = float(space.norm(query[None])[0])
        ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        # the stored distances of routers and query to the shelf's pivot spare products with far routers
        to_pivot = float(Space.distance(self.pivot[None], q)[0])
        quick = bound(space, np.inf, q_norm, to_pivot, np.maximum(0.0, self.away - self.far), self.away + self.far, self.top) \
            if np.isfinite(floor) else np.full(len(self.far), np.inf)
        live = np.flatnonzero(~(quick < floor))
        if not len(live):
            return ids, scores
        product = space.dot(self.routers[live], exact).astype(np.float64)
        apart = Space.distance(self.real[live], q)
        self.products += len(live)
        best = bound(space, product, q_norm, apart, np.zeros(len(live)), self.far[live], self.top[live])
        queue = np.argsort(-best, kind="stable")
        at, step = 0, 1
        while at < len(queue):
            pages = queue[at: at + step]
            pages = pages[~(best[pages] < floor)]
            if not len(pages):
                break
            at, step = at + step, min(2 * step, 32)
            spans = [np.arange(self.first[live[p]], self.first[live[p] + 1]) for p in pages]
            rows, page = np.concatenate(spans), np.repeat(pages, [len(s) for s in spans])
            part = self.parts[rows]
            can = ~(bound(space, product[page], q_norm, apart[page], part, part, self.norms[rows]) < floor)
            rows = rows[can & (self.ids[rows] != own)]
            if not len(rows):
                continue
            got = space.dot(self.objects[rows], exact)
            self.products += len(rows)
            ids, scores = np.concatenate([ids, self.ids[rows]]), np.concatenate([scores, got])
            top = np.lexsort((ids, -scores.astype(object) if space.kind is object else -scores))[:k]
            ids, scores = ids[top], scores[top]
            if len(scores) == k:
                floor = max(floor, float(scores[-1]) if space.exact_float else float(scores[-1]) * (1 - 1e-12 * np.sign(float(scores[-1]))))
        return ids, scores


FOUND = "uid long, query_id long, vec_id long, score long"


def _search(pages: pa.Table, queries: pa.Table, params: Params, space: Space, pivots: np.ndarray) -> pa.Table:
    """One shelf against one group of queries (uid, vec_id, v, floor)."""
    out = [], [], [], []
    if pages.num_rows and queries.num_rows:
        shelf = Shelf(pages, space, pivots[pages["pivot"][0].as_py()])
        rows = _vectors(queries["v"], pivots.shape[1])
        for i, (uid, own, floor) in enumerate(zip(*(queries[c].to_pylist() for c in ("uid", "vec_id", "floor")))):
            ids, scores = shelf.search(rows[i], own, params.k, -np.inf if floor is None else float(floor))
            for column, values in zip(out, (np.full(len(ids), uid), np.full(len(ids), own), ids, scores)):
                column.append(values)
    return pa.table({n: pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64())
                     for n, c in zip(("uid", "query_id", "vec_id", "score"), out)})


def _route(batches: Iterator[pa.RecordBatch], space: Space, pivots: np.ndarray, far: np.ndarray, top: np.ndarray) -> Iterator[pa.RecordBatch]:
    """uid, vec_id, v, floor -> and the root entries whose bound does not fall short of the floor."""
    exact = space.matrix(pivots.astype(np.int64))
    for batch in batches:
        rows, lists = _vectors(batch.column(2), pivots.shape[1]), []
        norms = space.norm(rows)
        for i, floor in enumerate(batch.column(3).to_pylist()):
            product = space.dot(exact, space.matrix(rows[i][None])[0]).astype(np.float64)
            apart = Space.distance(pivots, rows[i].astype(np.float64))
            best = bound(space, product, norms[i], apart, np.zeros(len(pivots)), far, top)
            lists.append(np.flatnonzero(~(best < (-np.inf if floor is None else float(floor)))))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))],
                                         ["uid", "vec_id", "v", "floor", "entries"])


def _meet(pages: DataFrame, sent: DataFrame, params: Params, space: Space, pivots: np.ndarray) -> DataFrame:
    """Results of queries (uid, vec_id, v, floor, pivot, shelf) in the shelves they are sent to."""
    key = ["pivot", "shelf"]
    groups = sent.groupBy(*key).agg(F.ceil(F.count("*") / params.query_rows).cast("long").alias("groups"))
    left = pages.join(groups, key).withColumn("part", F.explode(F.expr("sequence(0L, groups - 1)"))).drop("groups")
    right = sent.join(groups, key).withColumn("part", F.pmod(F.xxhash64("uid", F.lit(3)), F.col("groups"))).drop("groups")
    key = [*key, "part"]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        return _search(left, right, params, space, pivots)

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, FOUND)


def top_k(table: DataFrame, params: Params = Params(), store: Store | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of every query by integer inner product.

    table: vec_id long, embedding array of numbers, any further columns. Rows without vec_id, without embedding, or
    with a component null or not finite take no part. Components are floor(scale * x) (cut to 64 bits, as are scores);
    where lengths differ, a missing component counts as 0. Every row counts: a repeated one is found, and asks, each
    time. A query leaves out all rows of its own id; ties go to the smaller vec_id. An empty table gives no rows.
    """
    spark = table.sparkSession
    st = store or Store(spark, "mtree")
    base = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    base = base.filter("vec_id is not null and e is not null and not exists(e, x -> x is null or isnan(x) or abs(x) = double('inf'))")
    base = base.select("vec_id", F.transform("e", lambda x: F.floor(F.lit(float(params.scale)) * x).cast("long")).alias("v"))
    held = base.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"),
                    F.max(F.array_max("v")).alias("high"), F.min(F.array_min("v")).alias("low")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not held.n:
        return empty
    dim = max(1, held.dim)
    space = Space(dim, max(held.high or 0, -(held.low or 0)))
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("v")))
    base = base.select(F.monotonically_increasing_id().alias("uid"), "vec_id", padded.alias("v"))
    sample = max(1, min(params.sample_rows, SAMPLE_BYTES // (8 * dim)))
    # rows of the smallest hashes; all but about four times as many are left out beforehand, so that no task sends a sample of its own
    drawn = F.pmod(F.xxhash64("uid", F.lit(17)), F.lit(1 << 40))
    few = base.withColumn("_h", drawn).filter(F.col("_h") <= int(min(1.0, 4 * sample / held.n) * (1 << 40)))
    rows = few.orderBy("_h", "uid").limit(sample).select("v").collect()
    real = np.array([r.v for r in rows], dtype=np.int64).astype(np.float64)
    most = max(1, min(params.pivots, ROOT_BYTES // (8 * dim), -(-held.n // max(1, params.shelf_rows // 4))))
    pivots = real[spread(real, most)]
    hung = st.put("rows", base.mapInArrow(partial(_assign, pivots=pivots), "uid long, vec_id long, v array<long>, pivot int, away double"))
    # the root page: covering radius, largest norm and number of shelves of each of its entries
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    entries = hung.groupBy("pivot").agg(F.count("*").alias("n"), F.max("away").alias("far"), F.max(F.sqrt(square)).alias("top")).collect()
    far, top, shelves = np.zeros(len(pivots)), np.zeros(len(pivots)), [1] * len(pivots)
    for e in entries:
        far[e.pivot], top[e.pivot], shelves[e.pivot] = e.far, e.top * (1 + 1e-12), -(-e.n // params.shelf_rows)
    n_shelves = F.element_at(F.array(*[F.lit(s) for s in shelves]), F.col("pivot") + 1).cast("long")
    placed = hung.withColumn("shelf", F.pmod(F.xxhash64("uid"), n_shelves))

    def load(rows: pa.Table) -> pa.Table:
        return _load(rows, params, pivots)

    pages = st.put("pages", placed.groupBy("pivot", "shelf").applyInArrow(load, PAGES))
    queries = placed.filter(F.col("vec_id") % params.every == 0).select("uid", "vec_id", "v", "pivot", "shelf")
    home = st.put("home", _meet(pages, queries.withColumn("floor", F.lit(None).cast("long")), params, space, pivots))
    floors = home.groupBy("uid").agg(F.when(F.count("*") >= params.k, F.min("score")).alias("floor"))
    known = queries.join(floors, "uid", "left")
    routed = known.select("uid", "vec_id", "v", "floor").mapInArrow(
        partial(_route, space=space, pivots=pivots, far=far, top=top), "uid long, vec_id long, v array<long>, floor long, entries array<int>")
    sent = routed.withColumn("pivot", F.explode("entries")).drop("entries")
    sent = sent.withColumn("shelf", F.explode(F.sequence(F.lit(0).cast("long"), n_shelves - 1)))
    sent = st.put("sent", sent.join(queries.select("uid", "pivot", "shelf"), ["uid", "pivot", "shelf"], "left_anti"))
    rest = st.put("rest", _meet(pages, sent, params, space, pivots))
    st.drop("rows", "pages", "sent")
    place = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    return (home.unionAll(rest).withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= params.k)
            .select("query_id", "rank", "vec_id", "score"))
