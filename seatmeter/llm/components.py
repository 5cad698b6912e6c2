"""Connected components of an undirected graph given as an edge table.

Each task first folds its own edges with a union-find forest (at most one edge
per node leaves it). The forests are then merged by alternating large-star and
small-star steps (Kiveris et al., 2014), which need only grouped minima and
equi-joins; each step's edges are written to the shared folder. No node list,
neighbourhood or component is ever gathered in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Store

EDGES = "u long, v long"


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one task's edges; yields (u, v) with u the root, the smaller id."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(root(x), x) for x in parent if root(x) != x]
    for i in range(0, len(pairs), 1 << 16):
        part = np.array(pairs[i: i + (1 << 16)], dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(part[:, 0]), pa.array(part[:, 1])], ["u", "v"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: hang neighbours on the smallest id of each neighbourhood.

    large: the larger neighbours of each node; small: each node with its smaller neighbours.
    Edges come with u < v, so a node's smaller neighbours are the u of its edges (v, u).
    """
    if large:
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        out = edges.join(low, "u").select(F.col("low").alias("u"), "v")
    else:
        low = edges.groupBy("v").agg(F.min("u").alias("low"))
        near = edges.join(low, "v").select("low", F.explode(F.array("u", "v")).alias("v"))
        out = near.select(F.col("low").alias("u"), "v")
    return out.filter("u < v").distinct()


def components(edges: DataFrame, store: Store, name: str = "cc") -> DataFrame:
    """(node, component) for every node of ``edges`` (u long, v long); component is its smallest node.

    Nulls and self-loops are ignored; repeated edges and an empty table are fine.
    """
    clean = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u < v")
    now = store.put(f"{name}-0", clean.mapInArrow(_forest, EDGES).distinct())
    mark = _mark(now)
    step = 0
    while mark[0]:
        step += 1
        half = store.put(f"{name}-{step}-large", _star(now, True))
        now = store.put(f"{name}-{step}", _star(half, False))
        store.drop(f"{name}-{step - 1}", f"{name}-{step}-large")
        mark, before = _mark(now), mark
        if mark == before:
            break
    # at the fixed point every edge joins a node to the smallest node of its component
    return now.select(F.explode(F.array("u", "v")).alias("node"), F.col("u").alias("component")).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Count and an order-free checksum of an edge table."""
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(u % 1000003)")).first()
    return tuple(row)
