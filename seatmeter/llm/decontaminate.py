"""Benchmark items found inside documents: size-partitioned MinHash containment search.

Items (short) are put into geometric size partitions by the number of their
distinct shingles. Per partition a containment MinHash sketch is kept: the
``keys`` shingles of an item with the smallest hash ranks, i.e. a uniform sample of
its set without replacement. A document that holds m of an item's n shingles holds none of
k keys with probability C(n - m, k) / C(n, k). ``keys`` is the least number that
brings this to ``miss`` for all sizes of the partition: 2 for items of 4 to 7 shingles, 4 up
to 15 (both without any miss), 11 at most for large ones. The
document side is not sketched: every shingle of every document is probed, so
the length of a document does not lower recall. A partition is probed with documents only
that have the shingles its smallest item needs. Candidates are verified by
exact containment of the full shingle sets in the same task.

Items are the stated query set and are taken in blocks of bounded size; each
block is broadcast and all documents are read once per block. No shuffle is
needed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .minhash import shingle_sets


@dataclass(frozen=True)
class Params:
    shingle: int = 5               # words per shingle
    percent: int = 80              # report when 100 * shared >= percent * item shingles
    miss: float = 1e-7             # accepted probability that a matching pair has no key in common
    block_words: int = 2_000_000   # words of items per broadcast block


PAIRS = ("doc_id long, item_id long, size_partition int, item_shingles long, shared_shingles long, "
         "containment double")


def sketch_size(sizes: set[tuple[int, int]], miss: float) -> int:
    """Keys that a partition's items keep: the fewest with which a document that shares ``need`` of ``size`` shingles
    has none of the keys with probability ``miss`` at most, for all (size, need)."""
    k = 1
    while any(math.comb(n - need, k) > miss * math.comb(n, k) for n, need in sizes):
        k += 1
    return k


class Items:
    """One block of items, ready for probing."""

    def __init__(self, rows: list[tuple[int, np.ndarray]], p: Params):
        rows = [r for r in rows if len(r[1])]
        self.ids = [r[0] for r in rows]
        self.sets = [r[1] for r in rows]
        size = np.array([len(s) for s in self.sets], dtype=np.int64)
        self.size = size
        # partition k holds the sizes 2^k .. 2^(k+1) - 1
        self.partition = np.array([int(s).bit_length() - 1 for s in size], dtype=np.int64)
        self.need = -(-size * p.percent // 100)        # shingles a document must share
        keys, owner = [], []
        self.least = np.zeros(len(size), dtype=np.int64)    # shingles that a document must have for the item's partition
        for part in np.unique(self.partition):
            inside = self.partition == part
            k = sketch_size(set(zip(size[inside].tolist(), self.need[inside].tolist())), p.miss)
            self.least[inside] = self.need[inside].min()
            for i in np.flatnonzero(inside):
                ranked = self.sets[i][np.argsort(tx.mix(self.sets[i]))[:k]]
                keys.append(ranked)
                owner.append(np.full(len(ranked), i))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], owner[order]
        self.seen = np.zeros(1 << 20, dtype=bool)       # quick no: top 20 bits of each key
        self.seen[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def match(self, shingles: np.ndarray, first: np.ndarray, p: Params):
        """(document, item, shared) of every verified pair."""
        at = np.flatnonzero(self.seen[(shingles >> np.uint64(44)).astype(np.int64)])
        lo = np.searchsorted(self.keys, shingles[at], side="left")
        hi = np.searchsorted(self.keys, shingles[at], side="right")
        hit = hi > lo
        at, lo, hi = at[hit], lo[hit], hi[hit]
        doc = np.searchsorted(first, at, side="right") - 1
        size = np.diff(first)
        found = {(int(d), int(i)) for d, a, b in zip(doc, lo, hi) for i in self.owner[a:b] if size[d] >= self.least[i]}
        own: dict[int, np.ndarray] = {}
        for d, i in sorted(found):
            a, b = first[d], first[d + 1]
            if b - a < self.need[i]:
                continue
            if d not in own:
                own = {d: np.unique(shingles[a:b])}
            pos = np.searchsorted(own[d], self.sets[i])
            pos[pos == len(own[d])] = 0
            shared = int((own[d][pos] == self.sets[i]).sum())
            if 100 * shared >= p.percent * self.size[i]:
                yield d, i, shared


def _probe(batches: Iterator[pa.RecordBatch], items, p: Params) -> Iterator[pa.RecordBatch]:
    block: Items = items.value
    for batch in batches:
        for rows, data, offsets in tx.runs(batch, "text"):
            shingles, first = tx.Words(tx.lowered(data), offsets).shingles(p.shingle)
            found = list(block.match(shingles, first, p))
            if found:
                d, i, shared = (np.array(x, dtype=np.int64) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(d)), pa.array([block.ids[x] for x in i], pa.int64()),
                     pa.array(block.partition[i].astype(np.int32)), pa.array(block.size[i]), pa.array(shared),
                     pa.array(shared / block.size[i])],
                    ["doc_id", "item_id", "size_partition", "item_shingles", "shared_shingles", "containment"])


def _drop(batches: Iterator[pa.RecordBatch], items, p: Params) -> Iterator[pa.RecordBatch]:
    block: Items = items.value
    for batch in batches:
        for rows, data, offsets in tx.runs(batch, "text"):
            shingles, first = tx.Words(tx.lowered(data), offsets).shingles(p.shingle)
            clean = np.ones(rows.num_rows, dtype=bool)
            clean[[d for d, _, _ in block.match(shingles, first, p)]] = False
            yield rows.filter(pa.array(clean))
    tx.trim()


def _item_blocks(benchmark: DataFrame, params: Params) -> Iterator[Items]:
    """The distinct items in blocks of about ``block_words`` words."""
    queries = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                               F.col("text").cast("string").alias("text")).filter("length(text) > 0").distinct()
    words = queries.agg(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")))).first()[0] or 0
    blocks = max(1, math.ceil(words / params.block_words))
    for k in range(blocks):
        rows = [(r.item_id, r.text) for r in queries.filter(F.expr(f"pmod(xxhash64(item_id, text), {blocks}) = {k}"))
                .toLocalIterator()]
        elements, first = shingle_sets(*tx.utf8(pa.array([t for _, t in rows], pa.large_string())), params.shingle)
        yield Items([(i, elements[a:b]) for (i, _), a, b in zip(rows, first[:-1], first[1:])], params)


def find_benchmark_items(docs: DataFrame, benchmark: DataFrame, params: Params = Params()) -> DataFrame:
    """Pairs of a document and a benchmark item whose shingles it holds to ``percent`` or more.

    docs: doc_id, text; benchmark: item_id, text; further columns are ignored. Words are
    ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; an item with fewer words than a shingle is one
    shingle, its whole word sequence, and matches documents of just these words. A null or empty
    text on either side matches nothing. Repeated items count once, repeated documents give
    their pairs again; a null doc_id or item_id is carried as it is. Without items or documents
    the result is empty.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for items in _item_blocks(benchmark, params):
        found = base.mapInArrow(partial(_probe, items=spark.sparkContext.broadcast(items), p=params), PAIRS)
        out = found if out is None else out.unionAll(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, params: Params = Params()) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns; no shuffle."""
    out = docs
    for items in _item_blocks(benchmark, params):
        out = out.mapInArrow(partial(_drop, items=docs.sparkSession.sparkContext.broadcast(items), p=params), docs.schema)
    return out
