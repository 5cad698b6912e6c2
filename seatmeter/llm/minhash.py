"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find.

1. One pass over the texts gives each document's shingle set (word shingles,
   A-Z lowered), a 128-bit hash of the whole set, its SuperMinHash signature
   (Ertl, 2017) folded into band keys, and a bitmap of the set, wider for larger sets.
2. Documents with equal sets become one class (a grouped minimum). Only class
   representatives go on; copies are never paired.
3. Representatives that share a band key meet in a bucket; the members of buckets
   that hold two or more are written once and used in all rounds. Pairs are dropped by
   two exact bounds: set sizes, and the bitmap's upper bound of the
   intersection. A large bucket is dealt to many tasks as pairs of blocks.
4. Two rounds of proposals (each document's most promising partner outside its
   own component) merge most groups with few pairs; a last round takes every
   remaining pair between different components. So no pair of a bucket is left
   out unless its two documents are already connected by confirmed links.
5. Every proposed pair is confirmed on the full shingle sets, and the links are
   grouped by union-find (``components``). Sets are made of the texts in pairs only. Of a pair
   only the set of the text with more partners is carried to the other one's; where the pairs (two ids each) are few
   enough to be sent to all tasks, no text and no other set is moved.

With 40 bands of 5 ranks a pair at similarity 0.8 shares no band with
probability (1 - 0.8^5)^40 = 1.3e-7.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .components import components
from .store import Store

# words of the bitmap of a set: 16 up to 1,024 elements, 64 up to 4,096, 256 above
WIDTHS = ((1024, 16), (4096, 64), (None, 256))
BLOCK = 512
SENT = 1 << 20            # pairs or ids (16 bytes each) that are sent to all tasks, at most


@dataclass(frozen=True)
class Params:
    shingle: int = 5          # words per shingle
    percent: int = 80         # link when 100 * intersection >= percent * union
    bands: int = 40
    rows: int = 5             # signature components per band

    @property
    def size(self) -> int:
        return self.bands * self.rows


# ---------------------------------------------------------------- signatures

def super_minhash(elements: np.ndarray, first: np.ndarray, size: int, chunk: int = 1 << 15) -> np.ndarray:
    """SuperMinHash signatures of many sets at once.

    elements: 64-bit hashes, set i being elements[first[i]:first[i+1]] (distinct within a set).
    Every element carries a random permutation of 0..size-1; its j-th visited component gets
    rank j plus a random fraction, and a component keeps its minimum. Rank j of all live
    elements is dealt with in one step; a set's elements stop once every component of the set
    holds a value below the next rank, since later values could only be larger. Values are
    fixed point (rank in the upper bits), so that equal draws compare equal.
    An empty set keeps the largest value everywhere.
    """
    n_sets = len(first) - 1
    sig = np.full((n_sets, size), np.iinfo(np.uint64).max, dtype=np.uint64)
    owner_all = np.repeat(np.arange(n_sets), np.diff(first))
    for a in range(0, len(elements), chunk):
        owner, seed = owner_all[a: a + chunk], elements[a: a + chunk]
        lo, hi = int(owner[0]), int(owner[-1]) + 1
        perm = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.uint32), (len(seed), 1))
        live = np.arange(len(seed))
        part = sig[lo:hi]
        for j in range(size):
            # rank j can still lower a component of its set
            worst = part.max(axis=1) >> np.uint64(48)
            live = live[worst[owner[live] - lo] >= j]
            if not len(live):
                break
            draw = tx.mix(seed[live] + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
            swap = j + ((draw >> np.uint64(40)) % np.uint64(size - j)).astype(np.int64)
            slot = perm[live, swap].astype(np.int64)
            perm[live, swap] = perm[live, j]
            value = (np.uint64(j) << np.uint64(48)) | (tx.mix(draw) >> np.uint64(16))
            np.minimum.at(part.reshape(-1), (owner[live] - lo) * size + slot, value)
    return sig


def _fold(values: np.ndarray) -> np.ndarray:
    """Order-sensitive hash along the last axis."""
    h = np.full(values.shape[:-1], values.shape[-1], dtype=np.uint64)
    for j in range(values.shape[-1]):
        h = tx.combine(h, values[..., j])
    return h


def band_keys(sig: np.ndarray, p: Params) -> np.ndarray:
    keys = _fold(sig.reshape(len(sig), p.bands, p.rows))
    return tx.combine(keys, np.broadcast_to(np.arange(p.bands, dtype=np.uint64), keys.shape))


def widths(size: np.ndarray) -> np.ndarray:
    """Bitmap words of sets by their size; it never falls with the size."""
    out = np.full(len(size), WIDTHS[-1][1], dtype=np.int64)
    for most, words in reversed(WIDTHS[:-1]):
        out[size <= most] = words
    return out


def bitmaps(elements: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One bit per element at (hash mod bits): two sets differ at least where their bits do. (words, offsets)"""
    words = widths(np.diff(first))
    offsets = np.concatenate([[0], np.cumsum(words)])
    out = np.zeros(offsets[-1], dtype=np.uint64)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = (elements >> np.uint64(20)).astype(np.int64) & (words[owner] * 64 - 1)
    np.bitwise_or.at(out, offsets[owner] + (at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
    return out, offsets


def folded(words: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps of ``width`` words or more, brought to that width: bits mod a power of two stay bits mod a smaller one."""
    out = np.zeros((len(offsets) - 1, width), dtype=np.uint64)
    size = np.diff(offsets)
    for have in np.unique(size):
        rows = np.flatnonzero(size == have)
        held = words[offsets[rows][:, None] + np.arange(have)]
        out[rows] = np.bitwise_or.reduce(held.reshape(len(rows), have // width, width), axis=1)
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document: (elements, first)."""
    h, first = tx.Words(tx.lowered(data), offsets).shingles(k)
    sets = [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:])]
    size = np.array([len(s) for s in sets], dtype=np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(size)])


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _lists(x: np.ndarray) -> pa.Array:
    """Rows of a 2-d array as a list column."""
    offsets = np.arange(0, x.size + 1, x.shape[1] if x.size else 1, dtype=np.int32)[: len(x) + 1]
    return pa.ListArray.from_arrays(pa.array(offsets), _i64(x.reshape(-1)))


SIGNED = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, bitmap array<long>"


def _sign(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in tx.runs(batch, "text"):
            elements, first = shingle_sets(data, offsets, p.shingle)
            size = np.diff(first)
            # the set's own hash: sums of two mixes of its elements (distinct, so order does not matter)
            sums = []
            for salt in (np.uint64(1), np.uint64(2)):
                total = np.concatenate([[np.uint64(0)], np.cumsum(tx.mix(elements ^ tx.mix(np.atleast_1d(salt))))])
                sums.append(tx.mix(total[first[1:]] - total[first[:-1]] + size.astype(np.uint64)))
            keys = band_keys(super_minhash(elements, first, p.size), p)
            bits, ends = bitmaps(elements, first)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(size), _i64(sums[0]), _i64(sums[1]), _lists(keys),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), _i64(bits))],
                ["doc_id", "n_shingles", "set_a", "set_b", "bands", "bitmap"])
    tx.trim()


# ---------------------------------------------------------------- candidate pairs

def _propose(batches: Iterator[pa.RecordBatch], p: Params, every: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of each bucket block that pass the size and bitmap bounds and join two components.

    The task's rows arrive sorted by (bucket, left, right). every: all such pairs, else for each
    document the partner with the best bound.
    """
    held: list[pa.RecordBatch] = []

    def ready(last: bool):
        table = pa.Table.from_batches(held).combine_chunks().to_batches()
        if not table:
            return
        b = table[0]
        key = np.stack([b.column(i).to_numpy() for i in range(3)])
        cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        cuts = [0, *cut.tolist(), b.num_rows]
        held.clear()
        if not last:
            held.append(b.slice(cuts[-2]))
            cuts = cuts[:-1]
        for s, e in zip(cuts[:-1], cuts[1:]):
            if e - s > 1:
                yield from _pairs(b.slice(s, e - s), p, every)

    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= 1 << 14:
            yield from _pack(ready(False))
            rows = sum(h.num_rows for h in held)
    if held:
        yield from _pack(ready(True))


def _pack(pairs) -> Iterator[pa.RecordBatch]:
    found = list(pairs)
    if found:
        u, v = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _pairs(b: pa.RecordBatch, p: Params, every: bool):
    left, right, block, node, size, comp = (b.column(i).to_numpy() for i in range(1, 7))
    order = np.argsort(size, kind="stable")
    held = b.column(7).take(pa.array(order))
    words, ends = held.flatten().to_numpy().view(np.uint64), held.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    node, size, comp, block = node[order], size[order], comp[order], block[order]
    width = np.diff(ends)
    # by size, a row's partners have its width or more: bitmaps of the rows from each width on, at that width
    from_ = {w: int(np.searchsorted(width, w)) for w in np.unique(width).tolist()}
    maps = {w: folded(words, ends[at:], w) for w, at in from_.items()}
    same = left[0] == right[0]
    # partners of row i: larger rows j > i with 100 * size_i >= percent * size_j
    reach = np.searchsorted(size * p.percent, size * 100, side="right")
    for i in range(len(node) - 1):
        j = np.arange(i + 1, max(reach[i], i + 1))
        j = j[comp[j] != comp[i]] if same else j[(comp[j] != comp[i]) & (block[j] != block[i])]
        if not len(j):
            continue
        bits, at = maps[int(width[i])], from_[int(width[i])]
        mine = np.bitwise_count(bits[i - at] & ~bits[j - at]).sum(axis=1, dtype=np.int64)
        theirs = np.bitwise_count(bits[j - at] & ~bits[i - at]).sum(axis=1, dtype=np.int64)
        inter = np.minimum(size[i] - mine, size[j] - theirs)
        j_ok = 100 * inter >= p.percent * (size[i] + size[j] - inter)
        if j_ok.any():
            j, inter = j[j_ok], inter[j_ok]
            if not every:
                # fewest differing elements by the bound; then the smallest id
                best = np.lexsort((node[j], size[j] - 2 * inter))[:1]
                j = j[best]
            yield np.minimum(node[i], node[j]), np.maximum(node[i], node[j])


def _buckets(reps: DataFrame) -> DataFrame:
    """(bucket, blocks, node) of all buckets with two or more representatives; blocks: of at most BLOCK of them, about."""
    rows = reps.select(F.explode("bands").alias("bucket"), "node")
    shared = (rows.groupBy("bucket").agg(F.count("*").alias("held")).filter("held > 1")
              .select("bucket", F.ceil(F.col("held") / BLOCK).cast("int").alias("blocks")))
    return rows.join(shared, "bucket").select("bucket", "blocks", "node")


def _members(buckets: DataFrame, marks: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Bucket rows (bucket, left, right, block, node, size, comp, bitmap) of buckets that still
    hold two components; a bucket of over BLOCK rows is dealt out as pairs of blocks."""
    if comps is None:
        rows = buckets.withColumn("comp", F.col("node"))
    else:
        rows = (buckets.join(comps, "node", "left")
                .withColumn("comp", F.coalesce("component", "node")).drop("component"))
        mixed = rows.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("bucket")
        rows = rows.join(mixed, "bucket")
    rows = rows.withColumn("block", F.expr("cast(pmod(xxhash64(node, 7), blocks) as int)"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = rows.select("bucket", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
                       "block", "node", "comp")
    return (rows.join(marks, "node")
            .select("bucket", "left", "right", "block", "node", "size", "comp", "bitmap"))


def _candidates(buckets: DataFrame, marks: DataFrame, comps: DataFrame | None, p: Params, every: bool) -> DataFrame:
    rows = _members(buckets, marks, comps)
    dealt = rows.repartition("bucket", "left", "right").sortWithinPartitions("bucket", "left", "right", "node")
    return dealt.mapInArrow(partial(_propose, p=p, every=every), "u long, v long").distinct()


# ---------------------------------------------------------------- verification

def _texts_to_sets(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in tx.runs(batch, "text"):
            elements, first = shingle_sets(data, offsets, p.shingle)
            column = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), _i64(elements))
            yield pa.RecordBatch.from_arrays([rows.column(0), column], ["node", "elements"])
    tx.trim()


def _confirm(pairs: DataFrame, sets: DataFrame, p: Params, sent) -> DataFrame:
    """Pairs whose full sets meet the similarity, by exact counts. sent: what to do with tables of as many rows as pairs
    before a join (send them to all tasks, or nothing)."""
    ends = sent(pairs.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count("*").alias("n")))
    # hub: the end with more pairs, whose set is copied; so no set meets many others in one place
    turned = pairs.join(ends.toDF("u", "n_u"), "u").join(ends.toDF("v", "n_v"), "v").select(
        F.when(F.col("n_u") >= F.col("n_v"), F.col("u")).otherwise(F.col("v")).alias("hub"),
        F.when(F.col("n_u") >= F.col("n_v"), F.col("v")).otherwise(F.col("u")).alias("rim"))
    a = sets.select(F.col("node").alias("hub"), F.col("elements").alias("a")).join(sent(turned), "hub")
    b = sets.select(F.col("node").alias("rim"), F.col("elements").alias("b")).join(sent(turned.select("rim").distinct()), "rim", "left_semi")
    return (a.join(b, "rim").withColumn("both", F.size(F.array_intersect("a", "b")))
            .filter(F.expr(f"100 * both >= {p.percent} * (size(a) + size(b) - both)"))
            .select(F.least("hub", "rim").alias("u"), F.greatest("hub", "rim").alias("v")))


# ---------------------------------------------------------------- the operator

def near_duplicates(docs: DataFrame, params: Params = Params(), store: Store | None = None) -> DataFrame:
    """Groups of near-duplicate documents.

    docs: doc_id long, text string, any further columns. Returns one row per input row:
    doc_id, n_shingles (set size), component_id (smallest doc_id reachable over links),
    kept (doc_id = component_id).

    A null or empty text, or one without words, has an empty set and is linked with nothing.
    A row without doc_id is returned with a null component_id and kept = true. Repeated rows
    share a component; rows with one doc_id and several texts are one node. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    p, st = params, store or Store(spark, "near")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = st.put("signed", base.mapInArrow(partial(_sign, p=p), SIGNED))
    # one representative per class of equal sets
    filled = signed.filter("n_shingles > 0 and doc_id is not null")
    reps = st.put("reps", filled.groupBy("set_a", "set_b").agg(
        F.min(F.struct(F.col("doc_id"), F.col("n_shingles"), F.col("bands"), F.col("bitmap"))).alias("r"))
        .select(F.col("r.doc_id").alias("node"), F.col("r.n_shingles").alias("size"), "r.bands", "r.bitmap",
                "set_a", "set_b"))
    lean = st.put("lean", signed.select("doc_id", "n_shingles", "set_a", "set_b"))
    st.drop("signed")
    buckets = st.put("buckets", _buckets(reps))
    inside = buckets.select("node").distinct()
    marks = st.put("marks", reps.select("node", "size", "bitmap").join(F.broadcast(inside) if buckets.count() <= SENT else inside, "node", "left_semi"))
    links = spark.createDataFrame([], "u long, v long")
    comps, tried, sets = None, None, None
    for turn in range(3):
        name = f"pairs-{turn}"
        pairs = _candidates(buckets, marks, comps, p, every=turn == 2)
        if tried is not None:
            pairs = pairs.join(tried, ["u", "v"], "left_anti")
        pairs = st.put(name, pairs)
        n_pairs = pairs.count()
        if not n_pairs:
            if turn == 0:
                break                     # no bucket holds two documents that could match
            continue
        sent = F.broadcast if 2 * n_pairs <= SENT else lambda df: df       # a pair has two ids
        nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
        if sets is not None:
            nodes = nodes.join(sets.select("node").distinct(), "node", "left_anti")
        new = (base.join(sent(nodes.withColumnRenamed("node", "doc_id")), "doc_id", "left_semi")
               .mapInArrow(partial(_texts_to_sets, p=p), "node long, elements array<long>"))
        new = st.put(f"sets-{turn}", new)
        sets = new if sets is None else sets.unionAll(new)
        found = st.put(f"links-{turn}", _confirm(pairs, sets, p, sent).distinct())
        tried = pairs if tried is None else tried.unionAll(pairs)
        if found.isEmpty():
            continue
        links = links.unionAll(found)
        comps = components(links, st, f"cc{turn}")
    st.drop("buckets", "marks", *[f"{kind}-{turn}" for kind in ("sets", "pairs") for turn in range(3)])
    if comps is None:
        comps = spark.createDataFrame([], "node long, component long")
    classes = (reps.join(comps, "node", "left")
               .select("set_a", "set_b", F.coalesce("component", "node").alias("component")))
    ids = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = (lean.join(classes, ["set_a", "set_b"], "left")
           .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, ids).otherwise(F.col("doc_id")).alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, params: Params = Params(), store: Store | None = None) -> DataFrame:
    """The documents of which one of each group stays (the smallest doc_id), with all their columns.

    Of rows that share the staying doc_id one stays; rows without doc_id all stay.
    """
    groups = near_duplicates(docs, params, store)
    stay = groups.filter("kept and doc_id is not null").groupBy("doc_id").agg((F.count("*") > 1).alias("_many"))
    names = [f"`{c}`" for c in docs.columns]
    inner = docs.select(F.col("doc_id").cast("long").alias("_id"), F.struct(*names).alias("_row"))
    held = inner.join(stay.withColumnRenamed("doc_id", "_id"), "_id")
    once = (held.filter("_many").groupBy("_id").agg(F.min_by("_row", F.xxhash64("_row")).alias("_row")).select("_row"))
    return (held.filter("not _many").select("_row").unionAll(once)
            .unionAll(inner.filter("_id is null").select("_row")).select("_row.*"))
