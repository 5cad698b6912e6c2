"""Substring dedup: passages of ``window`` or more words that occur more than once.

An all-against-all search of every document in every shard's index would grow
with the square of the corpus. Instead shards are made by content, so that equal
windows always meet:

1. Documents are packed into blocks of a few MB (words joined by one space) and
   written once; blocks are the unit of all later steps.
2. Every window has a minimizer, the smallest-ranked ``anchor`` -word gram in it
   (leftmost on ties), which depends on the window's words only. A maximal run
   of windows with the same minimizer occurrence is a segment: it holds just
   these windows, and every window is in one segment. A window can occur twice
   only if its minimizer does, so minimizers are counted (grouped sums over all
   documents) and the segments of those that occur once are dropped.
3. Each remaining segment goes to the shard of its minimizer; equal segments of
   a block are sent once. A minimizer with over ``hot`` occurrences is dealt
   out further: its segments are cut into single windows, and each window goes to
   the shard of its own words in two steps. First it meets those of a group of blocks
   (as many groups as the root of the number of blocks), where a window found twice is
   answered at once; then each group sends every distinct window once. So a passage that
   stands in every block is one row per block of a group, and one row per group, in a task.
4. A shard builds a compressed FM-index over its distinct segments
   (entropy-shaped wavelet tree, ``fmindex``), each with the number of its
   copies. The segments are streamed against it by backward search; their
   matching statistics give the intervals of ``window`` words or more that occur
   at least twice.
5. The intervals go back to the blocks, which apply them to all occurrences of
   the segment and cut the words out. Windows are judged on the input.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx
from .fmindex import FMIndex, repeated_intervals
from .store import Store, shuffle_partitions


@dataclass(frozen=True)
class Params:
    window: int = 35               # words
    anchor: int = 8                # words of a minimizer gram (at most ``window``)
    block_bytes: int = 4 << 20     # text of one block
    shard_words: int = 600_000     # words of segments in one shard, about
    hot: int = 2000                # occurrences from which a minimizer's segments are cut into windows


# ---------------------------------------------------------------- blocks

BLOCKS = "ids array<long>, sizes array<long>, body binary"


def _normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every document's words joined by one space: (bytes, bytes per document)."""
    w = tx.Words(data, offsets)
    n = len(w)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(len(offsets) - 1, np.int64)
    last = np.zeros(n, dtype=bool)
    counts = w.counts()
    last[w.first[1:][counts > 0] - 1] = True
    # the bytes of all words, and after each but a document's last the byte that follows it
    inside = tx.IS_WORD[data]
    space = np.zeros(len(data) + 1, dtype=bool)
    space[w.end[~last]] = True
    keep = inside | space[:-1]
    out = data[keep]
    out[space[:-1][keep]] = 0x20
    begin = np.concatenate([[0], np.cumsum(w.end - w.start + ~last)])
    return out, np.diff(begin[w.first])


def _pack_blocks(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    ids: list = []
    sizes: list[np.ndarray] = []
    parts: list[np.ndarray] = []
    held = 0

    def close() -> pa.RecordBatch:
        nonlocal held
        row = pa.RecordBatch.from_arrays(
            [pa.array([list(ids)], pa.list_(pa.int64())), pa.array([np.concatenate(sizes).tolist()], pa.list_(pa.int64())),
             pa.array([press.compress(np.concatenate(parts).tobytes())], pa.binary())], ["ids", "sizes", "body"])
        held = 0
        for x in (ids, sizes, parts):
            x.clear()
        return row

    for batch in batches:
        for rows, data, offsets in tx.runs(batch, "text", p.block_bytes // 4):
            body, size = _normalised(data, offsets)
            if held and held + len(body) > p.block_bytes:
                yield close()
            ids += rows.column(0).to_pylist()
            sizes.append(size)
            parts.append(body)
            held += len(body) + 16 * len(size)
    if ids:
        yield close()


class Block:
    """An unpacked block: its words, and its segments."""

    def __init__(self, ids: list, sizes: np.ndarray, body: bytes, p: Params):
        self.ids, self.p = ids, p
        self.raw = zstandard.ZstdDecompressor().decompress(body) if body else b""
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.words = tx.Words(np.frombuffer(self.raw, np.uint8), offsets)
        self.hash = self.words.hashes()
        self._segments()

    def _segments(self) -> None:
        p, w = self.p, self.words
        counts = w.counts()
        windows = np.maximum(counts - p.window + 1, 0)
        first = np.concatenate([[0], np.cumsum(windows)])
        self.from_word = self.to_word = np.zeros(0, np.int64)     # words from .. to-1 of each segment
        self.key = np.zeros(0, np.uint64)
        if not first[-1]:
            return
        gram = self.hash[: len(self.hash) - p.anchor + 1].copy()
        for j in range(1, p.anchor):
            gram = tx.combine(gram, self.hash[j: len(self.hash) - p.anchor + 1 + j])
        # rank in the upper bits, position in the lower: a plain minimum is the leftmost smallest
        room = np.uint64(max(1, int(len(gram)).bit_length()))
        best = (gram >> room << room) | np.arange(len(gram), dtype=np.uint64)
        reach, width = 1, p.window - p.anchor + 1
        while reach * 2 <= width:
            best = np.minimum(best[:-reach], best[reach:]) if len(best) > reach else best
            reach *= 2
        if reach < width:
            best = np.minimum(best[: len(best) - (width - reach)], best[width - reach:])
        begin = np.arange(first[-1]) - np.repeat(first[:-1], windows) + np.repeat(w.first[:-1], windows)
        place = (best[begin] & ((np.uint64(1) << room) - np.uint64(1))).astype(np.int64)
        new = np.concatenate([[True], place[1:] != place[:-1]])    # documents never share a place
        at = np.flatnonzero(new)
        self.from_word = begin[at]
        self.to_word = begin[np.append(at[1:], len(begin)) - 1] + p.window
        self.key = gram[place[at]]

    def text(self, a: int, b: int) -> bytes:
        """Words a .. b-1 of one document."""
        return self.raw[self.words.start[a]: self.words.end[b - 1]]


def _blocks(table: pa.Table, p: Params) -> Iterator[tuple[int, Block]]:
    for batch in table.to_batches():
        col = lambda c: batch.column(batch.schema.get_field_index(c))
        for i in range(batch.num_rows):
            yield col("block")[i].as_py(), Block(col("ids")[i].as_py(), col("sizes")[i].values.to_numpy(), col("body")[i].as_py(), p)


# ---------------------------------------------------------------- minimizer counts

def _count_keys(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, block in _blocks(pa.Table.from_batches([batch]), p):
            key, n = np.unique(block.key, return_counts=True)
            if len(key):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), number)), pa.array(key.view(np.int64)), pa.array(n)],
                                                 ["block", "key", "n"])


# ---------------------------------------------------------------- segments to shards

SEGMENTS = "shard long, block long, cut boolean, froms array<int>, copies array<int>, sizes array<int>, body binary"


def _send(block_table: pa.Table, keys: pa.Table, p: Params, shards: int) -> pa.Table:
    """One row per (block, shard): the block's distinct segments of that shard, each once."""
    names = [x.split()[0] for x in SEGMENTS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
    press = zstandard.ZstdCompressor(level=3)
    rows: list[tuple] = []
    if keys.num_rows:
        wanted = keys.column("key").to_numpy().view(np.uint64)
        hot = np.sort(wanted[keys.column("hot").to_numpy(zero_copy_only=False).astype(bool)])
        wanted = np.sort(wanted)
        for number, block in _blocks(block_table, p):
            take = np.flatnonzero(_among(block.key, wanted))
            is_hot = _among(block.key[take], hot)
            for cut in (False, True):
                seg = take[is_hot == cut]
                a, b, key = block.from_word[seg], block.to_word[seg], block.key[seg]
                if cut:
                    a, b = _windows(a, b, p.window)
                    key = _hash_of(block.hash, a, p.window)
                shard = (tx.mix(key) % np.uint64(shards)).astype(np.int64)
                rows += _rows_of(block, number, cut, a, b, shard, press)
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types))})


MET = f"{SEGMENTS}, at array<int>, tos array<int>"


def _meet(table: pa.Table, p: Params) -> pa.Table:
    """The cut windows of one shard from one group of blocks: answers for those that occur twice (rows with ``at``),
    and every distinct window once, under the first block that holds it (rows with ``body``)."""
    press, unpress = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
    seen: dict[bytes, list] = {}                              # words -> copies, [(block, first word)]
    shard = table["shard"][0].as_py()
    for batch in table.to_batches():
        col = lambda c: batch.column(batch.schema.get_field_index(c))
        for i in range(batch.num_rows):
            body, at, block = unpress.decompress(col("body")[i].as_py()), 0, col("block")[i].as_py()
            for size, n, first in zip(col("sizes")[i].as_py(), col("copies")[i].as_py(), col("froms")[i].as_py()):
                held = seen.setdefault(body[at: at + size], [0, []])
                held[0] += n
                held[1].append((block, first))
                at += size
    answers: dict[int, list[int]] = {}
    onward: dict[int, list[tuple[int, int, bytes]]] = {}
    for words, (n, places) in seen.items():
        for block, first in places if n > 1 else ():
            answers.setdefault(block, []).append(first)
        onward.setdefault(places[0][0], []).append((places[0][1], min(n, 2), words))
    rows = [(shard, b, True, f, None, None, None, f, [x + p.window for x in f]) for b, f in answers.items()]
    rows += [(shard, b, True, [x[0] for x in w], [x[1] for x in w], [len(x[2]) for x in w], press.compress(b"".join(x[2] for x in w)), None, None)
             for b, w in onward.items()]
    types = [pa.int64(), pa.int64(), pa.bool_(), *[pa.list_(pa.int32())] * 3, pa.binary(), *[pa.list_(pa.int32())] * 2]
    names = [x.split()[0] for x in MET.split(", ")]
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types))})


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def _windows(a: np.ndarray, b: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    n = b - a - window + 1
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
    return start, start + window


def _hash_of(words: np.ndarray, a: np.ndarray, window: int) -> np.ndarray:
    h = np.zeros(len(a), dtype=np.uint64)
    for j in range(window):
        h = tx.combine(h, words[a + j])
    return h


def _rows_of(block: Block, number: int, cut: bool, a: np.ndarray, b: np.ndarray, shard: np.ndarray, press) -> list[tuple]:
    out = []
    order = np.argsort(shard, kind="stable")
    a, b, shard = a[order], b[order], shard[order]
    edges = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
    for s, e in zip(edges[:-1], edges[1:]):
        if s == e:
            continue
        seen: dict[bytes, list[int]] = {}
        for x, y in zip(a[s:e].tolist(), b[s:e].tolist()):
            held = seen.setdefault(block.text(x, y), [x, 0])
            held[1] += 1
        out.append((int(shard[s]), number, cut, [x for x, _ in seen.values()], [min(n, 2) for _, n in seen.values()],
                    [len(t) for t in seen], press.compress(b"".join(seen))))
    return out


# ---------------------------------------------------------------- shards

FOUND = "block long, cut boolean, at array<int>, froms array<int>, tos array<int>"


def _search(table: pa.Table, p: Params) -> pa.Table:
    """Index one shard's segments and report, per sending block, the repeated intervals of each."""
    press = zstandard.ZstdDecompressor()
    number: dict[bytes, int] = {}
    copies: list[int] = []
    sent: list[tuple[int, bool, list[int], list[int]]] = []    # block, cut, first words, segment numbers
    for batch in table.to_batches():
        col = lambda c: batch.column(batch.schema.get_field_index(c))
        for i in range(batch.num_rows):
            body, at, which = press.decompress(col("body")[i].as_py()), 0, []
            for size, n in zip(col("sizes")[i].as_py(), col("copies")[i].as_py()):
                k = number.setdefault(body[at: at + size], len(number))
                at += size
                if k == len(copies):
                    copies.append(0)
                copies[k] += n
                which.append(k)
            sent.append((col("block")[i].as_py(), col("cut")[i].as_py(), col("froms")[i].as_py(), which))
    texts = list(number)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    w = tx.Words(b"".join(texts), offsets)
    alphabet, symbol = np.unique(w.hashes(), return_inverse=True)
    symbol = symbol.astype(np.int64)
    index = FMIndex(symbol, w.first, len(alphabet))
    intervals: dict[int, list[tuple[int, int]]] = {}
    for q, a, b in zip(*(x.tolist() for x in repeated_intervals(index, symbol, w.first, p.window, np.array(copies)))):
        intervals.setdefault(q, []).append((a, b))
    out = []
    for block, cut, firsts, which in sent:
        hit = [(x, x + a, x + b) for x, k in zip(firsts, which) for a, b in intervals.get(k, ())]
        if hit:
            out.append((block, cut, *map(list, zip(*hit))))
    kinds = [pa.int64(), pa.bool_(), *[pa.list_(pa.int32())] * 3]
    return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(("block", "cut", "at", "froms", "tos"), kinds))})


# ---------------------------------------------------------------- cutting

RESULT = "doc_id long, n_words long, n_removed long, kept_text string, removed array<struct<from_word:long,to_word:long>>"


def _cut(block_table: pa.Table, found: pa.Table, p: Params) -> pa.Table:
    pieces = []
    for _, block in _blocks(block_table, p):
        w = block.words
        mark = np.zeros(len(w) + 1, dtype=np.int64)
        for cut in (False, True):
            rows = [r for r in found.to_pylist() if r["cut"] == cut]
            if not rows:
                continue
            parts: dict[bytes, list[tuple[int, int]]] = {}
            whole = np.concatenate([r["at"] for r in rows]).astype(np.int64)
            # the segment that begins with (or, when cut, holds) each reported first word
            seg = np.searchsorted(block.from_word, whole, side="right") - 1
            for r0, s, a, b in zip(whole.tolist(), seg.tolist(), np.concatenate([r["froms"] for r in rows]).tolist(),
                                   np.concatenate([r["tos"] for r in rows]).tolist()):
                end = r0 + p.window if cut else int(block.to_word[s])
                parts.setdefault(block.text(r0, end), []).append((a - r0, b - r0))
            like = np.flatnonzero(_among(block.key, np.unique(block.key[seg])))
            a, b = block.from_word[like], block.to_word[like]
            if cut:
                a, b = _windows(a, b, p.window)
            for x, y in zip(a.tolist(), b.tolist()):
                for s, e in parts.get(block.text(x, y), ()):
                    mark[x + s] += 1
                    mark[x + e] -= 1
        gone = np.cumsum(mark[:-1]) > 0
        texts, removed, n_removed = [], [], []
        for a, b, s, e in zip(w.first[:-1].tolist(), w.first[1:].tolist(), w.offsets[:-1].tolist(), w.offsets[1:].tolist()):
            off = gone[a:b]
            n_removed.append(int(off.sum()))
            if not n_removed[-1]:
                texts.append(block.raw[s:e].decode())
                removed.append([])
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[False], off, [False]]).astype(np.int8)))
            removed.append([{"from_word": int(x), "to_word": int(y)} for x, y in zip(edge[::2], edge[1::2])])
            keep = np.concatenate([[0], edge, [b - a]]).reshape(-1, 2)
            texts.append(b" ".join(block.text(a + x, a + y) for x, y in keep.tolist() if y > x).decode())
        pieces.append(pa.table({
            "doc_id": pa.array(block.ids, pa.int64()), "n_words": pa.array(w.counts().astype(np.int64)),
            "n_removed": pa.array(n_removed, pa.int64()), "kept_text": pa.array(texts, pa.string()),
            "removed": pa.array(removed, pa.list_(pa.struct([("from_word", pa.int64()), ("to_word", pa.int64())])))}))
    if pieces:
        return pa.concat_tables(pieces)
    return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()),
                     "kept_text": pa.array([], pa.string()),
                     "removed": pa.array([], pa.list_(pa.struct([("from_word", pa.int64()), ("to_word", pa.int64())])))})


def dedup_substrings(docs: DataFrame, params: Params = Params(), store: Store | None = None) -> DataFrame:
    """Remove every word covered by a window whose words also stand anywhere else.

    docs: doc_id, text; further columns are ignored. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.
    Returns one row per input row: doc_id, n_words, n_removed, kept_text (kept words joined by one
    space), removed (word ranges, end exclusive). A null text has no words; texts shorter than a
    window keep all their words; repeated rows are copies of each other, so all their windows go.
    A null doc_id is carried. An empty table gives no rows.
    """
    p, spark = params, docs.sparkSession
    st = store or Store(spark, "substring")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = st.put("blocks", base.mapInArrow(partial(_pack_blocks, p=p), BLOCKS)
                    .withColumn("block", F.monotonically_increasing_id()), codec="uncompressed")
    counted = blocks.mapInArrow(partial(_count_keys, p=p), "block long, key long, n long")
    held = st.put("keys", counted)
    many = held.groupBy("key").agg(F.sum("n").alias("total")).filter("total > 1")
    repeated = st.put("repeated", held.join(many, "key").select("block", "key", "n", (F.col("total") > p.hot).alias("hot")))
    sent = repeated.agg(F.sum("n")).first()[0] or 0
    shards = max(shuffle_partitions(spark), math.ceil(sent * 1.4 * p.window / p.shard_words))
    by_block = blocks.groupBy("block")
    segments = by_block.cogroup(repeated.select("block", "key", "hot").groupBy("block")).applyInArrow(
        lambda left, right: _send(left, right, p, shards), SEGMENTS)
    answers = None
    if not repeated.filter("hot").isEmpty():
        segments = st.put("segments", segments, codec="uncompressed")
        groups = max(1, math.isqrt(blocks.count()))
        salt = F.pmod(F.xxhash64("block", F.lit(9)), F.lit(groups))
        met = st.put("met", segments.filter("cut").withColumn("salt", salt).groupBy("shard", "salt").applyInArrow(
            lambda t: _meet(t.drop_columns(["salt"]), p), MET), codec="uncompressed")
        answers = met.filter("at is not null").select(*[c.split()[0] for c in FOUND.split(", ")])
        columns = [c.split()[0] for c in SEGMENTS.split(", ")]
        segments = segments.filter("not cut").select(*columns).unionAll(met.filter("body is not null").select(*columns))
    found = st.put("found", segments.groupBy("shard").applyInArrow(lambda t: _search(t, p), FOUND))
    if answers is not None:
        found = found.unionAll(answers)
    st.drop("keys", "repeated", "segments")
    return by_block.cogroup(found.groupBy("block")).applyInArrow(lambda left, right: _cut(left, right, p), RESULT)
