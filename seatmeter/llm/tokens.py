"""Token ids as binary documents: one shared zstandard dictionary, one frame per document.

A written folder holds two tables:

``dictionary``  one row (dict_sha256, dictionary): trained on the serialized ids
                of a bounded sample of documents (``Params.sample_docs``).
``containers``  rows (part, container, first_doc, last_doc, n_docs, n_tokens,
                dict_sha256, width, doc_ids, token_counts, offsets, data) in
                ascending doc_id order. ``data`` is the concatenation of one
                zstandard frame per document, each compressed on its own with
                the dictionary; ``offsets`` is the index into it. So one short
                document is read by finding its container (row group minima and
                maxima of first_doc, last_doc) and decompressing one frame.

Ids are little-endian unsigned integers of ``width`` bytes (2 if the vocabulary
allows it, else 4). The order is made by one range partitioning of (doc_id,
text); every task writes its own range.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import text as tx


@dataclass(frozen=True)
class Params:
    tokenizer: str = ""                # path of the tokenizer file
    end_id: int = 0                    # appended to every document
    level: int = 3
    dict_bytes: int = 1 << 16
    sample_docs: int = 1000            # documents the dictionary is trained on (those with the smallest id hashes)
    sample_chars: int = 4000           # characters of each of them
    container_bytes: int = 1 << 20     # compressed bytes after which a container is closed


# ---------------------------------------------------------------- tokenizer

# what a byte is, for cutting: 1 an ASCII letter, 2 another visible ASCII character, 0 anything else
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[0x21:0x7F] = 2
_KIND[0x30:0x3A] = 0
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = 1
# second byte of the letters U+00C0 .. U+00FF (all but the two operators among them)
_LATIN = np.zeros(256, dtype=bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


class Encoder:
    """Exact ids of whole texts, with a table of the ids of pieces seen before.

    Texts are cut where the byte-level pre-tokenizer always cuts: before a single space or
    newline that stands between two visible characters, after such a newline, and between a
    letter and an ASCII punctuation mark that follows it (never inside an added token). So the ids of a text are those of its
    pieces, one after the other. Pieces are named by 64-bit hashes; a new piece is encoded once by
    the tokenizer. The table is cleared when it holds ``most`` pieces, so its memory is bounded
    (about 25 bytes a piece).
    """

    def __init__(self, path: str, most: int = 1_500_000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        # strings of added tokens are found before anything is cut: no cut may fall inside one
        inside = "".join(t.content[1:] for t in self.tokenizer.get_added_tokens_decoder().values()).encode()
        self.cut_white = not any(c in inside for c in b" \n")
        self.mark = _KIND == 2
        self.mark[list(inside)] = False
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.uint32)
        self.size = np.zeros(0, np.uint32)
        self.flat = np.zeros(0, f"u{self.width}")

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start of every piece, and each document's first piece (with a final total)."""
        n = len(data)
        cut = np.zeros(n + 2, dtype=bool)
        kind = _KIND[data]
        # per byte: ends a visible character / a letter, begins a visible character
        latin = np.zeros(n, dtype=bool)
        latin[1:] = (data[:-1] == 0xC3) & _LATIN[data[1:]]
        letter = (kind == 1) | latin
        digit = (data >= 0x30) & (data < 0x3A)
        ends = letter | (kind == 2) | digit
        begins = (kind > 0) | digit
        begins[:-1] |= latin[1:]
        lone = np.zeros(n, dtype=bool)            # a space or newline between two visible characters
        lone[1:-1] = ((data[1:-1] == 0x20) | (data[1:-1] == 0x0A)) & ends[:-2] & begins[2:]
        # nothing looks across a document's end
        edge = offsets[1:-1]
        lone[edge[edge < n]] = False
        lone[edge[edge > 0] - 1] = False
        if self.cut_white:
            cut[:n] = lone
            cut[1: n + 1] |= lone & (data == 0x0A)
        cut[1:n] |= letter[:-1] & self.mark[data[1:]]
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(cut[:n])
        return start, np.searchsorted(start, offsets)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents one after the other, and the number of ids of each document."""
        start, first = self.pieces(data, offsets)
        if not len(start):
            return np.zeros(0, self.flat.dtype), np.zeros(len(offsets) - 1, np.int64)
        end = np.append(start[1:], len(data))
        unique, where, inverse = np.unique(tx.span_hashes(data, start, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > self.most:
            self.clear()
        pos = np.searchsorted(self.keys, unique)
        known = pos < len(self.keys)
        known[known] = self.keys[pos[known]] == unique[known]
        fresh = where[~known]
        if len(fresh):
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(start[fresh].tolist(), end[fresh].tolist())]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            size = np.fromiter(map(len, ids), np.uint32, len(ids))
            at = len(self.flat) + np.cumsum(size, dtype=np.int64) - size
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), self.flat.dtype, int(size.sum()))])
            self.keys = np.insert(self.keys, pos[~known], unique[~known])
            self.at = np.insert(self.at, pos[~known], at)
            self.size = np.insert(self.size, pos[~known], size)
            pos = np.searchsorted(self.keys, unique)
        size, at = self.size[pos].astype(np.int64)[inverse], self.at[pos].astype(np.int64)[inverse]
        total = np.concatenate([[0], np.cumsum(size)])
        at -= total[:-1]
        ids = self.flat[np.arange(total[-1]) + np.repeat(at, size)]
        return ids, total[first[1:]] - total[first[:-1]]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Every document's ids followed by the end id; and where each document begins (with a final total)."""
    begin = np.concatenate([[0], np.cumsum(counts + 1)])
    out = np.full(begin[-1], end_id, dtype=np.uint32)
    keep = np.ones(len(out), dtype=bool)
    keep[begin[1:] - 1] = False
    out[keep] = ids
    return out, begin


# ---------------------------------------------------------------- writing

def train_dictionary(texts: list[str], p: Params) -> bytes:
    """Dictionary over the serialized ids of a sample; empty if the sample is too small to train on."""
    e = encoder(p.tokenizer)
    samples = []
    for t in texts:
        ids, _ = e.encode(*tx.utf8(pa.array([t], pa.large_string())))
        samples.append(np.append(ids, p.end_id).astype(f"<u{e.width}").tobytes())
    try:
        return zstandard.train_dictionary(p.dict_bytes, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


CONTAINERS = ("part int, container long, first_doc long, last_doc long, n_docs long, n_tokens long, dict_sha256 string, "
              "width int, doc_ids array<long>, token_counts array<long>, offsets array<long>, data binary")
_FIELDS = [x.split()[0] for x in CONTAINERS.split(", ")]


def _pack(batches: Iterator[pa.RecordBatch], dictionary, p: Params) -> Iterator[pa.RecordBatch]:
    e, raw = encoder(p.tokenizer), dictionary.value
    name = hashlib.sha256(raw).hexdigest()
    press = zstandard.ZstdCompressor(level=p.level, dict_data=zstandard.ZstdCompressionDict(raw) if raw else None,
                                     write_content_size=True, write_checksum=False)
    part, number = TaskContext.get().partitionId(), 0
    ids_held: list = []
    sizes: list[int] = []
    counts: list[int] = []
    frames: list[bytes] = []
    held = 0

    def close() -> pa.RecordBatch:
        nonlocal number, held
        known = [i for i in ids_held if i is not None]
        row = {"part": part, "container": number, "first_doc": known[0] if known else None,
               "last_doc": known[-1] if known else None, "n_docs": len(ids_held), "n_tokens": sum(counts),
               "dict_sha256": name, "width": e.width, "doc_ids": list(ids_held), "token_counts": list(counts),
               "offsets": np.concatenate([[0], np.cumsum(sizes)]).tolist(), "data": b"".join(frames)}
        number, held = number + 1, 0
        for x in (ids_held, sizes, counts, frames):
            x.clear()
        schema = pa.schema([("part", pa.int32()), ("container", pa.int64()), ("first_doc", pa.int64()), ("last_doc", pa.int64()),
                            ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("dict_sha256", pa.string()), ("width", pa.int32()),
                            ("doc_ids", pa.list_(pa.int64())), ("token_counts", pa.list_(pa.int64())),
                            ("offsets", pa.list_(pa.int64())), ("data", pa.binary())])
        return pa.RecordBatch.from_pylist([row], schema=schema)

    for batch in batches:
        for rows, data, offsets in tx.runs(batch, "text", 4 << 20):
            ids, n = e.encode(data, offsets)
            ids, begin = with_end(ids, n, p.end_id)
            raw_ids = ids.astype(f"<u{e.width}").tobytes()
            for i, doc in enumerate(rows.column(0).to_pylist()):
                frame = press.compress(raw_ids[begin[i] * e.width: begin[i + 1] * e.width])
                ids_held.append(doc)
                counts.append(int(begin[i + 1] - begin[i]))
                sizes.append(len(frame))
                frames.append(frame)
                held += len(frame) + 16
                if held >= p.container_bytes:
                    yield close()
    if ids_held:
        yield close()
    tx.trim()


def write_tokens(docs: DataFrame, path: str, params: Params) -> None:
    """Encode docs (doc_id, text; further columns are ignored) and write the folder ``path``.

    A null text counts as empty (its ids are the end id alone). Rows without doc_id come first;
    rows with one doc_id stand in a fixed order, repeated rows are each written.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = base.select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(params.sample_docs)
    sample = (base.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
              .select(F.substring("text", 1, params.sample_chars).alias("t")).filter("t is not null").limit(params.sample_docs))
    raw = train_dictionary(sorted(r.t for r in sample.collect()), params)
    name = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(name, bytearray(raw))], "dict_sha256 string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = base.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    (ordered.mapInArrow(partial(_pack, dictionary=spark.sparkContext.broadcast(raw), p=params), CONTAINERS)
     .write.option("compression", "uncompressed").parquet(f"{path}/containers"))


# ---------------------------------------------------------------- reading

def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(bytes(row.dictionary)).hexdigest() != row.dict_sha256:
        raise ValueError("the dictionary differs from its hash")
    return row.dict_sha256, bytes(row.dictionary)


def _frames(batch: pa.RecordBatch, name: str, raw: bytes):
    """(row, doc_ids, ids of each document as an iterator) of every container of a batch."""
    press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    col = lambda c: batch.column(batch.schema.get_field_index(c))
    for i in range(batch.num_rows):
        if col("dict_sha256")[i].as_py() != name:
            raise ValueError("a container names another dictionary")
        width, at = col("width")[i].as_py(), col("offsets")[i].as_py()
        data = memoryview(col("data")[i].as_buffer())
        yield i, col("doc_ids")[i].as_py(), (
            np.frombuffer(press.decompress(data[a:b]), dtype=f"<u{width}") for a, b in zip(at[:-1], at[1:]))


DIGESTS = "part int, container long, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def _digest(batches: Iterator[pa.RecordBatch], dictionary) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, docs, each in _frames(batch, *dictionary.value):
            n, crc = [], []
            for ids in each:
                n.append(len(ids))
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
            start = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
            same = [batch.column(batch.schema.get_field_index(c))[i].as_py() for c in ("part", "container")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([same[0]] * len(n), pa.int32()), pa.array([same[1]] * len(n), pa.int64()), pa.array(docs, pa.int64()),
                 pa.array(start), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                ["part", "container", "doc_id", "local_start", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every written document.

    The running totals are taken in three steps, none of them over all rows at once: within a
    container, over the containers of a part, and over the parts (one row per written file).
    """
    boxes = spark.read.schema(CONTAINERS).parquet(f"{path}/containers")
    shared = spark.sparkContext.broadcast(_dictionary(spark, path))
    docs = (boxes.select("part", "container", "dict_sha256", "width", "doc_ids", "offsets", "data")
            .mapInArrow(partial(_digest, dictionary=shared), DIGESTS))
    parts = boxes.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("container").rowsBetween(Window.unboundedPreceding, -1)
    base = (boxes.select("part", "container", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("inner_start"))
            .join(parts, "part"))
    return (docs.join(base, ["part", "container"])
            .select("doc_id", (F.col("part_start") + F.col("inner_start") + F.col("local_start")).alias("start"),
                    "n_tokens", "ids_crc32"))


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (a list per row with this doc_id), from its own frames only."""
    boxes = spark.read.schema(CONTAINERS).parquet(f"{path}/containers")
    place = (boxes.filter((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
             .select("dict_sha256", "width", F.posexplode("doc_ids").alias("i", "doc"), "offsets", "data").filter(F.col("doc") == doc_id)
             .selectExpr("dict_sha256", "width", "substring(data, cast(offsets[i] + 1 as int), cast(offsets[i + 1] - offsets[i] as int)) as frame"))
    name, raw = _dictionary(spark, path)
    press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    return [np.frombuffer(press.decompress(bytes(r.frame)), dtype=f"<u{r.width}").tolist()
            for r in place.collect() if r.dict_sha256 == name]
