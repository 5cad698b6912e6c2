"""Fill-in-middle transformation on piece tables.

A document is a list of descriptors (buffer, start, length) over two immutable
buffers: its own UTF-8 text and the three sentinels. Cutting splits a
descriptor in two, an arrangement permutes the descriptors and puts sentinel
descriptors between them, and the inverse permutation gives the text back.
Nothing is copied on the way: hashes are fed descriptor by descriptor, and an
output text is joined from them only where it is asked for.

Each row is dealt with on its own, so there is no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx

TEXT, SENTINEL = 0, 1                     # buffers
PREFIX, MIDDLE, SUFFIX = 0, 1, 2          # parts of a text


@dataclass(frozen=True)
class Params:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    seed: str = "7"
    percent: int = 100            # documents transformed, of those that can be
    spm_percent: int = 50         # of them, in the form suffix - prefix - middle

    @property
    def sentinels(self) -> tuple[bytes, bytes, bytes]:
        """Sentinel of each part, in the order PREFIX, MIDDLE, SUFFIX."""
        return self.prefix.encode(), self.middle.encode(), self.suffix.encode()


# order in which a form gives the parts, each one preceded by a sentinel
ORDER = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


class PieceTable:
    """Descriptors over a text and a sentinel buffer; all operations give a new table."""

    __slots__ = ("buffers", "pieces")

    def __init__(self, text: memoryview, sentinels: memoryview, pieces: list[Piece] | None = None):
        self.buffers = (text, sentinels)
        self.pieces = [Piece(TEXT, 0, len(text))] if pieces is None else pieces

    def cut(self, *places: int) -> PieceTable:
        """Split descriptors so that every place (byte offset of the whole) is a border.

        Places must ascend; a place at a border, also a repeated one, leaves an empty descriptor, so that
        n cuts of one descriptor always give n + 1.
        """
        out: list[Piece] = []
        rest, at = list(self.pieces[::-1]), 0
        for place in places:
            while rest and at + rest[-1].length < place:
                at += rest[-1].length
                out.append(rest.pop())
            if rest:
                p = rest.pop()
                out.append(Piece(p.buffer, p.start, place - at))
                rest.append(Piece(p.buffer, p.start + place - at, p.length - (place - at)))
                at = place
        return PieceTable(*self.buffers, out + rest[::-1])

    def permute(self, order: tuple[int, ...]) -> PieceTable:
        return PieceTable(*self.buffers, [self.pieces[i] for i in order])

    def interleave(self, marks: list[Piece]) -> PieceTable:
        """One mark before each descriptor."""
        return PieceTable(*self.buffers, [x for pair in zip(marks, self.pieces) for x in pair])

    def slices(self) -> Iterator[memoryview]:
        for p in self.pieces:
            yield self.buffers[p.buffer][p.start: p.start + p.length]

    def sha256(self) -> str:
        h = hashlib.sha256()
        for s in self.slices():
            h.update(s)
        return h.hexdigest()

    def join(self) -> bytes:
        return b"".join(self.slices())


def inverse(order: tuple[int, ...]) -> tuple[int, ...]:
    back = [0] * len(order)
    for at, part in enumerate(order):
        back[part] = at
    return tuple(back)


def arrange(table: PieceTable, form: str, marks: list[Piece]) -> PieceTable:
    """A table of three descriptors (prefix, middle, suffix) in the order of the form, with sentinels."""
    order = ORDER[form]
    return table.permute(order).interleave([marks[i] for i in order])


def unarrange(output: memoryview, form: str, params: Params) -> PieceTable:
    """The text's table, from the output alone: sentinels are found, the parts between them put back in order.

    No part holds a sentinel (such texts stay plain), so each stands once.
    """
    if form == "plain":
        return PieceTable(output, memoryview(b""))
    order, raw, parts, at = ORDER[form], output.obj if isinstance(output.obj, bytes) else bytes(output), [], 0
    marks = [params.sentinels[i] for i in order]
    for mark, after in zip(marks, [*marks[1:], None]):
        at += len(mark)
        end = len(output) if after is None else raw.index(after, at)
        parts.append(Piece(TEXT, at, end - at))
        at = end
    return PieceTable(output, memoryview(b""), parts).permute(inverse(order))


def draws(doc_id: int | None, seed: str) -> list[int]:
    """Four 32-bit numbers from the hash of seed and id (a null id counts as no digits)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i: i + 4], "big") for i in range(0, 16, 4)]


ARRANGED = ("n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
            "pieces array<struct<buffer:int,start:long,length:long>>")


def _characters(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes: all but the continuation bytes."""
    return int(len(data) - np.count_nonzero((data & 0xC0) == 0x80))


def _arrange_rows(batches: Iterator[pa.RecordBatch], params: Params, schema: pa.Schema, text: bool) -> Iterator[pa.RecordBatch]:
    marks, at = [], 0
    for s in params.sentinels:
        marks.append(Piece(SENTINEL, at, len(s)))
        at += len(s)
    fixed = memoryview(b"".join(params.sentinels))
    for batch in batches:
        for rows, data, offsets in tx.runs(batch, "text"):
            raw = data.tobytes()
            view, breaks = memoryview(raw), np.flatnonzero(data == 10)
            first = np.searchsorted(breaks, offsets)
            ids, out = rows.column(rows.schema.get_field_index("doc_id")).to_pylist(), []
            for i, doc_id in enumerate(ids):
                s, e = int(offsets[i]), int(offsets[i + 1])
                mine = breaks[first[i]: first[i + 1]]
                tail = e > s and (not len(mine) or mine[-1] != e - 1)
                n = len(mine) + int(tail)
                h1, h2, h3, h4 = draws(doc_id, params.seed)
                table = PieceTable(view[s:e], fixed)
                if s == e or h3 % 100 >= params.percent or any(raw.find(x, s, e) >= 0 for x in params.sentinels):
                    form, chars = "plain", (None, None)
                else:
                    ends = [0 if u == 0 else e - s if u > len(mine) else int(mine[u - 1]) + 1 - s
                            for u in sorted((h1 % (n + 1), h2 % (n + 1)))]
                    form = "spm" if h4 % 100 < params.spm_percent else "psm"
                    table = arrange(table.cut(*ends), form, marks)
                    chars = _characters(data[s: s + ends[0]]), _characters(data[s + ends[0]: s + ends[1]])
                out.append((n, form, *chars, table.sha256(), [p._asdict() for p in table.pieces],
                            table.join() if text else None))
            columns = [pa.array(c, f.type) if f.name != "output" else pa.array(c, pa.binary()).cast(f.type, safe=False)
                       for c, f in zip(zip(*out), list(schema)[rows.num_columns - 1:])]
            kept = [rows.column(j) for j in range(rows.num_columns) if rows.schema.names[j] != "text"]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(kept, schema)] + columns, schema=schema)
    tx.trim()


def fill_in_middle(docs: DataFrame, params: Params = Params(), output: bool = True) -> DataFrame:
    """One row per document: doc_id, n (lines), form, prefix_chars, middle_chars, output_sha256, pieces and output.

    docs: doc_id, text and any further columns, which are not returned. A line is ``[^\\n]*\\n|[^\\n]+``;
    the prefix ends after the smaller, the middle after the larger of two line counts drawn from the
    hash of seed and doc_id. The form is plain (the text as it is; both character counts null) where the text
    is empty, holds a sentinel or is not drawn, else psm or spm. ``pieces`` lists the output's descriptors over
    the text's bytes (buffer 0) and the sentinels prefix, middle, suffix in a row (buffer 1).
    A null text is an empty one, a null doc_id draws as one without digits, repeated rows give equal rows, an
    empty table none. output=False leaves the output texts out.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = f"doc_id long, {ARRANGED}" + (", output string" if output else "")
    spark = docs.sparkSession
    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)
    return base.mapInArrow(partial(_arrange_rows, params=params, schema=arrow, text=output), schema)


def _restore_rows(batches: Iterator[pa.RecordBatch], params: Params, text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in tx.runs(batch, "output"):
            forms, found, texts = rows.column(rows.schema.get_field_index("form")).to_pylist(), [], []
            for i, form in enumerate(forms):
                table = unarrange(memoryview(data[int(offsets[i]): int(offsets[i + 1])].tobytes()), form or "plain", params)
                found.append(table.sha256())
                if text:
                    texts.append(table.join())
            kept = [rows.column(j) for j in range(rows.num_columns) if rows.schema.names[j] != "output"]
            names = [x for x in rows.schema.names if x != "output"]
            if text:
                kept, names = [*kept, pa.array(texts, pa.binary()).cast(pa.string(), safe=False)], [*names, "text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.string())], [*names, "restored_sha256"])
    tx.trim()


def restore(arranged: DataFrame, params: Params = Params(), text: bool = True) -> DataFrame:
    """The original texts, rebuilt from ``output`` and ``form`` alone: all columns but output, then text and restored_sha256.

    text=False gives the hash only.
    """
    kept = [f for f in arranged.schema.fields if f.name not in ("output", "text", "restored_sha256")]
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    base = arranged.select(*[F.col(f"`{f.name}`") for f in kept], "output")
    return base.mapInArrow(partial(_restore_rows, params=params, text=text),
                           names + (", text string" if text else "") + ", restored_sha256 string")
