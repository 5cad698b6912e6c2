"""Word arrays over whole Arrow text columns, computed with numpy inside a task.

A word is a run of bytes other than space, tab, newline, vertical tab, form
feed and carriage return (``[^\\x20\\x09-\\x0D]+``). All of these are ASCII, so
splitting the UTF-8 bytes gives the words of the decoded text. Words are named
by 64-bit hashes; every function works on all documents of a batch at once and
never looks at a prefix only.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SPACES)] = False
# masks that keep the first n bytes of a little-endian 8-byte load
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
# fixed values: the increments and multipliers of the splitmix64 generator
_GAMMA = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (a bijection of 64-bit values)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX_A
    x ^= x >> np.uint64(27)
    x *= _MIX_B
    x ^= x >> np.uint64(31)
    return x


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(left * _GAMMA + right)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One 64-bit hash per byte range, over its bytes and its length."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    return _hashes(padded, start, end)


def _hashes(padded: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - start
    loads = np.ndarray(shape=(len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    h = mix(size.astype(np.uint64) * _GAMMA + _GAMMA)
    live, at, left = np.arange(len(size)), start, size
    while len(live):
        block = loads[at] & _KEEP[np.minimum(left, 8)]
        h[live] = mix(h[live] ^ (block * _GAMMA))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return h


class Words:
    """The words of a run of documents.

    ``data``    the bytes of all texts, one after the other, padded by 8 bytes
    ``start``, ``end``  byte range of each word in ``data``
    ``first``   index of each document's first word, with a final total
                (document i has words first[i] .. first[i+1]-1)
    """

    def __init__(self, data: bytes | np.ndarray, offsets: np.ndarray):
        raw = np.frombuffer(data, dtype=np.uint8) if not isinstance(data, np.ndarray) else data
        self.data = np.zeros(len(raw) + 8, dtype=np.uint8)
        self.data[: len(raw)] = raw
        inside = np.zeros(len(raw) + 1, dtype=bool)
        inside[:-1] = IS_WORD[raw]
        begins = inside[:-1].copy()
        begins[1:] &= ~inside[:-2]
        ends = inside[:-1] & ~inside[1:]
        cut = np.asarray(offsets[1:-1], dtype=np.int64)          # a word never runs over a document's end
        cut = cut[(cut > 0) & (cut < len(raw))]
        begins[cut] = inside[cut]
        ends[cut - 1] = inside[cut - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.offsets = np.asarray(offsets, dtype=np.int64)
        self.first = np.searchsorted(self.start, self.offsets)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word, over its bytes and its length."""
        return _hashes(self.data, self.start, self.end)

    def shingles(self, k: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k-word shingles and each document's first shingle (with a final total).

        A document with 1 .. k-1 words has one shingle, its whole word sequence.
        """
        w = self.hashes() if hashes is None else hashes
        n = self.counts()
        made = np.where(n >= k, n - k + 1, np.minimum(n, 1))
        first = np.concatenate([[0], np.cumsum(made)])
        # word index at which each shingle begins
        begin = np.arange(first[-1]) - np.repeat(first[:-1], made) + np.repeat(self.first[:-1], made)
        width = np.repeat(np.minimum(n, k), made)
        h = mix(width.astype(np.uint64) + _GAMMA)
        whole = width == k
        if whole.all():
            for j in range(k):
                h = combine(h, w[begin + j])
        else:
            for j in range(k):
                live = np.flatnonzero(width > j)
                h[live] = combine(h[live], w[begin[live] + j])
        return h, first

    def piece(self, a: int, b: int) -> bytes:
        """Words a .. b-1 as they stand, joined by one space."""
        return b" ".join(bytes(self.data[s:e]) for s, e in zip(self.start[a:b], self.end[a:b]))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, every other byte unchanged."""
    out = data.copy()
    upper = (out >= 65) & (out <= 90)
    out[upper] += 32
    return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string column; a null counts as an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def runs(batch: pa.RecordBatch, column: str, most: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows of about ``most`` text bytes: (rows, bytes, offsets).

    Whole rows only; a row longer than ``most`` is a run of its own.
    """
    data, offsets = utf8(batch.column(batch.schema.get_field_index(column)))
    a = 0
    while a < batch.num_rows:
        b = int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1
        b = min(max(b, a + 1), batch.num_rows)
        yield batch.slice(a, b - a), data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]
        a = b


def trim() -> None:
    """Give freed memory back to the system at the end of a task: its Python worker lives on."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):          # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)
