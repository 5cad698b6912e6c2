"""Counting quotient filters over word-id n-grams: lossless, compact, mergeable counters.

An n-gram of n word ids of ``bits`` bits each is one key of n blocks. A Feistel
network permutes the keys (so equal keys stay equal, different ones different, and
the permutation can be undone), which spreads any set of n-grams evenly. A filter
holds the sorted permuted keys of one part of the key space:

- all keys of a part share the first ``head`` bits, which are stored once;
- the next q bits are the quotient, of which only two bit vectors are kept: which
  quotients occur, and at which slot each one's run ends;
- the rest is the remainder, kept in full, one run after the other;
- the counts are kept in as few 7-bit groups as they need.

So a key costs its bits less head and quotient, plus about three bits, and nothing
is lost: decoding gives the very n-grams and counts back. Filters of the same part
are merged by merging their sorted keys.
"""

from __future__ import annotations

import struct

import numpy as np

from . import text as tx

HEADER = struct.Struct("<BBBBQQ")           # blocks, bits, head, q, part, keys
ONE = np.uint64(1)


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _rounds(n: int) -> list[int]:
    """Blocks in the order in which they are changed; block 0, the leading one, comes last."""
    return [*range(n - 1, -1, -1)] * 2


def _draw(blocks: list[np.ndarray], target: int, turn: int, bits: int) -> np.ndarray:
    h = np.full(len(blocks[0]), turn + 1, dtype=np.uint64)
    for j, b in enumerate(blocks):
        if j != target:
            h = tx.combine(h, b)
    return h & _mask(bits)


def permute(blocks: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """A bijection on keys of len(blocks) blocks of ``bits`` bits (uint64 each)."""
    out = list(blocks)
    for turn, t in enumerate(_rounds(len(out))):
        out[t] = out[t] ^ _draw(out, t, turn, bits)
    return out


def unpermute(blocks: list[np.ndarray], bits: int) -> list[np.ndarray]:
    out = list(blocks)
    for turn, t in reversed(list(enumerate(_rounds(len(out))))):
        out[t] = out[t] ^ _draw(out, t, turn, bits)
    return out


# ---------------------------------------------------------------- sorted keys with counts

def gather(keys: np.ndarray, counts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort keys (n x m) by their blocks and add up the counts of equal ones."""
    if keys.shape[1] < 2:
        return keys, counts
    lead = keys[0] << np.uint64(64 - bits)
    if len(keys) > 1 and bits < 64:
        lead = lead | (keys[1] >> np.uint64(bits - min(bits, 64 - bits)))
    order = np.argsort(lead)
    new = _changes(keys[:, order])
    if (~(lead[order][1:] != lead[order][:-1]) & new[1:]).any():     # equal leads, different keys: sort in full
        order = np.lexsort(keys[::-1])
        new = _changes(keys[:, order])
    keys, counts = keys[:, order], counts[order]
    at = np.flatnonzero(new)
    return keys[:, at], np.add.reduceat(counts, at)


def _changes(keys: np.ndarray) -> np.ndarray:
    new = np.ones(keys.shape[1], dtype=bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    return new


# ---------------------------------------------------------------- the filter's bytes

def _planes(values: np.ndarray, bits: int) -> bytes:
    """The low ``bits`` bits of each value, byte by byte."""
    width = -(-bits // 8)
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unplanes(raw: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, int]:
    width = -(-bits // 8)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = raw[: n * width].reshape(width, n).T
    return out.reshape(-1).view("<u8").astype(np.uint64), n * width


def _pack_counts(counts: np.ndarray) -> bytes:
    """Seven bits a byte, low ones first; the top bit says that more follow."""
    left, size = counts.astype(np.uint64), np.ones(len(counts), dtype=np.int64)
    for shift in range(7, 64, 7):
        size += (left >> np.uint64(shift)) > 0
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), dtype=np.uint8)
    for j in range(int(size.max(initial=0))):
        live = size > j
        out[at[live] + j] = ((left[live] >> np.uint64(7 * j)) & np.uint64(127)).astype(np.uint8) | ((size[live] > j + 1) << 7).astype(np.uint8)
    return out.tobytes()


def _unpack_counts(raw: np.ndarray) -> np.ndarray:
    last = raw < 128
    ends = np.flatnonzero(last)
    first = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    place = np.arange(len(raw)) - np.repeat(first, ends - first + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), first) if len(ends) else np.zeros(0, np.int64)


def encode(keys: np.ndarray, counts: np.ndarray, bits: int, head: int = 0) -> bytes:
    """The filter of sorted, distinct, permuted keys (n x m, n blocks) that share their first ``head`` bits."""
    n, m = keys.shape
    q = max(0, min(bits - head, int(np.log2(max(m, 1)))))
    rest = bits - head - q
    inner = keys[0] & _mask(bits - head)
    quotient = (inner >> np.uint64(rest)).astype(np.int64)
    occupied = np.zeros(1 << q, dtype=bool)
    occupied[quotient] = True
    ends = np.ones(m, dtype=bool)
    ends[:-1] = quotient[1:] != quotient[:-1]
    part = int(keys[0][0] >> np.uint64(bits - head)) if m and head else 0
    return b"".join([HEADER.pack(n, bits, head, q, part, m), np.packbits(occupied).tobytes(), np.packbits(ends).tobytes(),
                     _planes(inner & _mask(rest), rest), *[_planes(k, bits) for k in keys[1:]], _pack_counts(counts)])


def decode(raw: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys, counts, bits): the sorted permuted keys and their counts."""
    n, bits, head, q, part, m = HEADER.unpack_from(raw)
    data = np.frombuffer(raw, dtype=np.uint8)[HEADER.size:]
    at = -(-(1 << q) // 8)
    occupied = np.flatnonzero(np.unpackbits(data[:at], count=1 << q))
    ends = np.unpackbits(data[at: at + -(-m // 8)], count=m)
    at += -(-m // 8)
    rest = bits - head - q
    run = np.cumsum(ends) - ends                       # the run that a slot is in; its quotient is the run-th occupied one
    remainder, used = _unplanes(data[at:], m, rest)
    at += used
    quotient = occupied[run].astype(np.uint64) if m else np.zeros(0, np.uint64)
    lead = remainder if rest == 64 else (quotient << np.uint64(rest)) | remainder
    keys = [lead | (np.uint64(part) << np.uint64(bits - head)) if head else lead]
    for _ in range(n - 1):
        block, used = _unplanes(data[at:], m, bits)
        at += used
        keys.append(block)
    return np.stack(keys), _unpack_counts(data[at:]), bits


def lookup(raw: bytes, blocks: list[int]) -> int:
    """The count of one n-gram (its word ids): through quotient, run and remainder; 0 if it is not held."""
    n, bits, head, q, part, m = HEADER.unpack_from(raw)
    key = [int(x[0]) for x in permute([np.array([b], dtype=np.uint64) for b in blocks], bits)]
    rest = bits - head - q
    if not m or key[0] >> (bits - head) != part:
        return 0
    data = np.frombuffer(raw, dtype=np.uint8)[HEADER.size:]
    at = -(-(1 << q) // 8)
    occupied = np.unpackbits(data[:at], count=1 << q)
    quotient = (key[0] & ((1 << (bits - head)) - 1)) >> rest
    if not occupied[quotient]:
        return 0
    ends = np.flatnonzero(np.unpackbits(data[at: at + -(-m // 8)], count=m))
    run = int(occupied[:quotient].sum())
    keys, counts, _ = decode(raw)
    span = slice(ends[run - 1] + 1 if run else 0, ends[run] + 1)
    hit = (keys[:, span] == np.array(key, dtype=np.uint64)[:, None]).all(axis=0)
    return int(counts[span][hit].sum())


def merge(filters: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """(keys, counts, bits) of filters of one part, equal keys added up."""
    parts = [decode(f) for f in filters]
    bits = parts[0][2]
    keys, counts = gather(np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts]), bits)
    return keys, counts, bits
