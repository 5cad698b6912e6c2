"""Compressed FM-index over word sequences, with matching statistics.

The index holds the Burrows-Wheeler transform of many word sequences (each ended
by a separator of its own) in a wavelet tree shaped by an entropy code: under
n * (H0 + 1) bits in packed words, plus one counter per 64 bits. Backward search extends a match
one word to the left by two rank queries. All searches run side by side as numpy
arrays, so one step of every open search costs a few vector operations per level
of the tree.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A packed bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros(-(-(n + 1) // 64) * 64, dtype=np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.int32 if n < 1 << 31 else np.int64)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Number of ones among the first i bits."""
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Shannon code lengths, ceil(log2(total / count)) and at least 1: a prefix code of under H0 + 1 bits."""
    need = counts.sum() / counts
    length = np.ceil(np.log2(need)).astype(np.int64)
    length += np.left_shift(np.int64(1), length) < need          # guard against rounding of the logarithm
    return np.maximum(length, 1)


class Wavelet:
    """Entropy-shaped wavelet tree of a sequence of symbols 0 .. sigma-1."""

    def __init__(self, sequence: np.ndarray, sigma: int):
        counts = np.bincount(sequence, minlength=sigma)
        self.length = code_lengths(np.maximum(counts, 1))
        depth = int(self.length.max())
        # canonical codes, left-aligned to ``depth`` bits: shorter codes first
        order = np.lexsort((np.arange(sigma), self.length))
        step = np.left_shift(np.int64(1), depth - self.length[order])
        code = np.empty(sigma, dtype=np.int64)
        code[order] = np.concatenate([[0], np.cumsum(step)[:-1]])
        self.code, self.depth = code, depth
        self.levels: list[Bits] = []
        self.base: list[np.ndarray] = []          # first position of a symbol's node, per level
        self.ones: list[np.ndarray] = []          # ones before it
        row = sequence.astype(np.int32)
        by_code = np.argsort(code)
        for level in range(depth):
            row = row[self.length[row] > level]
            shift = depth - level - 1
            bit = (code[row] >> shift & 1).astype(np.int32)
            bits = Bits(bit)
            # nodes of this level: symbols that go on, in code order, grouped by their first ``level`` bits
            live = by_code[self.length[by_code] > level]
            prefix = code[live] >> (shift + 1)
            new = np.concatenate([[True], prefix[1:] != prefix[:-1]])
            edge = np.append(np.concatenate([[0], np.cumsum(counts[live])])[np.append(new, True)], len(row))[: int(new.sum()) + 1]
            node = np.cumsum(new) - 1
            base = np.zeros(sigma, dtype=np.int64)
            base[live] = edge[node]
            self.levels.append(bits)
            self.base.append(base)
            self.ones.append(bits.rank(base))
            # stable partition of every node by its bit gives the next level's order
            before = np.concatenate([[0], np.cumsum(bit, dtype=np.int32)])
            width = np.diff(edge)
            first = before[edge[:-1]]
            zeros = width - (before[edge[1:]] - first)
            ahead = np.where(bit == 1, np.repeat((edge[:-1] + zeros - first).astype(np.int32), width) + before[:-1],
                             np.arange(len(row), dtype=np.int32) - before[:-1] + np.repeat(first, width))
            out = np.empty_like(row)
            out[ahead] = row
            row = out

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol among the first i entries."""
        pos = i.astype(np.int64)
        live = np.arange(len(symbol))
        length = self.length[symbol]
        for level in range(self.depth):
            go = length[live] > level
            if not go.all():
                live = live[go]
            if not len(live):
                break
            s = symbol[live]
            p = pos[live]
            one = self.levels[level].rank(self.base[level][s] + p) - self.ones[level][s]
            bit = (self.code[s] >> (self.depth - level - 1)) & 1
            pos[live] = np.where(bit == 1, one, p - one)
        return pos


def suffix_array(text: np.ndarray, most: int) -> np.ndarray:
    """Suffix order by prefix doubling, until all ranks differ (or ``most`` symbols are compared).

    The rank of a suffix is the number of suffixes before its group of equals; each round sorts
    only the suffixes that still have an equal.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    head = np.concatenate([[True], text[order][1:] != text[order][:-1]])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    tied = order[~(head & np.append(head[1:], True))]
    k = 1
    while k < most and len(tied):
        after = tied + k
        key = rank[tied] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        sort = np.argsort(key)
        tied, key = tied[sort], key[sort]
        old = rank[tied]
        at = np.arange(len(tied))
        group = np.concatenate([[True], old[1:] != old[:-1]])
        head = np.concatenate([[True], key[1:] != key[:-1]])
        rank[tied] = old + at[head][np.cumsum(head) - 1] - at[group][np.cumsum(group) - 1]
        tied = tied[~(head & np.append(head[1:], True))]
        k *= 2
    # ranks are all different unless ``most`` ended the rounds; equals keep their position's order
    return np.argsort(rank, kind="stable") if len(tied) else _inverse(rank)


def _inverse(rank: np.ndarray) -> np.ndarray:
    order = np.empty(len(rank), dtype=np.int64)
    order[rank] = np.arange(len(rank))
    return order


class FMIndex:
    """FM-index of the sequences words[first[i]:first[i+1]] (symbols 0 .. sigma-1)."""

    def __init__(self, words: np.ndarray, first: np.ndarray, sigma: int):
        n_seq, size = len(first) - 1, np.diff(first)
        n = len(words) + n_seq
        # separators are 0 .. n_seq-1 (all different), words follow
        text = np.empty(n, dtype=np.int64)
        ends = first[1:] + np.arange(n_seq)
        text[ends] = np.arange(n_seq)
        is_word = np.ones(n, dtype=bool)
        is_word[ends] = False
        text[is_word] = words + n_seq
        order = suffix_array(text, int(size.max(initial=1)) + 1)
        before = text[order - 1]                    # the symbol in front of each suffix
        # separators are never searched for and become one symbol
        self.wavelet = Wavelet(np.where(before < n_seq, 0, before - n_seq + 1), sigma + 1)
        count = np.bincount(words, minlength=sigma)
        self.start = np.concatenate([[n_seq], n_seq + np.cumsum(count)])   # first suffix that begins with a word
        self.rows = n

    def extend(self, word: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the suffix ranges of word + match."""
        both = self.wavelet.rank(np.concatenate([word, word]) + 1, np.concatenate([lo, hi]))
        at = self.start[word]
        return at + both[: len(word)], at + both[len(word):]


def repeated_intervals(index: FMIndex, words: np.ndarray, first: np.ndarray, least: int,
                       copies: np.ndarray | None = None, probe: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parts of the query sequences that occur at least twice, of ``least`` words or more.

    Every query is itself in the index, once; ``copies`` says how often it stands in the text. For
    an end position e the match is extended to the left as long as its range holds two suffixes
    (one, for a query with copies); the length L reached is the matching statistic of e. If it is
    at least ``least``, the whole interval is reported, and the next window to decide starts just
    left of it. If not, the words e-L .. e occur once, so no window around them counts. Windows
    further left still hold word e-L: a short probe that ends ``probe`` words after it, if it dies
    at or after e-L, rules out all windows that end between the probe's end and e. The few queries
    that are still open after some rounds have each of their remaining windows looked up side by
    side, so that the number of rounds is bounded.
    Returns (query, from, to) with ``to`` exclusive; together they cover every repeated window.
    """
    size = np.diff(first)
    query = np.flatnonzero(size >= least)
    need = np.full(len(size), 2) if copies is None else np.where(copies > 1, 1, 2)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    end = size[query] - 1
    length = np.zeros(len(query), dtype=np.int64)
    lo = np.zeros(len(query), dtype=np.int64)
    hi = np.full(len(query), index.rows, dtype=np.int64)
    wall = np.full(len(query), -1, dtype=np.int64)       # while probing: the word the probe must not pass
    back = np.full(len(query), -1, dtype=np.int64)       # the end to go on with if it does
    for _ in range(3 * least):
        if not len(query):
            break
        room = (length <= end) & (end - length >= wall)
        open_ = np.flatnonzero(room)
        new_lo, new_hi = index.extend(words[first[query[open_]] + end[open_] - length[open_]], lo[open_], hi[open_])
        more = new_hi - new_lo >= need[query[open_]]
        grown = open_[more]
        lo[grown], hi[grown] = new_lo[more], new_hi[more]
        length[grown] += 1
        stopped = np.ones(len(query), dtype=bool)
        stopped[grown] = False
        stop = np.flatnonzero(stopped)
        if not len(stop):
            continue
        e, n, died = end[stop], length[stop], room[stop]     # died: the match could not grow; else it ran out of words
        probing = wall[stop] >= 0
        hit = ~probing & (n >= least)
        if hit.any():
            found.append((query[stop[hit]], e[hit] - n[hit] + 1, e[hit] + 1))
        left = e - n                                          # the first word the match does not hold
        to = left + probe
        start_probe = ~probing & ~hit & died & (to < e - 1)
        nxt = np.where(hit, np.where(died, left + least - 1, -1),
                       np.where(probing, np.where(died, e - 1, back[stop]), np.where(start_probe, to, np.where(died, e - 1, -1))))
        wall[stop] = np.where(start_probe, left, -1)
        back[stop] = np.where(start_probe, e - 1, -1)
        end[stop], length[stop] = nxt, 0
        lo[stop], hi[stop] = 0, index.rows
        keep = (end >= least - 1) | (wall >= 0)
        if not keep.all():
            query, end, length, lo, hi, wall, back = (x[keep] for x in (query, end, length, lo, hi, wall, back))
    if len(query):
        last = np.where(wall >= 0, back, end)
        n = last - least + 2
        end = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + least - 1
        query = np.repeat(query, n)
        lo = np.zeros(len(query), dtype=np.int64)
        hi = np.full(len(query), index.rows, dtype=np.int64)
        for j in range(least):
            lo, hi = index.extend(words[first[query] + end - j], lo, hi)
            more = hi - lo >= need[query]
            query, end, lo, hi = query[more], end[more], lo[more], hi[more]
        found.append((query, end - least + 1, end + 1))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))
