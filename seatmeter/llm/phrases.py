"""Collocations: phrases whose words stand together more often than their parts, per language.

1. Words are counted by language. A word's id is the start of the hash of language
   and word, as wide as the number of words asks for; the few words whose ids fall
   together get reserved ids, so ids are one to one.
2. Every task counts its n-grams of ids in counting quotient filters (``quotient``),
   one per part of the key space. Filters of a part are merged across tasks, in as
   many rounds as the number of parts needs; n-grams under the least count go.
   The merge undoes the permutation, so exact ids and counts come out.
3. Parts' counts meet a candidate by joins on ids (single words salted, since one
   word can begin a third of all phrases); scores are exact decimal quotients.
4. Candidates inside a longer one of enough count go; the best of each language
   are found in two steps, so that a large language is not ranked by one task.
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

from . import quotient as cqf
from . import text as tx
from .store import Store, shuffle_partitions

PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"
_ENDS, _APART = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_ENDS[list(PIECE_ENDS)] = True
_APART[list(PIECE_ENDS + BLANKS)] = True
WIDTHS = (32, 40, 48, 56, 64)
RESERVED = 1 << 16                # ids kept for words whose hash ids fall together
SALTS = 16
HELD = 1 << 20                    # n-grams that a task holds before it hands filters on
FAN = 10                          # bits of part that one round of merging adds, at most


@dataclass(frozen=True)
class Params:
    shortest: int = 2             # words of a phrase
    longest: int = 3
    least: int = 10               # occurrences of a candidate
    percent: int = 50             # of a candidate's count that a longer one must reach to replace it
    top: int = 2000               # phrases reported per language
    part_grams: int = 1 << 19     # n-grams of a part, about


@dataclass(frozen=True)
class Ids:
    """How words get ids: the leading bits of their hash, or their place among the exceptions."""

    bits: int
    exceptions: dict[tuple[str, str], tuple[int, int]]      # (lang, word) -> (hash, id)


# ---------------------------------------------------------------- words

def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document, piece) of every word; no piece spans two documents."""
    inside = ~_APART[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge], ends[edge - 1] = inside[edge], inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    document = np.searchsorted(offsets, start, side="right") - 1
    return start, end, document, np.cumsum(_ENDS[data])[start] + document if len(data) else document


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(bytes, start, end, document, piece, 64-bit hash of language and word, languages) run by run."""
    for batch in batches:
        for rows, data, offsets in tx.runs(batch, "text"):
            data = tx.lowered(data)
            start, end, document, piece = cut(data, offsets)
            langs = rows.column(rows.schema.get_field_index("lang"))
            raw, at = tx.utf8(langs)
            of_lang = tx.span_hashes(raw, at[:-1], at[1:])
            yield data, start, end, document, piece, tx.combine(of_lang[document], tx.span_hashes(data, start, end)), langs


WORDS = "lang string, word string, hash long, n long"


def _count_words(batches: Iterator[pa.RecordBatch], most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, str, str], int] = {}

    def emit():
        lists = list(zip(*[(k[1], k[2], k[0], n) for k, n in held.items()]))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(lists, (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                          ["lang", "word", "hash", "n"])

    for data, start, end, document, _, h, langs in _read(batches):
        # equal bytes share a hash; words are told apart by their own bytes at the first place of each hash
        check = tx.combine(h, tx.span_hashes(data, start, end) ^ np.uint64(0x5555555555555555))
        if not len(h):
            continue
        order = np.argsort(h, kind="stable")
        other = check[order][1:] != check[order][:-1]
        if (other & (h[order][1:] == h[order][:-1])).any():          # two words of one hash
            order = np.lexsort((check, h))
            other = check[order][1:] != check[order][:-1]
        cuts = np.flatnonzero(np.concatenate([[True], other | (h[order][1:] != h[order][:-1])]))
        first, counts = order[cuts], np.diff(np.append(cuts, len(h)))
        names, raw = langs.to_pylist(), data.tobytes()
        for k, i, n in zip(h[first].view(np.int64).tolist(), first.tolist(), counts.tolist()):
            key = (k, names[document[i]], raw[start[i]: end[i]].decode("utf-8", "replace"))
            held[key] = held.get(key, 0) + n
        if len(held) >= most:
            yield emit()
    if held:
        yield emit()
    tx.trim()


def word_ids(words: DataFrame, count: int) -> tuple[DataFrame, Ids]:
    """words with their ids, and the rule that gives them. The exceptions number at most RESERVED."""
    for bits in WIDTHS:
        if count * count >= 1 << (bits + 5) and bits < 64:
            continue                    # more than about 16 pairs would fall together
        named = words.withColumn("id", F.expr(f"shiftrightunsigned(hash, {64 - bits})"))
        top = -RESERVED if bits == 64 else (1 << bits) - RESERVED
        taken = (F.col("id") >= top) & (F.col("id") < 0) if bits == 64 else F.col("id") >= top
        shared = named.groupBy("id").agg(F.count("*").alias("_held")).filter((F.col("_held") > 1) | taken)
        rows = named.join(shared.select("id"), "id").limit(2 * RESERVED + 1).collect()
        by_id: dict[int, list] = {}
        for r in rows:
            by_id.setdefault(r.id, []).append(r)
        moved = []
        for i, group in by_id.items():
            group.sort(key=lambda r: (-r.n, r.lang, r.word))
            free = (top <= i < 0) if bits == 64 else i >= top
            moved += group if free else group[1:]
        if len(moved) > RESERVED or len(rows) > 2 * RESERVED:
            continue
        moved.sort(key=lambda r: (r.lang, r.word))
        exceptions = {(r.lang, r.word): (r.hash, top + j) for j, r in enumerate(moved)}
        if exceptions:
            spark = words.sparkSession
            table = spark.createDataFrame([(a, b, i) for (a, b), (_, i) in exceptions.items()], "lang string, word string, _id long")
            named = (named.join(F.broadcast(table), ["lang", "word"], "left")       # at most RESERVED rows
                     .withColumn("id", F.coalesce("_id", "id")).drop("_id"))
        return named, Ids(bits, exceptions)
    raise ValueError("too many words share 64-bit hashes")


# ---------------------------------------------------------------- n-grams

FILTERS = "size int, part long, filter binary"


class _Held:
    """Sorted n-grams of one size that a task holds, handed on as filters of parts."""

    def __init__(self, size: int, bits: int, head: int):
        self.size, self.bits, self.head = size, bits, head
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.rows = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.keys.append(keys)
        self.counts.append(counts)
        self.rows += keys.shape[1]
        if self.rows >= HELD:
            self.fold()
            if self.rows >= HELD // 2:
                yield from self.emit()

    def fold(self) -> None:
        keys, counts = cqf.gather(np.concatenate(self.keys, axis=1), np.concatenate(self.counts), self.bits)
        self.keys, self.counts, self.rows = [keys], [counts], keys.shape[1]

    def emit(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        self.fold()
        keys, counts = self.keys[0], self.counts[0]
        self.keys, self.counts, self.rows = [], [], 0
        parts = (keys[0] >> np.uint64(self.bits - self.head)).astype(np.int64) if self.head else np.zeros(keys.shape[1], np.int64)
        cuts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1], [True]]))
        for a in range(0, len(cuts) - 1, 64):
            spans = list(zip(cuts[a: a + 64], cuts[a + 1: a + 65]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.size] * len(spans), pa.int32()), pa.array([int(parts[s]) for s, _ in spans], pa.int64()),
                 pa.array([cqf.encode(keys[:, s:e], counts[s:e], self.bits, self.head) for s, e in spans], pa.binary())],
                ["size", "part", "filter"])


def _count_grams(batches: Iterator[pa.RecordBatch], params: Params, ids: Ids, head: int) -> Iterator[pa.RecordBatch]:
    held = {m: _Held(m, ids.bits, head) for m in range(params.shortest, params.longest + 1)}
    odd = np.array(sorted({h for h, _ in ids.exceptions.values()}), dtype=np.int64)
    for data, start, end, document, piece, h, langs in _read(batches):
        word = h >> np.uint64(64 - ids.bits)
        if len(odd):
            names = langs.to_pylist()
            for i in np.flatnonzero(np.isin(h.view(np.int64), odd)).tolist():
                key = (names[document[i]], bytes(data[start[i]: end[i]]).decode("utf-8", "replace"))
                if key in ids.exceptions:
                    word[i] = np.uint64(ids.exceptions[key][1] % (1 << 64))
        for m, h_m in held.items():
            at = np.flatnonzero(piece[m - 1:] == piece[: len(piece) - m + 1]) if len(piece) >= m else np.zeros(0, np.int64)
            if len(at):
                keys = np.stack(cqf.permute([word[at + j] for j in range(m)], ids.bits))
                yield from h_m.add(*cqf.gather(keys, np.ones(len(at), np.int64), ids.bits))
    for h_m in held.values():
        yield from h_m.emit()
    tx.trim()


def _refine(batches: Iterator[pa.RecordBatch], bits: int, head: int) -> Iterator[pa.RecordBatch]:
    """Filters that meet in a task, merged and cut into finer parts."""
    held: dict[int, _Held] = {}
    for batch in batches:
        for size, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            keys, counts, _ = cqf.decode(raw)
            yield from held.setdefault(size, _Held(size, bits, head)).add(keys, counts)
    for h in held.values():
        yield from h.emit()
    tx.trim()


def count_grams(docs: DataFrame, params: Params, ids: Ids, words: int, store: Store) -> DataFrame:
    """(size, ids, f): all n-grams of ``least`` occurrences or more. docs: lang, text; words: how many they hold."""
    head = min(ids.bits - 8, max(0, (words // params.part_grams).bit_length()))
    now = min(head, FAN)
    filters = docs.select("lang", "text").mapInArrow(partial(_count_grams, params=params, ids=ids, head=now), FILTERS)
    while now < head:
        now = min(head, now + FAN)
        filters = filters.repartition("size", "part").mapInArrow(partial(_refine, bits=ids.bits, head=now), FILTERS)

    def merge(table: pa.Table) -> pa.Table:
        keys, counts, bits = cqf.merge(table["filter"].to_pylist())
        keep = counts >= params.least
        size = table["size"][0].as_py()
        blocks = cqf.unpermute(list(keys[:, keep]), bits)
        flat = np.stack(blocks, axis=1).reshape(-1).view(np.int64) if blocks[0].size else np.zeros(0, np.int64)
        offsets = pa.array(np.arange(0, len(flat) + 1, size, dtype=np.int32))
        return pa.table({"size": pa.array([size] * int(keep.sum()), pa.int32()), "ids": pa.ListArray.from_arrays(offsets, pa.array(flat)),
                         "f": pa.array(counts[keep])})

    return store.put("grams", filters.groupBy("size", "part").applyInArrow(merge, "size int, ids array<long>, f long"))


# ---------------------------------------------------------------- the operator

def _score(a: str, left: str, right: str) -> str:
    """floor(10^6 a^2 / (l r)) in 38-digit decimals."""
    d = "cast({} as decimal(38,0))".format
    return (f"cast(cast({d(1000000)} * {d(a)} * {d(a)} as decimal(38,0)) div cast({d(left)} * {d(right)} as decimal(38,0)) as long)")


def collocations(docs: DataFrame, params: Params = Params(), store: Store | None = None) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: the best phrases of every language.

    docs: lang, text and any further columns. A-Z are lowered, texts cut into pieces at ``[.,;:!?]`` and line ends, pieces
    into words at blanks and tabs. n is the language's words; a, l, r are the occurrences of a phrase and its two parts at the
    cut of the lowest score floor(10^6 a^2 / (l r)) (ties: the earliest cut). A phrase inside a longer one of at least
    ``percent`` of its count is left out. Order: score, count, then the phrase's bytes.
    A null text is empty, a null lang counts as ``und``; repeated rows count each time; an empty table gives no rows.
    Words are told apart by 128-bit hashes within a task's batch, by their bytes everywhere else.
    """
    spark = docs.sparkSession
    st = store or Store(spark, "phrases")
    base = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    words = st.put("words", base.mapInArrow(_count_words, WORDS).groupBy("lang", "word", "hash").agg(F.sum("n").alias("n")))
    held = words.agg(F.count("*").alias("words"), F.sum("n").alias("n")).first()
    if not held.words:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    named, ids = word_ids(words, held.words)
    singles = st.put("singles", named.filter(F.col("n") >= params.least).select("id", "lang", "word", F.col("n").alias("f")))
    grams = count_grams(base, params, ids, held.n, st)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))

    # counts of both parts at every cut; a single word's count stands once for each salt
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    parts = (singles.select(F.array("id").alias("part"), F.col("f").alias("count"), F.col("lang").alias("of"), salts.alias("salt"))
             .unionAll(grams.select("ids", "f", F.lit(None).cast("string"), F.lit(0))))
    cuts = grams.select("ids", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size - 1)")).alias("k"), "size")
    salt = F.pmod(F.xxhash64("ids", F.lit(5)), F.lit(SALTS)).cast("int")
    cuts = cuts.select("ids", "a", "k", F.expr("slice(ids, 1, k)").alias("lp"), F.expr("slice(ids, k + 1, size - k)").alias("rp"),
                       F.when(F.col("k") == 1, salt).otherwise(0).alias("ls"), F.when(F.col("size") - F.col("k") == 1, salt).otherwise(0).alias("rs"))
    left = parts.select(F.col("part").alias("lp"), F.col("salt").alias("ls"), F.col("count").alias("l"), "of")
    right = parts.select(F.col("part").alias("rp"), F.col("salt").alias("rs"), F.col("count").alias("r"))
    met = cuts.join(left, ["lp", "ls"]).join(right, ["rp", "rs"]).withColumn("score", F.expr(_score("a", "l", "r")))
    scored = met.groupBy("ids").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"), F.max("a").alias("a"), F.max("of").alias("lang"))
    # the highest count of a longer phrase around each phrase
    inner = F.expr("flatten(transform(sequence(2, size - 1), w -> transform(sequence(1, size - w + 1), i -> slice(ids, i, w))))")
    around = (grams.filter("size > 2").select(F.explode(inner).alias("ids"), "f").groupBy("ids").agg(F.max("f").alias("most")))
    kept = (scored.join(around, "ids", "left").filter(f"not (100 * coalesce(most, 0) >= {params.percent} * a)")
            .select("lang", "ids", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").alias("score")))
    # the best of each language: first within slices of it, then of what these leave (ties stay)
    order = [F.desc("score"), F.desc("a")]
    lanes = F.pmod(F.xxhash64("ids"), F.lit(max(8, shuffle_partitions(spark))))
    kept = kept.withColumn("lane", lanes).withColumn("_r", F.rank().over(Window.partitionBy("lang", "lane").orderBy(*order)))
    kept = kept.filter(F.col("_r") <= params.top).withColumn("_r", F.rank().over(Window.partitionBy("lang").orderBy(*order)))
    best = st.put("best", kept.filter(F.col("_r") <= params.top).drop("lane", "_r"))
    spelled = (best.select("ids", F.posexplode("ids").alias("at", "id")).withColumn("salt", salt)
               .join(singles.select("id", "word", salts.alias("salt")), ["id", "salt"])
               .groupBy("ids").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    out = best.join(spelled, "ids").join(total, "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    return (out.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= params.top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
