"""Secret scan with multipart credential linking.

Base spans (assigned secrets, access identifiers, long hex strings) are found by
pattern. The linking step then looks at weak candidates, which on their own say
little: identifier-like tokens (role access), random-looking tokens (role
secret) and endpoints (addresses of hosts). Within a scope - spans at most
``scope`` code points apart in one text - a weak candidate is reported only when
parts of both other roles co-occur with it. Base spans take part in the linking
in their roles (access: access; assign, hex: secret) and always stay.

The interval join is over each text's parts in order of position: the nearest
part of each role before and after a candidate decides (two running extremes
per role), so no pairs are made, whatever the number of parts in a scope.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import Store

# The base patterns and the least lengths of what they match.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
# only long runs matter, and a run of them has no shorter match inside it
LONG_HEX = re.compile(r"[0-9a-f]{32,}")
NAMES = ("passw", "secret", "token", "apikey", "api_key")

# Weak candidates.
WEAK_ACCESS = re.compile(r"(?<![A-Za-z0-9])(?=[A-Z]*[0-9])[A-Z0-9]{16,40}(?![A-Za-z0-9])")
# a whole run, read once; that it holds a digit, a capital and a small letter is tested on what was matched
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}+(?![A-Za-z0-9+/_=-])")
CLASSES = (re.compile("[0-9]"), re.compile("[A-Z]"), re.compile("[a-z]"))
# Addresses, numeric hosts, and named hosts under any suffix, in either case. Each alternative starts only at the
# start of a run, so that a long run is read once; the endpoint is the group, if there is one.
ENDPOINT = re.compile(r"(?<![A-Za-z0-9+.-])[0-9+.-]*+([A-Za-z][A-Za-z0-9+.-]*+://[^\s\"'<>]+)"
                      r"|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]+)?(?!\.?[0-9])"
                      r"|(?<![A-Za-z0-9.-])(?:[A-Za-z0-9-]++\.)+(?:(?:[A-Za-z]{2,63}|[Xx][Nn]--[A-Za-z0-9-]+)(?::[0-9]+)?"
                      r"|[A-Za-z][A-Za-z0-9-]*:[0-9]+)(?!\.?[A-Za-z0-9-])")
KINDS = ("assign", "access", "hex", "weak_access", "weak_secret", "endpoint")
ROLE = {"assign": "secret", "access": "access", "hex": "secret", "weak_access": "access", "weak_secret": "secret",
        "endpoint": "endpoint"}


@dataclass(frozen=True)
class Params:
    scope: int = 200       # code points between two parts of one credential, at most


Span = tuple[int, int, int]  # start, rank of the kind in KINDS, end


def base_spans(text: str) -> list[Span]:
    """Base spans of one text in code points, by start, then kind."""
    found: list[Span] = []
    low = text.lower() if text.isascii() else None
    if low is None or any(n in low for n in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def weak_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak candidates: identifiers and random-looking tokens outside the base spans, and all endpoints.

    A base span inside an address (?token=..., a long id in the path) says what the address opens,
    so the address stays an endpoint.
    """
    ends = [(m.start(m.lastindex or 0), 5, m.end()) for m in ENDPOINT.finditer(text)] if "." in text or "://" in text else []
    roles = {ROLE[KINDS[k]] for _, k, _ in base}
    # a candidate needs the two other roles; without an endpoint only endpoints could be reported
    if not ends:
        return []
    weak = [(m.start(), 3, m.end()) for m in WEAK_ACCESS.finditer(text)]
    if not weak and "access" not in roles:
        return []
    weak += [(m.start(), 4, m.end()) for m in WEAK_SECRET.finditer(text) if all(c.search(m[0]) for c in CLASSES)]
    starts = [s for s, _, _ in base]                                         # base is sorted
    reach = list(accumulate((e for _, _, e in base), max))                   # the furthest end so far

    def free(s: int, e: int) -> bool:
        before = bisect_left(starts, e)                                      # base spans that start before e
        return not before or reach[before - 1] <= s

    return sorted([w for w in weak if free(w[0], w[2])] + ends)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


SPAN = "array<struct<s:int,k:int,e:int>>"
SCANNED = f"doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, base {SPAN}, weak {SPAN}"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))
    dicts = lambda spans: [{"s": s, "k": k, "e": e} for s, k, e in spans]
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            ids, texts = (c.slice(a, 256) for c in batch.columns[:2])
            rows = []
            for text in texts.to_pylist():
                base = base_spans(text or "")
                rows.append((base, weak_spans(text or "", base)))
            count = [[sum(k == n for _, k, _ in b) for b, _ in rows] for n in range(3)]
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, pa.int64()) for c in count),
                 pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in rows]),
                 pa.array([dicts(b) for b, _ in rows], kind), pa.array([dicts(w) for _, w in rows], kind)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "weak"])


def linked(parts: DataFrame, scope: int) -> DataFrame:
    """Weak parts with parts of both other roles in their scope.

    parts: row (key of a text), s, k, e, role, weak. Returns row, s, k, e of the weak parts to report.
    """
    before = Window.partitionBy("row").orderBy("s", "k", "e").rowsBetween(Window.unboundedPreceding, -1)
    # what follows, as what comes before in the other direction: a frame that only grows is kept up in one pass
    after = Window.partitionBy("row").orderBy(F.desc("s"), F.desc("k"), F.desc("e")).rowsBetween(Window.unboundedPreceding, -1)
    near = {}
    for role in ("access", "secret", "endpoint"):
        own = F.col("role") == role
        gap_before = F.col("s") - F.max(F.when(own, F.col("e"))).over(before)
        gap_after = F.min(F.when(own, F.col("s"))).over(after) - F.col("e")
        near[role] = F.coalesce(gap_before <= scope, F.lit(False)) | F.coalesce(gap_after <= scope, F.lit(False))
    marked = parts.select("*", *[v.alias(f"near_{k}") for k, v in near.items()])
    both = F.lit(True)
    for role in near:
        both = both & ((F.col("role") == role) | F.col(f"near_{role}"))
    return marked.filter(F.col("weak") & both).select("row", "s", "k", "e")


def scan_secrets(docs: DataFrame, params: Params = Params(), store: Store | None = None) -> DataFrame:
    """One row per document: base counts and hash, and all spans with the linked weak ones.

    docs: doc_id, text; further columns are ignored. Returns doc_id, n_assign, n_access, n_hex,
    base_sha256 (of the base spans as text), spans ("kind:start:end", by start, then kind, joined
    by commas, code points, end exclusive), n_linked. A null text counts as empty; texts without
    spans give zeros and an empty list; repeated rows and null doc_ids give a row each.
    """
    st = store or Store(docs.sparkSession, "secrets")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the written table gives every row a key that stays the same for all later reads
    scanned = st.put("scanned", base.mapInArrow(_scan, SCANNED).withColumn("row", F.monotonically_increasing_id()))
    wide = scanned.filter("size(weak) > 0")
    own = wide.select("row", F.explode("base").alias("x"), F.lit(False).alias("weak"))
    new = wide.select("row", F.explode("weak").alias("x"), F.lit(True).alias("weak"))
    role = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("x.k") + 1)
    parts = own.unionAll(new).select("row", "x.*", role.alias("role"), "weak")
    found = linked(parts, params.scope).groupBy("row").agg(F.collect_list(F.struct("s", "k", "e")).alias("more"))
    every = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(SPAN))))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    spans = F.array_join(F.transform(every, lambda x: F.concat_ws(":", F.element_at(kinds, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")
    return (scanned.join(found, "row", "left")
            .select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", spans.alias("spans"),
                    F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_linked")))
