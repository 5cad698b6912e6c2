"""Language of web pages by Bayesian fusion of independent evidence.

For page i and language l the posterior is proportional to

    P(text | l) * P(declared markup language | l) * P(address suffix | l) * P(l | host)

- Text: a naive Bayes model over hashed byte trigrams of the visible text,
  trained on a bounded sample of labelled documents of every language; its log-likelihood is scaled
  to at most ``evidence`` trigrams, since neighbouring trigrams are dependent.
- Declared language and suffix: likelihoods from soft counts, i.e. sums of the
  pages' text posteriors grouped by declared language and by suffix.
- Host: soft counts per host, smoothed towards those of its domain, and these
  towards those of all pages (Dirichlet smoothing, strength ``pull``).

All counts are grouped aggregates over all pages, and a page's own share is taken
out of every count that judges it, so its text is not used twice.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as tx
from .store import Store


@dataclass(frozen=True)
class Params:
    sample_docs: int = 4000       # labelled documents trained on (those with the smallest id hashes)
    least_docs: int = 50          # of these, and more if need be, for each language (all, if it has fewer)
    evidence: float = 60.0        # trigrams that a text counts for, at most
    pull: float = 10.0            # pages that a parent's share counts for in its child
    trust: float = 5.0            # pages of prior belief that declared markup tells the truth
    buckets: int = 1 << 15        # of trigrams; halved until the model, which goes to every task, fits ...
    model_bytes: int = 64 << 20   # ... (255 languages fit as it is)


HIDING = re.compile(r"<(?:(script|style)\b|(!--)|)", re.I)
CLOSING = {"script": re.compile(r"</script\s*>", re.I), "style": re.compile(r"</style\s*>", re.I), "!--": re.compile("-->")}
TAG_END = re.compile(">")
LANG = re.compile(r"\s(?:xml:)?lang\s*+=\s*+[\"']?\s*+([A-Za-z]+)", re.I)
HTML, META = re.compile(r"<html\b", re.I), re.compile(r"<meta\b", re.I)
NAMES_LANGUAGE = re.compile(r"http-equiv\s*+=\s*+[\"']?content-language", re.I)
CONTENT = re.compile(r"content\s*+=\s*+[\"']?\s*+([A-Za-z]+)", re.I)
HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)")


def visible(html: str) -> str:
    """The text outside of scripts, styles, comments and tags, each of which gives way to a blank.

    A script, style or comment without an end hides its tag only; a tag without an end stays. One pass: every
    search goes on where the last one of its kind ended, and one without a hit is not made again.
    """
    out, at, missing = [], 0, set()
    for start in HIDING.finditer(html):
        p = start.start()
        if p < at:
            continue
        end = None
        for kind, pattern, skip in (((start[1] or start[2] or "").lower(), None, start.end()), ("tag", TAG_END, p + 1)):
            if kind in missing or not kind:
                continue
            found = (pattern or CLOSING[kind]).search(html, skip)
            if found:
                end = found.end()
                break
            missing.add(kind)
        if end is None:
            if "tag" in missing:
                break                     # nothing later on can end either
            continue
        out += [html[at:p], " "]
        at = end
    return "".join([*out, html[at:]])


def _tags(html: str, opening: re.Pattern) -> Iterator[tuple[int, int]]:
    """(start, end) from an opening to the next ``>``; of openings before the same ``>`` the first, which holds the others."""
    at = 0
    while start := opening.search(html, at):
        at = html.find(">", start.end())
        at = len(html) if at < 0 else at
        yield start.end(), at


def declared_language(html: str) -> str | None:
    for s, e in _tags(html, HTML):
        if found := LANG.search(html, s, e):
            return found[1].lower()
    for s, e in _tags(html, META):
        named = NAMES_LANGUAGE.search(html, s, e)
        if named and (found := CONTENT.search(html, named.end(), e)):
            return found[1].lower()
    return None


def address(url: str | None) -> tuple[str, str, str]:
    """(host, domain, suffix): the domain is the host's last two labels, the suffix its last; '' if there is none."""
    found = HOST.match(url or "")
    if not found:
        return "", "", ""
    host = found[1].lower().rstrip(".")
    labels = host.split(".")
    return host, ".".join(labels[-2:]), "" if labels[-1].isdigit() else labels[-1]


def trigrams(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte trigram (A-Z lowered), and each text's first one (with a final total)."""
    low = tx.lowered(data).astype(np.uint64)
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    code = tx.mix((low[:-2] << np.uint64(16)) | (low[1:-1] << np.uint64(8)) | low[2:]) % np.uint64(buckets)
    size = np.maximum(np.diff(offsets) - 2, 0)
    first = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], size) + np.repeat(offsets[:-1], size)
    return code[at].astype(np.int64), first


# ---------------------------------------------------------------- text model

def _count(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for rows, data, offsets in tx.runs(batch, "text"):
            code, first = trigrams(data, offsets, p.buckets)
            for lang, a, b in zip(rows.column(0).to_pylist(), first[:-1], first[1:]):
                held.setdefault(lang, np.zeros(p.buckets, np.int64))
                held[lang] += np.bincount(code[a:b], minlength=p.buckets)
    for lang, n in held.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "bucket", "n"])


@dataclass
class TextModel:
    languages: list[str]
    log_p: np.ndarray             # (buckets, languages)


def train(docs: DataFrame, params: Params) -> TextModel:
    """Trigram model from labelled documents (doc_id, text, lang); rows without a label or text say nothing.

    A label is a language subtag of two or three letters, with or without further ones (``en``, ``DE-at``); any other
    one says nothing, so a dirty column adds no languages. All languages are kept: where the model would grow beyond
    ``model_bytes``, trigrams share fewer buckets.
    """
    label = F.regexp_extract(F.lower(F.trim("lang")), "^([a-z]{2,3})(?:[-_][a-z0-9_-]*)?$", 1)
    known = docs.select("doc_id", label.alias("lang"), "text").filter("lang <> '' and text is not null")
    held = known.select("lang").distinct().count()
    while params.buckets > 1 << 8 and 8 * params.buckets * held > params.model_bytes:
        params = replace(params, buckets=params.buckets // 2)
    hashed = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    first = hashed.orderBy("h", "doc_id").limit(params.sample_docs)
    # the languages with too few of these rows are rare ones, so no window holds a large part of the documents
    full = first.groupBy("lang").count().filter(F.col("count") >= params.least_docs).select("lang")
    ranked = (hashed.join(F.broadcast(full), "lang", "left_anti")
              .withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))))
    rare = ranked.filter(F.col("nth") <= params.least_docs)
    chosen = first.select("doc_id").unionAll(rare.select("doc_id")).distinct()
    sample = known.join(F.broadcast(chosen), "doc_id", "left_semi").select("lang", "text")
    # at most buckets rows a language
    table = (sample.mapInArrow(partial(_count, p=params), "lang string, bucket long, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    languages = sorted(table["lang"].unique().to_pylist())
    n = np.zeros((params.buckets, len(languages)))
    if languages:
        at = pc.index_in(table["lang"], pa.array(languages, table["lang"].type)).to_numpy()
        np.add.at(n, (table["bucket"].to_numpy(), at), table["n"].to_numpy())
    return TextModel(languages, np.log((n + 0.5) / (n.sum(axis=0) + 0.5 * params.buckets)))


SCORED = "page_id long, host string, domain string, suffix string, declared string, log_text array<double>"


def _score(batches: Iterator[pa.RecordBatch], model, p: Params) -> Iterator[pa.RecordBatch]:
    log_p, k = model.value.log_p, len(model.value.languages)
    for batch in batches:
        for a in range(0, batch.num_rows, 512):
            rows = batch.slice(a, 512)
            pages = [x or "" for x in rows.column(2).to_pylist()]
            data, offsets = tx.utf8(pa.array([visible(x) for x in pages], pa.large_string()))
            code, first = trigrams(data, offsets, p.buckets)
            score = np.zeros((len(pages), k))
            full = np.flatnonzero(np.diff(first))
            if len(full):
                score[full] = np.add.reduceat(log_p[code], first[:-1][full], axis=0)
                n = np.diff(first)[full]
                score[full] *= (np.minimum(n, p.evidence) / n)[:, None]
            score -= score.max(axis=1, keepdims=True) if k else 0
            host, domain, suffix = zip(*(address(u) for u in rows.column(1).to_pylist()))
            known = {x: x for x in model.value.languages}
            declared = [d if d is None else known.get(d, "other") for d in map(declared_language, pages)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(host), pa.array(domain), pa.array(suffix), pa.array([d or "none" for d in declared]),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, score.size + 1, max(k, 1), dtype=np.int32)[: len(pages) + 1] if k else np.zeros(len(pages) + 1, np.int32)),
                                          pa.array(score.reshape(-1)))],
                ["page_id", "host", "domain", "suffix", "declared", "log_text"])


# ---------------------------------------------------------------- fusion

def identify(pages: DataFrame, labelled: DataFrame, params: Params = Params(), store: Store | None = None) -> DataFrame:
    """One row per page: page_id, host, suffix, declared, text_language, text_probability, language, probability.

    pages: page_id, url, html; labelled: doc_id, text, lang; further columns are ignored. A null
    or empty html has no text evidence (all languages alike) and no declaration; a null url has
    the empty host. Repeated rows and null page_ids get a row each. Without labelled documents
    the languages are null. Ties go to the first language in alphabetical order.
    """
    st = store or Store(pages.sparkSession, "language")
    model = train(labelled, params)
    names, k = model.languages, len(model.languages)
    params = replace(params, buckets=len(model.log_p))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast(model)
    scored = base.mapInArrow(partial(_score, model=shared, p=params), SCORED)
    if not k:
        none = F.lit(None)
        return scored.select("page_id", "host", "suffix", "declared", none.cast("string").alias("text_language"),
                             none.cast("double").alias("text_probability"), none.cast("string").alias("language"), none.cast("double").alias("probability"))
    # shared terms are columns of their own: inside one another, expressions would grow with a power of the languages
    add = lambda a, x: a + x
    scored = scored.withColumn("all", F.aggregate("log_text", F.lit(0.0), lambda a, x: a + F.exp(x)))
    scored = st.put("scored", scored.select("page_id", "host", "domain", "suffix", "declared", *[F.col("log_text")[i].alias(f"t_{i}") for i in range(k)],
                                            *[(F.exp(F.col("log_text")[i]) / F.col("all")).alias(f"q_{i}") for i in range(k)]))
    sums = lambda source, to: [F.sum(f"{source}_{i}").alias(f"{to}_{i}") for i in range(k)]
    hosts = scored.groupBy("host", "domain", "suffix").agg(*sums("q", "h"))
    hosts = st.put("hosts", hosts)
    domains = hosts.groupBy("domain").agg(*sums("h", "d"))
    suffixes = hosts.groupBy("suffix").agg(*sums("h", "s"))
    n_suffixes = max(1, suffixes.count())
    everything = hosts.agg(*sums("h", "a")).first()
    total = [x or 0.0 for x in everything]
    by_host = hosts.join(domains, "domain").join(suffixes, "suffix").drop("domain", "suffix")
    by_markup = scored.groupBy("declared").agg(*sums("q", "m"))          # one row per known language, and two more
    mass = lambda name: F.aggregate(F.array(*[f"{name}_{i}" for i in range(k)]), F.lit(0.0), add)
    joined = scored.join(by_host.withColumns({"mass_h": mass("h"), "mass_d": mass("d")}), "host").join(by_markup, "declared")

    logs = []
    for i, name in enumerate(names):
        own = F.col(f"q_{i}")
        rest = total[i] - own                                                # other pages of the language
        everywhere = (rest + 1) / (sum(total) - 1 + k)
        in_domain = (F.col(f"d_{i}") - own + params.pull * everywhere) / (F.col("mass_d") - 1 + params.pull)
        in_host = (F.col(f"h_{i}") - own + params.pull * in_domain) / (F.col("mass_h") - 1 + params.pull)
        markup = ((F.col(f"m_{i}") - own + 1 + F.when(F.col("declared") == name, params.trust).otherwise(0.0))
                  / (rest + k + 2 + params.trust))
        suffix = (F.col(f"s_{i}") - own + 1) / (rest + n_suffixes)
        least = F.lit(1e-12)                                                 # differences of sums can fall just below 0
        logs.append(F.col(f"t_{i}") + reduce(lambda a, b: a + b, (F.log(F.greatest(x, least)) for x in (in_host, markup, suffix))))
    named = F.array(*[F.lit(n) for n in names])
    fused = joined.select("page_id", "host", "suffix", "declared", F.array(*logs).alias("_log"),
                          F.array(*[F.round(f"q_{i}", 6) for i in range(k)]).alias("_q"))
    fused = fused.withColumn("_top", F.array_max("_log"))
    fused = fused.withColumn("_e", F.transform("_log", lambda x: F.exp(x - F.col("_top"))))
    fused = fused.withColumn("_sum", F.aggregate("_e", F.lit(0.0), add))
    out = fused.withColumn("_p", F.transform("_e", lambda x: F.round(x / F.col("_sum"), 6)))
    best = lambda c: F.element_at(named, F.array_position(c, F.array_max(c)).cast("int"))
    return out.select("page_id", "host", "suffix", "declared", best("_q").alias("text_language"), F.array_max("_q").alias("text_probability"),
                      best("_p").alias("language"), F.array_max("_p").alias("probability"))
