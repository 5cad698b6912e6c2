"""Registered queries of the operators, and their DuckDB SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language, licenses, minhash, mixing, mtree, phrases, pieces, quality, secrets, substring, tokens, warc
from .ship import ship
from .store import new_path, release  # noqa: F401  (release: for callers that want the written tables gone)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words of 35-word windows that stand anywhere else."""
    return (substring.dedup_substrings(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256")))


ORACLE["op1_substring_dedup"] = """
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35)),
r AS (SELECT doc_id, i FROM g WHERE g IN (SELECT g FROM g GROUP BY g HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, i + j AS pos FROM r, range(35) t(j)),
n AS (SELECT doc_id, count(*) AS cut FROM c GROUP BY doc_id),
u AS (SELECT doc_id, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS i FROM w),
k AS (
  SELECT u.doc_id, string_agg(v, ' ' ORDER BY i) AS kept
  FROM u ANTI JOIN c ON u.doc_id = c.doc_id AND u.i = c.pos GROUP BY u.doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(cut, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures, rule votes, posterior and verdict of all documents."""
    return quality.judge(table(spark, sf_dir, "documents"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all pages, from text, markup, address and host."""
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, with weak parts linked within scopes."""
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


@query
def op5_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as dictionary-compressed token ids, and read back."""
    path = new_path(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, tokens.Params(tokenizer=tokenizer_path()))
    return tokens.read_digests(spark, path)


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named in all documents."""
    return (licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.Params(windows=True))
            .select("doc_id", "license", F.round("dice", 9).alias("dice"), "unit", "n_matches", "licenses"))


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors, fitted rates and copies of all documents."""
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records in a chunked table, and read back."""
    path = new_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return (warc.read_archives(spark, path)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


ORACLE["op9_warc_archive"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


@query
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items contained in documents, by five-word shingles."""
    return decontaminate.find_benchmark_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op10_benchmark_decontamination"] = """
WITH t AS (
  SELECT 0 AS side, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (
  SELECT side, id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM t),
s AS (
  SELECT DISTINCT side, id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT side, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
q AS (SELECT id, count(*) AS n FROM s WHERE side = 1 GROUP BY id),
j AS (
  SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared
  FROM s b JOIN s d ON d.side = 0 AND b.side = 1 AND b.g = d.g GROUP BY ALL)
SELECT doc_id, item_id, CAST(floor(log2(n)) AS INTEGER) AS size_partition, n AS item_shingles,
       shared AS shared_shingles, shared / n AS containment
FROM j JOIN q ON q.id = item_id WHERE 100 * shared >= 80 * n
"""


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents over two-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Params(shingle=2))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut and arranged as piece tables, and rebuilt from the output."""
    arranged = pieces.fill_in_middle(table(spark, sf_dir, "documents"))
    return pieces.restore(arranged, text=False).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


ORACLE["op11_fill_in_middle"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS x FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
         list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(x, i, 8) AS BIGINT)) AS h FROM d),
c AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
         greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
              WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT *, array_to_string(list_slice(u, 1, a), '') AS pre, array_to_string(list_slice(u, a + 1, b), '') AS mid,
         array_to_string(list_slice(u, b + 1, n), '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE WHEN form = 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""


@query
def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten rows of highest inner product for every row whose id is divisible by 100."""
    return mtree.top_k(table(spark, sf_dir, "embeddings"))


ORACLE["op13_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, o.vec_id, CAST(list_dot_product(q.e, o.e) AS BIGINT) AS score
  FROM v q JOIN v o ON q.vec_id % 100 = 0 AND q.vec_id <> o.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2000 phrases of two or three words of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLE["op12_phrase_collocations"] = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, range(1, 4) t(m))),
c AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM c WHERE m = 1 GROUP BY lang),
a AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM c WHERE m > 1 AND f >= 10),
k AS (
  SELECT lang, m, phrase, a, k, array_to_string(ws[1 : k], ' ') AS lp, array_to_string(ws[k + 1 : m], ' ') AS rp
  FROM a, range(1, 3) t(k) WHERE k < m),
s AS (
  SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r,
         CAST(CAST(1000000 AS HUGEINT) * k.a * k.a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM k JOIN c l ON l.lang = k.lang AND l.phrase = k.lp JOIN c r ON r.lang = k.lang AND r.phrase = k.rp),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pick FROM s),
o AS (
  SELECT lang, phrase, max(a) AS longest FROM (
    SELECT lang, a, unnest([array_to_string(ws[1 : 2], ' '), array_to_string(ws[2 : 3], ' ')]) AS phrase FROM a WHERE m = 3)
  GROUP BY ALL),
t AS (
  SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score,
         row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
  FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE pick = 1 AND NOT coalesce(100 * longest >= 50 * b.a, false))
SELECT t.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM t JOIN n USING (lang) WHERE rank <= 2000
"""
