"""A training-data pipeline over ``documents``: quality, duplicates, benchmark leaks, mixture, token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame. ``run`` writes every stage's result as Parquet into the
shared folder and gives it, read again, to the next one. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seatmeter.llm import decontaminate, minhash, mixing, quality, tokens
from seatmeter.llm.queries import table, tokenizer_path
from seatmeter.llm.ship import ship
from seatmeter.llm.store import new_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base or that the label model finds bad go."""
    ship(spark)
    return quality.filter_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8) stays."""
    ship(spark)
    return minhash.keep_one(docs, minhash.Params(shingle=5))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays as often as its fitted rate says: fewer toxic tokens, slightly more
    clean ones, low quality (filtered before) as it is."""
    ship(spark)
    params = mixing.Params(factors={"toxic": 0.4, "low": 1.0, "clean": 1.05})
    return mixing.resample(docs, table(spark, sf_dir, "labels"), params)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids are written; one row per document is read back from the files."""
    ship(spark)
    path = new_path(spark, "corpus")
    tokens.write_tokens(docs, path, tokens.Params(tokenizer=tokenizer_path()))
    return tokens.read_digests(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

# The label model and the rate fit iterate, which SQL cannot state; tests/llm checks
# the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
