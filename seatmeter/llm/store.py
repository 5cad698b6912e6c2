"""Tables written to the cluster's shared folder, to cut lineage and to reuse results.

The folder is the session's ``spark.checkpoint.dir``. A table that a later step
no longer reads is dropped, so that a query leaves no more than its last ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


# tables written so far, by application and session
_WRITTEN: dict[tuple, list[str]] = {}


def _session(spark: SparkSession) -> tuple:
    return spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID()


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(_session(spark), []).append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete all tables that this session's operators have written; results made from them can no longer be read."""
    drop(spark, *_WRITTEN.pop(_session(spark), []))


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete written tables that nothing reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Store:
    """The tables of one query: ``put`` writes and rereads, ``drop`` deletes by name."""

    def __init__(self, spark: SparkSession, prefix: str):
        self.spark, self.prefix, self.paths = spark, prefix, {}

    def put(self, name: str, df: DataFrame, codec: str = "snappy") -> DataFrame:
        path = new_path(self.spark, f"{self.prefix}-{name}")
        df.write.option("compression", codec).parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        drop(self.spark, *(self.paths.pop(n) for n in names if n in self.paths))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
