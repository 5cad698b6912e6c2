"""Incremental loads (G2): a stored target that knows how far it has come.

The rows of a load are written to a folder of their own. A load counts once its commit exists: a small
numbered file that names the folder and the largest timestamp loaded so far. Rows and high-watermark
so become visible in one step; a load that died before has left an unnamed folder, which nobody reads,
and the next one starts again from the last commit. Repeating a load finds no newer rows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .sinks import _fs, hold_schema, read_text, write_new


class Target:
    """A table that grows by loads of rows newer than its high-watermark in column ``ts``."""

    def __init__(self, spark: SparkSession, path: str, ts: str):
        self.spark, self.path, self.ts = spark, path.rstrip("/"), ts

    def commits(self) -> list[dict]:
        """All commits in order: folder, high (timestamp as text, or None), rows."""
        fs, folder = _fs(self.spark, f"{self.path}/_commits")
        if not fs.exists(folder):
            return []
        names = sorted(x.getPath().getName() for x in fs.listStatus(folder))
        return [json.loads(read_text(self.spark, f"{self.path}/_commits/{n}")) for n in names if n.endswith(".json")]

    def load(self, source: DataFrame) -> int:
        """Add the source's rows that are newer than all loaded ones (the first load: all rows); how many there were."""
        hold_schema(self.spark, self.path, source.schema)
        done = self.commits()
        high = done[-1]["high"] if done else None
        new = source if high is None else source.filter(F.col(self.ts) > F.lit(high).cast(source.schema[self.ts].dataType))
        folder = f"{self.path}/load-{uuid.uuid4().hex}"
        new.write.parquet(folder)
        row = self.spark.read.schema(source.schema).parquet(folder).agg(F.count("*").alias("n"), F.max(self.ts).cast("string").alias("high")).first()
        commit = {"folder": folder, "high": row.high or high, "rows": row.n}
        if not row.n or not write_new(self.spark, f"{self.path}/_commits/{len(done) + 1:08d}.json", json.dumps(commit)):
            fs, gone = _fs(self.spark, folder)
            fs.delete(gone, True)
            if row.n:
                raise RuntimeError(f"{self.path}: another load was committed meanwhile")
        return row.n

    def read(self) -> DataFrame:
        """All committed rows; an empty frame before the first load (the contract must exist)."""
        schema = StructType.fromJson(json.loads(read_text(self.spark, f"{self.path}/_contract.json")))
        folders = [c["folder"] for c in self.commits()]
        reader = self.spark.read.schema(schema)
        return reader.parquet(*folders) if folders else self.spark.createDataFrame([], schema)
