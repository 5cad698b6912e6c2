"""Sinks and materialisation (M2-M4).

``materialize`` writes a reused intermediate table as Parquet into the
cluster's shared ``spark.checkpoint.dir`` and reads it back. That cuts the
lineage (a lost executor re-reads the file instead of recomputing the whole
upstream plan), computes the table in a single job (``checkpoint()`` without a
cache runs the plan twice), and gives the planner real file sizes, so small
results are broadcast and large ones stay shuffle joins.
``write_day`` replaces one billing day idempotently.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir


_WRITTEN: dict[tuple, list[str]] = {}


def _session(spark) -> tuple:
    return spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID()


def _fs(spark, path: str):
    """(file system, path) of the JVM."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def read_text(spark, path: str) -> str | None:
    """A small file's content; None if there is no such file."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark, path: str, text: str) -> bool:
    """Write a small file that must not exist yet, whole or not at all; False if another writer was first."""
    fs, target = _fs(spark, path)
    _, draft = _fs(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        return False
    return True


def release(spark) -> None:
    """Delete the tables that ``materialize`` has written for this session."""
    for path in _WRITTEN.pop(_session(spark), []):
        fs, target = _fs(spark, path)
        fs.delete(target, True)


def materialize(df: DataFrame, name: str = "t", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    ``partition_by`` lays the table out by that column (e.g. the snapshot day),
    so later literal filters on it prune whole directories.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    _WRITTEN.setdefault(_session(spark), []).append(path)
    out = spark.read.parquet(path)
    # partition discovery puts the partition column last; keep the logical column order
    return out.select(*df.columns) if partition_by else out


class SchemaDrift(ValueError):
    """A frame whose columns are not those of the table it should go into."""


def hold_schema(spark, path: str, schema: StructType) -> None:
    """Compare a frame's columns with the table's contract, which the first write of a table lays down.

    Order does not matter; a missing, a further or a retyped column is refused before anything is written.
    """
    place = f"{path.rstrip('/')}/_contract.json"
    held = read_text(spark, place)
    if held is None:
        fs, target = _fs(spark, path)
        fs.mkdirs(target)
        if write_new(spark, place, schema.json()):
            return
        held = read_text(spark, place)
    want = {f.name: f.dataType.simpleString() for f in StructType.fromJson(json.loads(held)).fields}
    have = {f.name: f.dataType.simpleString() for f in schema.fields}
    wrong = ([f"{c} is missing" for c in want if c not in have] + [f"{c} is new" for c in have if c not in want]
             + [f"{c} is {have[c]}, not {want[c]}" for c in want if c in have and have[c] != want[c]])
    if wrong:
        raise SchemaDrift(f"{path}: {'; '.join(wrong)}")


def write_day(df: DataFrame, path: str, date_col: str = "billing_date", fmt: str = "parquet",
              days=None, within: str | None = None) -> None:
    """Replace only the billing days present in ``df`` (delete+insert by day, M2/M3).

    Dynamic partition overwrite: re-running a day leaves one copy of it and
    every other day untouched (the self-append of the reference, M4, would
    duplicate rows on re-run). ``days`` lists the days this run owns; a listed
    day with no rows any more has its old partition removed, so an emptied day
    does not keep stale rows. ``within`` names a column that a day is further divided by; the listed
    days then keep no division without rows. A frame of other columns than the table's is refused
    (``SchemaDrift``) and changes nothing.
    """
    spark = df.sparkSession
    hold_schema(spark, path, df.schema)
    parts = [date_col, within] if within else [date_col]
    if days:
        # computed once: what is written and which of the run's days are in it come from one stored table
        df = materialize(df, "day")
    # no repartition by the day: a daily run writes one day, which would funnel every row into
    # one task; each task writes its own files into the day's directory instead
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).format(fmt).save(path)
    if days:
        # one row per day, or per day and division
        present = {tuple(r) for r in df.filter(F.col(date_col).isin(*days)).select(*parts).distinct().collect()}
        for day in days:
            fs, folder = _fs(spark, f"{path.rstrip('/')}/{date_col}={day.isoformat()}")
            if not fs.exists(folder):
                continue
            if day not in {p[0] for p in present}:
                fs.delete(folder, True)
            elif within:
                keep = {f"{within}={p[1]}" for p in present if p[0] == day}
                for x in fs.listStatus(folder):
                    name = x.getPath().getName()
                    if name.startswith(f"{within}=") and name not in keep:
                        fs.delete(x.getPath(), True)


def unite(stored: DataFrame, new: DataFrame, date_col: str) -> DataFrame:
    """Set union of a stored table, itself a set, with newer rows (T10): days before the first new one stay as they are,
    without a shuffle; the rest is united and deduplicated."""
    first = new.agg(F.min(date_col)).scalar()             # a scalar subquery, evaluated once
    late = stored.filter(F.col(date_col) >= first)
    early = stored.filter(first.isNull() | (F.col(date_col) < first) | F.col(date_col).isNull())
    return early.unionByName(late.unionByName(new).distinct())


def read_days(spark, path: str, fmt: str = "parquet", date_col: str = "billing_date", days=None) -> DataFrame:
    """Read a day-partitioned sink back; ``days`` prunes partitions."""
    df = spark.read.format(fmt).load(path)
    if days is not None:
        df = df.filter(F.col(date_col).isin(*days))
    return df
