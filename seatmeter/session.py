"""Spark session helpers.

The library never creates its own cluster settings; it only fills in what a
local test run needs when the caller left it unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the billing jobs rely on; applied only where the session has none (a cluster's own
# configuration wins).
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Local runs only (tests, bench): size post-shuffle partitions by an advisory size instead of by core
# count, so tiny shuffles collapse to one task while mid-size ones still split.
_LOCAL = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(8 * 1024 * 1024),
}


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "seatmeter") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**_DEFAULTS, **_LOCAL}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant folder
    and is used as is (a cluster session without it is an error). Only a local
    session without it (tests) gets a scratch folder for the run.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        # a machine-local folder would not be shared by the executors of a cluster
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (the materialised tables are written there)")
    path = tempfile.mkdtemp(prefix="seatmeter-ckpt-", dir=os.environ.get("SEATMETER_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Fill in the library's defaults on an existing session without overriding.

    The session time zone is left alone: input timestamps are read as
    TIMESTAMP_NTZ, so day boundaries do not depend on it.
    """
    for k, v in _DEFAULTS.items():
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # static conf on a running session: leave it
            pass
    ensure_checkpoint_dir(spark)
    return spark
