"""Join-side helpers: broadcast only what is small by construction, spread what a step multiplies, and never
send what was multiplied to every task.

Every other join side is left without a hint: the files' statistics, and AQE at
run time, decide between a broadcast and a shuffle join.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tiny(df: DataFrame) -> DataFrame:
    """A side with a size bound by construction (one row, or a fixed code list): broadcast."""
    return F.broadcast(df)


def multiplied(df: DataFrame) -> DataFrame:
    """A side made by multiplying the rows of a small table: joined by sorting, never sent to all tasks.

    The planner's sizes do not count what ``explode`` multiplies, nor how well such rows pack in a file, so
    by them a list of millions of rows is still a small side.
    """
    return df.hint("merge")


def spread(df: DataFrame, *keys: str, rows: int) -> DataFrame:
    """Rows that the next step multiplies, dealt by ``keys`` so that a task gets about ``rows`` of them at most.

    The number of tasks is given outright, at least the session's shuffle partitions: a table of few bytes
    is read by one task, and AQE, which sees the bytes before the rows are multiplied, would put it back
    into one. The rows are counted for it, so what a task holds does not grow with the table.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, math.ceil(df.count() / rows)), *keys)
