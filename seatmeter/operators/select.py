"""Row selection per key: newest, peak, by priority, nearest.

All are ``row_number() over (partition by key order by ...) = 1`` with a full
tie-break, which Catalyst plans as a ``WindowGroupLimit`` before the shuffle,
so only one candidate row per key and partition crosses the network.
Keys here are tenants (many, small groups), never a handful of roots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the first row per key under ``order`` (a full ordering makes it deterministic)."""
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def latest(df: DataFrame, keys: Sequence[str], date_col: str, *tie_break) -> DataFrame:
    """Newest row per key (ties broken by ``tie_break`` descending)."""
    return first_per_key(df, keys, [F.col(date_col).desc()] + [F.col(c).desc() if isinstance(c, str) else c
                                                                 for c in tie_break])


def peak(df: DataFrame, keys: Sequence[str], metric: str, date_col: str) -> DataFrame:
    """Max metric per key, earliest date on ties."""
    return first_per_key(df, keys, [F.col(metric).desc(), F.col(date_col).asc()])


def rank_expr(col: str, priority: Sequence[str], default: int = 99) -> Column:
    """Position of ``col`` in a priority list (1-based), ``default`` when absent."""
    expr = F.lit(default)
    for i, v in reversed(list(enumerate(priority, start=1))):
        expr = F.when(F.col(col) == v, F.lit(i)).otherwise(expr)
    return expr


def pick_by_priority(df: DataFrame, keys: Sequence[str], col: str, priority: Sequence[str]) -> DataFrame:
    """Row with the best-ranked value of ``col`` per key (ties keep the same value)."""
    return first_per_key(df, keys, [rank_expr(col, priority), F.col(col)])


def nearest(df: DataFrame, keys: Sequence[str], date_col: str, target, *tie_break) -> DataFrame:
    """Row whose date is nearest to ``target`` per key; earlier date wins a tie."""
    dist = F.abs(F.datediff(F.col(date_col), F.lit(target) if not isinstance(target, Column) else target))
    return first_per_key(df, keys, [dist, F.col(date_col).asc()] + list(tie_break))


def nearest_as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], left_date: str, right_date: str,
                  values: Sequence[str]) -> DataFrame:
    """As-of join in both directions: every left row with the right row of its key nearest in time.

    Both sides go into one ordered window per key, in which the last right row before and the first
    one after a left row are carried along, so rows are never paired. The earlier one wins a tie. ``left``
    should hold each (key, date) once; on the right the largest values of a repeated date count.
    """
    keys = list(keys)
    held = [F.col(right_date).alias("_at"), *[F.col(v) for v in values]]
    r = right.select(*keys, F.col(right_date).alias("_when"), F.struct(*held).alias("_r")).filter(F.col("_when").isNotNull())
    r = r.groupBy(*keys, "_when").agg(F.max("_r").alias("_r"))
    both = left.select(*keys, F.col(left_date).alias("_when")).withColumn("_r", F.lit(None).cast(r.schema["_r"].dataType)) \
        .withColumn("_ask", F.lit(True)).unionByName(r.withColumn("_ask", F.lit(False)))
    w = Window.partitionBy(*keys).orderBy("_when").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # what comes after, as what comes before in the other direction
    back = Window.partitionBy(*keys).orderBy(F.desc("_when")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = both.withColumn("_p", F.last("_r", ignorenulls=True).over(w)).withColumn("_n", F.last("_r", ignorenulls=True).over(back))
    out = out.filter("_ask")
    gap = lambda c: F.abs(F.datediff(F.col("_when"), F.col(f"{c}._at")))
    best = F.when(F.col("_n").isNull() | (gap("_p") <= gap("_n")), F.col("_p")).otherwise(F.col("_n"))
    out = out.withColumn("_b", best)
    return out.select(*keys, F.col("_when").alias(left_date), F.col("_b._at").alias(right_date), *[F.col(f"_b.{v}").alias(v) for v in values])
