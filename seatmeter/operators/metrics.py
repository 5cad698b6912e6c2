"""Tenant metrics by any set of dimensions (Q1, Q2) from one deduplicated table.

``tenant_days`` has one row per day, tenant and combination of dimension values, with flags and sums that can be
merged. Every metric of every dimension set is read from it: flags are merged per (day, dimensions, tenant), then
counted, so a distinct count needs no copy of the rows per metric or per set, and a tenant that shows
twice in a group counts once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = ("root", "plan_name", "billing_status", "partner_pricing", "dmarc_management")


def _billable() -> Column:
    return F.col("billing_status").isin("Active", "Active-POC") & F.col("approved")


# metric -> (flag of a tenant, or None; sum of a tenant, or None) over snapshot columns
COUNTS = {
    "tenant_count": lambda: F.lit(True),
    "billable_tenant_count": _billable,
    "poc_tenant_count": lambda: F.col("billing_status") == "Active-POC",
    "inactive_tenant_count": lambda: F.col("billing_status") == "Inactive",
    "dmarc_enabled_count": lambda: F.col("dmarc_management") == F.lit(True),
}
SUMS = {
    "total_active_profiles": lambda: F.col("active_profiles"),
    "total_shared_profiles": lambda: F.col("shared_profiles"),
    "net_billable_seats": lambda: F.when(_billable(), F.coalesce("active_profiles", F.lit(0)) - F.coalesce("shared_profiles", F.lit(0))),
}


def tenant_days(history: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """One row per (record_date, tenant, dimension values) with every flag and sum."""
    rows = history.select("record_date", "tenant_global_id", *dimensions,
                          *[F.coalesce(c(), F.lit(False)).alias(f"_{n}") for n, c in COUNTS.items()],
                          *[c().alias(f"_{n}") for n, c in SUMS.items()])
    return rows.groupBy("record_date", "tenant_global_id", *dimensions).agg(
        *[F.bool_or(f"_{n}").alias(n) for n in COUNTS], *[F.sum(f"_{n}").alias(n) for n in SUMS])


def spine(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end`` (columns of a one-row frame), both included (Q5); none if a bound is NULL."""
    return bounds.filter(F.col(start) <= F.col(end)).select(F.explode(F.sequence(start, end)).alias("date_day"))


def metric(days: DataFrame, names: Sequence[str], group_by: Sequence[str] = ()) -> DataFrame:
    """The named metrics by day and the dimensions of ``group_by``, from ``tenant_days``."""
    unknown = [n for n in names if n not in COUNTS and n not in SUMS]
    if unknown:
        raise ValueError(f"unknown metrics: {unknown}")
    counts, sums = [n for n in names if n in COUNTS], [n for n in names if n in SUMS]
    per = days.groupBy("record_date", *group_by, "tenant_global_id").agg(
        *[F.bool_or(n).alias(n) for n in counts], *[F.sum(n).alias(n) for n in sums])
    return per.groupBy("record_date", *group_by).agg(
        *[(F.count_if(n) if n in counts else F.sum(n)).cast("bigint").alias(n) for n in names])
