"""Peak-seat (high-watermark) selection for the billing month.

Every step is partitioned by tenant: a tenant has at most ~31 rows in a
billing window, so the windows below are small and share a single shuffle on
``tenant_global_id`` (Catalyst reuses the partitioning for all of them).
Window bounds are computed on the driver and applied as literals, so the
date filter reaches the scan / partition pruning.
"""

from __future__ import annotations

import datetime as dt

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date, billing_window
from . import select

# Plan priority, most expensive first.
PLAN_PRIORITY = [
    "Complete Protect",
    "Email Protect",
    "Core",
    "Platform Protect",
    "SAT Suite",
    "Phishing Simulation and Training",
    "Starter",
]
BILLABLE_STATUS = ["Active", "Active-POC"]
NO_PLAN = "No_Plan"


def snapshot(meta: DataFrame, as_of, tracked_only: bool = True) -> DataFrame:
    """Current snapshot of the account meta (G4): snapshot_date = as_of, tracked."""
    out = meta.filter(F.col("snapshot_date") == F.lit(as_date(as_of)))
    return out.filter(F.col("is_tracked")) if tracked_only else out


def seats(profile_type: str = "profile_type") -> F.Column:
    """Seat count of one snapshot row by the root's profile type (H3), NULL -> 0."""
    pt = F.col(profile_type)
    a, lic, sh = F.col("active_profiles"), F.col("licensed_profiles"), F.col("shared_profiles")
    return (F.when(pt == "active", F.coalesce(a, F.lit(0)))
            .when(pt == "license", F.coalesce(lic, F.lit(0)))
            .when(pt == "shared", F.coalesce(a - F.coalesce(sh, F.lit(0)), F.lit(0))))


def billable_rows(history: DataFrame, as_of, require_plan: bool = True) -> DataFrame:
    start, end = billing_window(as_of)
    cond = (F.col("record_date").between(F.lit(start), F.lit(end)) & F.col("approved")
            & F.col("billing_status").isin(*BILLABLE_STATUS))
    if require_plan:
        cond = cond & (F.col("plan_name") != NO_PLAN)
    return history.filter(cond)


def profile_metrics(history: DataFrame, meta: DataFrame, as_of) -> DataFrame:
    """Window rows with the newest root of each tenant and its seat metric (H1-H3)."""
    live = billable_rows(history, as_of)
    # newest root wins for every day of the tenant (re-parenting); one row per tenant-day
    resolved = live.withColumn("resolved_root", F.max_by("root", "record_date").over(
        Window.partitionBy("tenant_global_id")))
    m = meta.select(F.col("tenant_global_id").alias("resolved_root"), "profile_type", "is_highwatermark")
    return resolved.join(m, "resolved_root").select(
        "record_date", F.col("resolved_root").alias("root"), "tenant_global_id", "profile_type",
        "is_highwatermark", "plan_name", seats().alias("profile_count"))


def restrict_to_top_plan(pm: DataFrame, priority: Sequence[str] = PLAN_PRIORITY) -> DataFrame:
    """Tenants with several plans keep only the rows of their most expensive plan (H4-H6).

    The reference also bounds those rows by the plan's first..last date, which
    every row of that plan satisfies, so the plan filter alone is equivalent.
    """
    w = Window.partitionBy("tenant_global_id", "is_highwatermark")
    ranked = pm.withColumn("_rank", select.rank_expr("plan_name", priority))
    best = F.min(F.struct(F.col("_rank"), F.col("plan_name"))).over(w)
    multi = F.min("plan_name").over(w) != F.max("plan_name").over(w)
    return (ranked.withColumn("_best", best.getField("plan_name")).withColumn("_multi", multi)
            .filter(~F.col("_multi") | (F.col("plan_name") == F.col("_best")))
            .drop("_rank", "_best", "_multi"))


def month_picks(history: DataFrame, meta: DataFrame, as_of, priority: Sequence[str] = PLAN_PRIORITY,
                meta_as_of=None) -> DataFrame:
    """(tenant_global_id, record_date, is_highwatermark): the day each tenant is billed on (H1-H9).

    Peak tenants: the day of max seats (earliest on ties). Others: the run date.
    ``meta_as_of`` picks the meta snapshot when it differs from the run date
    (fixed-period backfills price with the current meta, H15).
    """
    end = as_date(as_of)
    rows = restrict_to_top_plan(profile_metrics(history, snapshot(meta, meta_as_of or as_of), as_of), priority)
    w = Window.partitionBy("tenant_global_id")
    # one pass: peak tenants order by seats, the others by date; first row wins
    ordered = rows.withColumn("_rn", F.row_number().over(w.orderBy(
        F.when(F.col("is_highwatermark"), -F.col("profile_count")).otherwise(F.lit(0)),
        F.when(F.col("is_highwatermark"), F.col("record_date")).otherwise(F.lit(None)).asc(),
        F.col("record_date").desc())))
    picked = ordered.filter((F.col("_rn") == 1) & F.col("is_highwatermark").isNotNull())
    return picked.select(
        "tenant_global_id",
        F.when(F.col("is_highwatermark"), F.col("record_date")).otherwise(F.lit(end)).alias("record_date"),
        "is_highwatermark",
    )


def rejoin(history: DataFrame, picks: DataFrame, as_of) -> DataFrame:
    """Whole snapshot row of the picked day (H10); date_recorded = run date, hwm_date = picked day.

    Picked days always lie in the billing window, so only that window of the
    history is read (literal bounds: partition pruning), not its whole past.
    """
    start, end = billing_window(as_of)
    p = picks.select("tenant_global_id", "record_date")
    window = history.filter(F.col("record_date").between(F.lit(start), F.lit(end)))
    return window.join(p, ["tenant_global_id", "record_date"]).select(
        F.lit(as_date(as_of)).alias("date_recorded"),
        *[c for c in history.columns if c != "record_date"],
        F.col("record_date").alias("hwm_date"),
    )


def addon_peak(history: DataFrame, meta: DataFrame, as_of, metric: str = "dmarc_domains_number",
               flag: str = "dmarc_management") -> DataFrame:
    """Peak of an add-on count among enabled tenants."""
    live = billable_rows(history, as_of, require_plan=False).filter(F.col(flag))
    roots = snapshot(meta, as_of).select(F.col("tenant_global_id").alias("root"))
    live = live.join(roots, "root", "left_semi")
    return select.peak(live, ["tenant_global_id"], metric, "record_date").select(
        "tenant_global_id", "record_date", metric)


def recent_plan_picks(history: DataFrame, meta: DataFrame, as_of) -> DataFrame:
    """Legacy rule (H12): the tenant's most recent plan from its first day onward, then peak.

    No re-parenting step and no No_Plan filter.
    """
    live = billable_rows(history, as_of, require_plan=False)
    m = snapshot(meta, as_of, tracked_only=False).select(
        F.col("tenant_global_id").alias("root"), "profile_type", "is_highwatermark")
    rows = live.join(m, "root").withColumn("profile_count", seats())
    w = Window.partitionBy("tenant_global_id")
    recent = F.max_by("plan_name", "record_date").over(w)
    rows = rows.withColumn("_recent", recent)
    since = F.min(F.when(F.col("plan_name") == F.col("_recent"), F.col("record_date"))).over(w)
    rows = rows.withColumn("_since", since).filter(
        (F.col("plan_name") == F.col("_recent")) & (F.col("record_date") >= F.col("_since")))
    peak_rows = select.peak(rows.filter(F.col("is_highwatermark")), ["tenant_global_id"], "profile_count",
                            "record_date")
    cur_rows = select.latest(rows.filter(~F.col("is_highwatermark")), ["tenant_global_id"], "record_date")
    return peak_rows.select("tenant_global_id", "record_date", "is_highwatermark", "plan_name") \
        .unionByName(cur_rows.select("tenant_global_id", F.lit(as_date(as_of)).alias("record_date"),
                                     "is_highwatermark", "plan_name"))


def month_peak_max_by(history: DataFrame, meta: DataFrame, month) -> DataFrame:
    """Peak per tenant of the month that ``month`` lies in (H13), ties to the earliest day.

    A month's snapshots are those of its 2nd day to the 1st of the next month (a snapshot shows the day
    before); only status Active counts. Also returns the tenant's newest row for non-peak roots.
    """
    first = as_date(month).replace(day=1)
    after = (first + dt.timedelta(days=32)).replace(day=1)
    rows = history.filter(F.col("record_date").between(F.lit(first + dt.timedelta(days=1)), F.lit(after))
                          & F.col("approved") & (F.col("billing_status") == "Active"))
    m = meta.select(F.col("tenant_global_id").alias("root"), "profile_type", "is_highwatermark")
    rows = rows.join(m, "root").withColumn("profile_count", seats())
    g = rows.groupBy("tenant_global_id", "is_highwatermark").agg(
        F.max_by(F.struct("record_date", "plan_name", "profile_count"),
                 F.struct(F.col("profile_count"), -F.datediff(F.col("record_date"), F.lit("1970-01-01")))
                 ).alias("peak"),
        F.max_by(F.struct("record_date", "plan_name", "profile_count"), F.col("record_date")).alias("last"),
    )
    chosen = F.when(F.col("is_highwatermark"), F.col("peak")).otherwise(F.col("last"))
    return g.select("tenant_global_id", "is_highwatermark", chosen.getField("record_date").alias("record_date"),
                    chosen.getField("plan_name").alias("plan_name"),
                    chosen.getField("profile_count").alias("profile_count"))


def point_in_time(history: DataFrame, meta: DataFrame, as_of) -> DataFrame:
    """No-peak billing (H14): the run date's rows whose root is priced."""
    d = as_date(as_of)
    roots = snapshot(meta, as_of).select(F.col("tenant_global_id").alias("root"))
    today = history.filter((F.col("record_date") == F.lit(d)) & F.col("approved")
                           & F.col("billing_status").isin(*BILLABLE_STATUS))
    return today.join(roots, "root", "left_semi").select(
        F.lit(d).alias("date_recorded"), *[c for c in history.columns if c != "record_date"],
        F.col("record_date").alias("hwm_date"))
