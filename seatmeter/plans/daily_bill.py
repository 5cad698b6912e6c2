"""The daily bill as one composed plan: history -> peak -> pricing -> allowance -> itemized.

Each function takes the run date ``as_of``; nothing reads the wall clock, so
any day can be re-run (backfill = a different ``as_of``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import allowance, hwm, marts, pricing
from ..operators.sinks import materialize
from ..sources import adapters
from ..sources.tables import Tables


class Domain:
    """Billing-domain tables derived from one driver data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of=adapters.AS_OF):
        self.t = Tables(spark, sf_dir)
        self.as_of = as_of
        self.memo: dict = {}
        self.others: dict = {}

    def at(self, day) -> "Domain":
        """The same domain for another run date: dated snapshots of its own, the history shared."""
        if day == self.as_of:
            return self
        if day not in self.others:
            other = Domain(self.t.spark, self.t.sf_dir, day)
            other.tree, other.history, other.fx = self.tree, self.history, self.fx
            self.others[day] = other
        return self.others[day]

    @cached_property
    def tree(self) -> DataFrame:
        return adapters.tenant_tree(self.t)

    @cached_property
    def history(self) -> DataFrame:
        # the stored daily snapshot table of the domain: written once per run
        return materialize(adapters.tenant_history(self.t, self.tree), "history", partition_by="record_date")

    @cached_property
    def meta_all(self) -> DataFrame:
        return adapters.account_meta(self.t, self.as_of)

    @cached_property
    def meta(self) -> DataFrame:
        return hwm.snapshot(self.meta_all, self.as_of)

    @cached_property
    def pools(self) -> DataFrame:
        return adapters.pools(self.meta_all, self.as_of)

    @cached_property
    def price_list(self) -> DataFrame:
        return adapters.price_list(self.meta_all, self.as_of)

    @cached_property
    def exceptions(self) -> DataFrame:
        return adapters.exceptions(self.tree)

    @cached_property
    def commitments(self) -> DataFrame:
        return adapters.min_commitments(self.meta_all, self.as_of)

    @cached_property
    def fx(self) -> DataFrame:
        return adapters.fx_rates(self.t)


def peak_rows(d: Domain, as_of=None) -> DataFrame:
    as_of = as_of or d.as_of
    key = ("peak", str(as_of))
    if key not in d.memo:
        d.memo[key] = materialize(hwm.rejoin(d.history, hwm.month_picks(d.history, d.meta_all, as_of), as_of))
    return d.memo[key]


def addon_rows(d: Domain, as_of=None) -> DataFrame:
    as_of = as_of or d.as_of
    key = ("addon", str(as_of))
    if key not in d.memo:
        picks = hwm.addon_peak(d.history, d.meta_all, as_of)
        d.memo[key] = materialize(hwm.rejoin(d.history, picks, as_of))
    return d.memo[key]


def root_lines(d: Domain, as_of=None, peak: bool = True) -> DataFrame:
    as_of = as_of or d.as_of
    key = ("lines", str(as_of), peak)
    if key not in d.memo:
        rows = peak_rows(d, as_of) if peak else materialize(hwm.point_in_time(d.history, d.meta_all, as_of))
        meta = hwm.snapshot(d.meta_all, as_of)
        d.memo[key] = materialize(pricing.daily_lines(
            rows, addon_rows(d, as_of), meta, d.price_list, d.pools, d.exceptions, d.commitments, as_of,
            materialize=materialize))
    return d.memo[key]


def partner_seats(d: Domain, as_of=None, lines: DataFrame | None = None) -> DataFrame:
    as_of = as_of or d.as_of
    lines = lines if lines is not None else root_lines(d, as_of)
    meta = hwm.snapshot(d.meta_all, as_of)
    return allowance.allowance(peak_rows(d, as_of), meta, lines, d.fx, as_of)


def itemized(d: Domain, as_of=None, peak: bool = True) -> DataFrame:
    as_of = as_of or d.as_of
    lines = root_lines(d, as_of, peak)
    # the partner-seat lines always come from the peak calculation
    nfr = partner_seats(d, as_of, lines if peak else root_lines(d, as_of, True))
    return marts.itemize(lines, nfr, as_of)


def subtenant_lines(d: Domain, as_of=None, peak: bool = True, only: tuple[str, ...] = ()) -> DataFrame:
    """Sub-tenant lines priced from the root bill (P19-P23); ``only`` names the branches wanted.

    peak=False prices the run date's rows against the no-peak root bill, without the minimum commitment; the
    per-unit add-on keeps its peak.
    """
    from ..operators import subtenant, tree as tree_ops
    as_of = as_of or d.as_of
    key = ("itemized", str(as_of), peak)
    if key not in d.memo:
        d.memo[key] = materialize(itemized(d, as_of, peak))
    bill = d.memo[key]
    rows = peak_rows(d, as_of) if peak else hwm.point_in_time(d.history, d.meta_all, as_of)
    meta = hwm.snapshot(d.meta_all, as_of)
    prices = d.price_list.filter(d.price_list.snapshot_date == as_of).select(
        "tenant_global_id", "sku", "is_nfr", "tier_min", "tier_max", "price", "start_date", "end_date",
        "price_type").distinct()
    picks = hwm.addon_peak(d.history, d.meta_all, as_of)
    return subtenant.subtenant_lines(tree_ops.with_layers(rows), tree_ops.with_layers(addon_rows(d, as_of)), picks, meta,
                                     prices, bill, only or (subtenant.BRANCHES if peak else subtenant.BRANCHES[:-1]))


LAYERS = ["first_layer_id", "second_layer_id", "third_layer_id", "fourth_layer_id", "fifth_layer_id"]


def subtenant_itemized(d: Domain, as_of=None) -> DataFrame:
    """Sub-tenant itemized bill (M1 by billed tenant, at any depth) with the partner-seat lines on the partner."""
    as_of = as_of or d.as_of
    key = ("sub_itemized", str(as_of))
    if key not in d.memo:
        lines = subtenant_lines(d, as_of)
        d.memo[key] = materialize(marts.itemize(lines, partner_seats(d, as_of), as_of, keys=["tenant_global_id", *LAYERS],
                                                qty_col="billable_quantity",
                                                partner=("tenant_global_id", "first_layer_id")), "sub-itemized")
    return d.memo[key]


def mailbox_mart(d: Domain, as_of=None) -> DataFrame:
    as_of = as_of or d.as_of
    return marts.mailbox_mart(peak_rows(d, as_of), d.history, hwm.snapshot(d.meta_all, as_of),
                              subtenant_itemized(d, as_of), as_of)


def bill_bridge(d: Domain, as_of=None) -> DataFrame:
    """Recurring-revenue bridge between two days' sub-tenant bills (S1-S11), as the reference runs it.

    Both anchor days (the 1st of the month, or of the previous month on day 1,
    and the run date) are billed with the same operators; their S1 facts are
    unioned and bridged.
    """
    from ..functions.dates import bridge_anchors
    from ..operators import bridge
    from pyspark.sql import functions as F
    as_of = as_of or d.as_of
    prior, current = bridge_anchors(as_of)
    facts = [bridge.bill_fact(subtenant_itemized(d, day), d.meta_all, d.price_list, day) for day in (prior, current)]
    f = facts[0].unionByName(facts[1]).withColumn("tenant_mrr", F.col("tenant_mrr").cast("decimal(18,4)"))
    f = materialize(f, "bill-bridge-fact")
    rates = d.price_list.select("snapshot_date", "tenant_global_id", "sku", "price")
    currency = bridge.as_of_snapshot(d.meta_all, "snapshot_date", current).select(
        F.col("tenant_global_id").alias("first_layer_id"), "currency")
    return bridge.mrr_bridge(f, rates, currency, d.fx, as_of)
