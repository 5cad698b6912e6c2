"""Pricing: price resolution, seat aggregation, tier waterfalls, pooling.

Scale notes. Seat rows arrive one per tenant; they are aggregated once at the
finest billing grain (root x plan x partner flag x add-on flags) with partial
(map-side) aggregation, so even a root holding a third of all tenants is
reduced inside each map task before the shuffle. Everything after that runs
on root/pool grain, a few rows per partner. The price list, meta, pool and
rule tables are dimensions joined by hash/broadcast as the planner sees fit.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date
from ..functions.joins import multiplied
from ..functions.money import share_of
from ..functions.tiers import graduated_piece, tier_reached

# ---------------------------------------------------------------------------
# Plan -> (price-list sku, billing sku, billing sku when partner-priced)
# ---------------------------------------------------------------------------
PLAN_SKUS = {
    "Email Protect": ("Email Protect", "IS-LTP-EP", "IS-LTP-EPNFR"),
    "Complete Protect": ("Complete Protect", "IS-LTP-CP", "IS-LTP-CPNFR"),
    "Core": ("CORE", "IS-LTP-CORE", "IS-LTP-CORENFR"),
    "Platform Protect": ("Platform Protect", "IS-LTP-IP", "IS-LTP-IPNFR"),
    "SAT Suite": ("SAT_SUITE", "IS-SAT_SUITE", "IS-SAT_SUITENFR"),
    "Starter": ("STARTER", "IS-LTP-STARTER", "IS-LTP-STARTERNFR"),
    "Phishing Simulation and Training": ("PST", "IS-LTP-PST", None),
}
PREMIUM_NAMES = ["NINJIO", "Cybermaniacs Videos", "Habitu8"]
DMARC_PRICE_SKU = {1: "DMARC", 2: "DMARC_PRO", 3: "DMARC"}
DMARC_ITEM = {1: "DMARC Core Management", 2: "DMARC Pro", 3: "DMARC Premium"}
DMARC_SKU = {1: "IS-LTP-DMARC", 2: "IS-LTP-DMARC_PRO", 3: "IS-LTP-DMARC_PREMIUM"}
PROMO, EXCEPTIONAL, MINIMUM = "Promo Price", "Exceptional Price", "Minimum Commitment"
LINE_COLUMNS = ["date_recorded", "ltp", "item", "sku", "partner_pricing", "quantity", "amount", "price_type"]
# ---------------------------------------------------------------------------


def lookup(col: Column, mapping: dict, default=None) -> Column:
    """CASE col WHEN k THEN v ... END as a JVM-side expression."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default))


def price_sku(plan: Column) -> Column:
    return lookup(plan, {p: v[0] for p, v in PLAN_SKUS.items()})


def billing_sku(plan: Column, partner: Column) -> Column:
    """SKU code by plan and partner flag (P18); unmapped -> NULL."""
    std = lookup(plan, {p: v[1] for p, v in PLAN_SKUS.items()})
    nfr = lookup(plan, {p: v[2] for p, v in PLAN_SKUS.items() if v[2]})
    return F.when(partner == F.lit(False), std).when(partner == F.lit(True), nfr)


def effective_partner(partner: str = "partner_pricing", override: str = "not_nfr_partner") -> Column:
    """Partner flag with the NOT_NFR_PARTNER override forcing FALSE."""
    return F.when(F.col(override) == F.lit(True), F.lit(False)).otherwise(F.col(partner))


def seat_quantity(profile_type: Column, sum_active: Column, sum_license: Column, sum_shared: Column) -> Column:
    """Seat aggregate by profile type (P8); shared = coalesce(sum(a) - sum(s), sum(a))."""
    return (F.when(profile_type == "active", sum_active)
            .when(profile_type == "license", sum_license)
            .when(profile_type == "shared", F.coalesce(sum_active - sum_shared, sum_active)))


def normalise_price_type(col: Column) -> Column:
    return F.when(col == PROMO, "Promo").when(col == EXCEPTIONAL, "Exceptional").otherwise("Standard")


# ---------------------------------------------------------------------------
# Price list
# ---------------------------------------------------------------------------

def resolve_prices(price_list: DataFrame, as_of, snapshot: bool = True) -> DataFrame:
    """Dedupe the price list (P1) and apply the promo override.

    If any promo row of (tenant, sku, is_nfr) is live on the run date only the
    live promo rows are kept, otherwise only the non-promo rows.
    """
    d = F.lit(as_date(as_of))
    pl = price_list.filter(F.col("snapshot_date") == d) if snapshot else price_list
    p = pl.select("tenant_global_id", "sku", "is_nfr", "tier_min", "tier_max", "price",
                  "start_date", "end_date", "price_type").distinct()
    live_promo = (F.col("price_type") == PROMO) & d.between(F.col("start_date"), F.col("end_date"))
    has = F.max(F.when(live_promo, 1).otherwise(0)).over(Window.partitionBy("tenant_global_id", "sku", "is_nfr"))
    keep = ((F.col("_has") == 1) & live_promo) | ((F.col("_has") == 0) & (F.col("price_type") != PROMO))
    return p.withColumn("_has", has).filter(keep).select(
        "tenant_global_id", "sku", "is_nfr", "tier_min", "tier_max", "price", "price_type")


def pool_map(meta: DataFrame, pools: DataFrame) -> DataFrame:
    """Every meta root -> its master root, itself when not pooled."""
    u = pools.select("global_tenant_id", "master_tenant_id")
    return meta.select(F.col("tenant_global_id").alias("global_tenant_id")).join(u, "global_tenant_id", "left") \
        .select("global_tenant_id", F.coalesce("master_tenant_id", "global_tenant_id").alias("master_tenant_id"))


def active_rules(rules: DataFrame, as_of, level: str = "Tenant") -> DataFrame:
    """Exception rules live on the run date at one level."""
    d = F.lit(as_date(as_of))
    return rules.filter((F.col("tenant_msp") == level) & d.between(F.col("start_date"), F.col("end_date"))).select(
        F.col("tenant_id").alias("sub_tenant_id"), F.col("parent_id").alias("ltp_id"),
        F.col("item").alias("rule_plan"), F.col("partner_pricing").alias("rule_nfr"),
        "tier_min", "tier_max", "tier_rate")


# ---------------------------------------------------------------------------
# Generic tier operators
# ---------------------------------------------------------------------------

def graduated(qty: DataFrame, tiers: DataFrame, on, keys: Sequence[str], qty_col: str = "quantity",
              price_col: str = "price", out: str = "amount") -> DataFrame:
    """Graduated (waterfall) amount per key (P9): Σ tiers max(0, min(q, tmax) - (tmin - 1)) * price."""
    j = qty.join(tiers, on)
    return j.groupBy(*keys).agg(
        F.sum(graduated_piece(qty_col, "tier_min", "tier_max", price_col)).alias(out))


def volume(qty: DataFrame, tiers: DataFrame, on, keys: Sequence[str], qty_col: str = "quantity",
           price_col: str = "price", out: str = "amount") -> DataFrame:
    """All-units (volume) pricing (P25): the whole quantity at the reached tier's price."""
    j = qty.join(tiers, on).filter(tier_reached(qty_col, "tier_min", "tier_max"))
    whole = F.col(qty_col).cast("decimal(20,0)") * F.col(price_col).cast("decimal(18,4)")
    return j.groupBy(*keys).agg(F.max_by(whole, F.col("tier_min")).alias(out))


WIDE_NAME = re.compile(r"(?P<stem>.+?)(?P<nfr>NFR)?_(?P<first>[0-9]+)")


def unpivot_wide(wide: DataFrame, ids: Sequence[str], stems: dict[str, str]) -> DataFrame:
    """Wide price table -> long tier rows (P24): ids, plan_name, is_nfr, tier_min, tier_max, price.

    The schema says it all: a column ``<stem>[NFR]_<breakpoint>`` prices the units above its breakpoint (from the first
    unit for 1) up to the stem's next breakpoint; the last tier is open. ``stems`` maps stems to plans; a
    price column of another stem is an error, so that a new plan cannot be lost. NULL prices give no row.
    """
    found: dict[tuple[str, bool], list[tuple[int, str]]] = {}
    for c in wide.columns:
        m = WIDE_NAME.fullmatch(c)
        if c in ids or not m:
            continue
        if m["stem"] not in stems:
            raise ValueError(f"price column {c}: unknown plan")
        found.setdefault((m["stem"], m["nfr"] is not None), []).append((int(m["first"]), c))
    rows = []
    for (stem, nfr), breaks in found.items():
        breaks.sort()
        for (at, c), after in zip(breaks, [b for b, _ in breaks[1:]] + [None]):
            rows.append(F.struct(F.lit(stems[stem]).alias("plan_name"), F.lit(nfr).alias("is_nfr"),
                                 F.lit(1 if at <= 1 else at + 1).alias("tier_min"), F.lit(after).cast("int").alias("tier_max"),
                                 F.col(c).cast("decimal(18,4)").alias("price")))
    return wide.select(*ids, F.explode(F.array(*rows)).alias("_tier")).select(*ids, "_tier.*").filter(F.col("price").isNotNull())


def allocate(parts: DataFrame, pool_keys: Sequence[str], part_qty: str, pool_amount: DataFrame,
             amount_col: str = "pool_amount", out: str = "amount") -> DataFrame:
    """Spread a pool amount back to its members by quantity share (P10)."""
    totals = parts.groupBy(*pool_keys).agg(F.sum(part_qty).alias("_pool_qty"))
    return parts.join(totals, list(pool_keys)).join(pool_amount, list(pool_keys)).withColumn(
        out, share_of(F.col(part_qty), F.col("_pool_qty"), F.col(amount_col))).drop("_pool_qty")


def pooled_threshold(df: DataFrame, keys: Sequence[str], pool_key: str, member_key: str, qty_col: str,
                     tiers: DataFrame, tier_on: Sequence[str], out: str = "amount") -> DataFrame:
    """Tier picked by the pool's combined quantity, priced per member.

    sum(sum(q)) over (partition by pool): member totals first (partial
    aggregation), then the pool total as a second aggregate joined back, so no
    window is keyed on the pool (one pool can hold a third of all rows).
    """
    keys = list(keys)
    members = df.groupBy(*keys, pool_key, member_key).agg(F.sum(qty_col).alias("member_qty"))
    pools = members.groupBy(*keys, pool_key).agg(F.sum("member_qty").alias("pool_qty"))
    m = members.join(pools, [*keys, pool_key])
    priced = m.join(tiers, list(tier_on)).filter(tier_reached("pool_qty", "tier_min", "tier_max"))
    return priced.select(*keys, pool_key, member_key, "member_qty", "pool_qty", "tier_min",
                         (F.col("member_qty").cast("decimal(20,0)") * F.col("price").cast("decimal(18,4)"))
                         .cast("double").alias(out))


def min_quantity(qty: Column, floor_qty, price: Column) -> Column:
    """Minimum billed quantity (P27): greatest(q, floor) * price."""
    floor_col = F.lit(floor_qty) if not isinstance(floor_qty, Column) else floor_qty
    return F.greatest(qty, floor_col).cast("decimal(20,0)") * price.cast("decimal(18,4)")


# ---------------------------------------------------------------------------
# The daily root bill
# ---------------------------------------------------------------------------

def _norm(df: DataFrame, price_type: Column | None = None) -> DataFrame:
    pt = normalise_price_type(F.col("price_type")) if price_type is None else price_type
    return df.select(
        F.col("date_recorded"), F.col("ltp").cast("string"), F.col("item").cast("string"),
        F.col("sku").cast("string"), F.col("partner_pricing").cast("boolean"),
        F.col("quantity").cast("bigint"), F.col("amount").cast("double"), pt.cast("string").alias("price_type"))


def seat_grain(hwm: DataFrame, meta: DataFrame, unified: DataFrame, rules: DataFrame) -> DataFrame:
    """Finest billing grain with additive seat sums (one shuffle of the tenant rows).

    Rows whose (tenant, root, plan, partner flag) has a live exception are
    excluded (P6); they are priced by ``exception_lines``.
    """
    h = hwm.filter(F.col("approved") & F.col("billing_status").isin("Active", "Active-POC")) \
        .withColumn("eff_partner", effective_partner())
    m = meta.filter(F.col("profile_type").isNotNull()).select(F.col("tenant_global_id").alias("root"), "profile_type")
    u = unified.select(F.col("global_tenant_id").alias("root"), F.col("master_tenant_id").alias("master"))
    ex = rules.select(F.col("sub_tenant_id").alias("tenant_global_id"), F.col("ltp_id").alias("root"),
                      F.col("rule_plan").alias("plan_name"), F.col("rule_nfr").alias("eff_partner")).distinct()
    h = h.join(m, "root").join(u, "root").join(
        ex, ["tenant_global_id", "root", "plan_name", "eff_partner"], "left_anti")
    keys = ["date_recorded", "master", "root", "plan_name", "eff_partner", "profile_type",
            "incident_management", "simulation_and_training_bundle_plus", "ato", "premium_name"]
    return h.groupBy(*keys).agg(
        F.sum("active_profiles").alias("sum_a"), F.sum("licensed_profiles").alias("sum_l"),
        F.sum("shared_profiles").alias("sum_s"))


def _regroup(fine: DataFrame, keys: Sequence[str]) -> DataFrame:
    g = fine.groupBy(*keys).agg(F.sum("sum_a").alias("sa"), F.sum("sum_l").alias("sl"), F.sum("sum_s").alias("ss"))
    return g.withColumn("quantity", seat_quantity(F.col("profile_type"), F.col("sa"), F.col("sl"), F.col("ss"))) \
        .drop("sa", "sl", "ss")


def plan_lines(fine: DataFrame, prices: DataFrame) -> DataFrame:
    """Plan seats: waterfall on the pool's combined quantity, spread back per root."""
    base = _regroup(fine, ["date_recorded", "master", "root", "plan_name", "eff_partner", "profile_type"])
    pkeys = ["date_recorded", "master", "plan_name", "eff_partner", "profile_type"]
    combined = base.groupBy(*pkeys).agg(F.sum("quantity").alias("combined_quantity")) \
        .filter(F.col("plan_name").isin(*PLAN_SKUS.keys()))
    p = prices.filter(F.col("sku").isin(*[v[0] for v in PLAN_SKUS.values()])).select(
        F.col("tenant_global_id").alias("master"), F.col("is_nfr").alias("eff_partner"),
        F.col("sku").alias("_psku"), "tier_min", "tier_max", "price", "price_type")
    tier = combined.join(p, ["master", "eff_partner"]).filter(price_sku(F.col("plan_name")) == F.col("_psku")) \
        .groupBy(*pkeys, "combined_quantity").agg(
            F.sum(graduated_piece("combined_quantity", "tier_min", "tier_max", "price")).alias("total"),
            F.max("price_type").alias("price_type"))
    out = base.join(tier, pkeys)
    return _norm(out.select(
        "date_recorded", F.col("root").alias("ltp"), F.col("plan_name").alias("item"),
        billing_sku(F.col("plan_name"), F.col("eff_partner")).alias("sku"),
        F.col("eff_partner").alias("partner_pricing"), "quantity",
        share_of(F.col("quantity"), F.col("combined_quantity"), F.col("total")).alias("amount"), "price_type"))


def exception_lines(hwm: DataFrame, meta: DataFrame, rules: DataFrame) -> DataFrame:
    """Exceptional seats with their own waterfall per sub-tenant (P5).

    Kept as the reference groups it: per tier too, so a rule with n tiers emits
    n rows, each carrying the full quantity and that tier's amount.
    """
    h = hwm.filter(F.col("approved") & F.col("billing_status").isin("Active", "Active-POC")) \
        .withColumn("eff_partner", effective_partner())
    m = meta.filter(F.col("profile_type").isNotNull()).select(F.col("tenant_global_id").alias("root"), "profile_type")
    r = rules.select(F.col("sub_tenant_id").alias("tenant_global_id"), F.col("ltp_id").alias("root"),
                     F.col("rule_plan").alias("plan_name"), F.col("rule_nfr").alias("eff_partner"),
                     "tier_min", "tier_max", "tier_rate")
    j = h.join(m, "root").join(r, ["tenant_global_id", "root", "plan_name", "eff_partner"])
    keys = ["date_recorded", "root", "tenant_global_id", "plan_name", "eff_partner", "profile_type",
            "tier_min", "tier_max", "tier_rate"]
    g = j.groupBy(*keys).agg(F.sum("active_profiles").alias("sa"), F.sum("licensed_profiles").alias("sl"),
                             F.sum("shared_profiles").alias("ss"))
    g = g.withColumn("quantity", seat_quantity(F.col("profile_type"), F.col("sa"), F.col("sl"), F.col("ss")))
    out = g.select(
        "date_recorded", F.col("root").alias("ltp"), F.col("plan_name").alias("item"),
        billing_sku(F.col("plan_name"), F.col("eff_partner")).alias("sku"),
        F.col("eff_partner").alias("partner_pricing"), "quantity",
        graduated_piece("quantity", "tier_min", "tier_max", "tier_rate").alias("amount"))
    return _norm(out, F.lit("Exceptional"))


def _flat_price(prices: DataFrame, sku: str) -> DataFrame:
    return prices.filter((F.col("sku") == sku) & (F.col("tier_min") == 1)).select(
        F.col("tenant_global_id").alias("master"), "price", "price_type")


def premium_lines(fine: DataFrame, prices: DataFrame) -> DataFrame:
    """Flat-rate premium content at pool level, spread back.

    The price join has no partner predicate (as in the reference), so several
    price rows for the sku multiply the pool quantity and amount alike.
    """
    b = _flag_quantity(fine, F.col("premium_name").isin(*PREMIUM_NAMES))
    pkeys = ["date_recorded", "master", "premium_name", "profile_type"]
    pm = b.join(_flat_price(prices, "PSCP"), "master").groupBy(*pkeys).agg(
        F.sum("quantity").alias("combined_quantity"),
        (F.sum("quantity").cast("double") * F.max("price").cast("double")).alias("total"),
        F.max("price_type").alias("price_type"))
    t = b.groupBy("date_recorded", "master", "root", "premium_name", "profile_type").agg(
        F.sum("quantity").alias("quantity"))
    out = t.join(pm, pkeys)
    return _norm(out.select(
        "date_recorded", F.col("root").alias("ltp"), F.col("premium_name").alias("item"),
        F.lit("IS-LTP-PSCP").alias("sku"), F.lit(None).cast("boolean").alias("partner_pricing"), "quantity",
        share_of(F.col("quantity"), F.col("combined_quantity"), F.col("total")).alias("amount"), "price_type"))


def _flag_quantity(fine: DataFrame, cond: Column) -> DataFrame:
    """Seat quantity of the fine-grain rows matching ``cond`` (already one row per fine key)."""
    return fine.filter(cond).withColumn(
        "quantity", seat_quantity(F.col("profile_type"), F.col("sum_a"), F.col("sum_l"), F.col("sum_s")))


def tiered_addon_lines(fine: DataFrame, prices: DataFrame, flag: str = "incident_management",
                       sku: str = "Incident Management", item: str = "Incident Management",
                       code: str = "IS-LTP-IM") -> DataFrame:
    """Tiered add-on on flagged seats, waterfall on the pool quantity."""
    b = _flag_quantity(fine, F.col(flag) == F.lit(True))
    per_root = b.groupBy("date_recorded", "master", "root", "profile_type").agg(F.sum("quantity").alias("quantity"))
    ckeys = ["date_recorded", "master", "profile_type"]
    comb = per_root.groupBy(*ckeys).agg(F.sum("quantity").alias("combined_quantity"))
    p = prices.filter(F.col("sku") == sku).select(F.col("tenant_global_id").alias("master"), "tier_min",
                                                   "tier_max", "price", "price_type")
    tier = comb.join(p, "master").groupBy(*ckeys, "combined_quantity").agg(
        F.sum(graduated_piece("combined_quantity", "tier_min", "tier_max", "price")).alias("total"),
        F.max("price_type").alias("price_type"))
    out = per_root.join(tier, ckeys)
    return _norm(out.select(
        "date_recorded", F.col("root").alias("ltp"), F.lit(item).alias("item"), F.lit(code).alias("sku"),
        F.lit(None).cast("boolean").alias("partner_pricing"), "quantity",
        share_of(F.col("quantity"), F.col("combined_quantity"), F.col("total")).alias("amount"), "price_type"))


def flat_addon_lines(fine: DataFrame, prices: DataFrame, flag: str, sku: str, item: str, code: str,
                     excluded_plans: Sequence[str]) -> DataFrame:
    """Flat add-on on flagged, non-partner seats, excluding bundled plans."""
    cond = (F.col(flag) == F.lit(True)) & ~F.col("plan_name").isin(*excluded_plans) \
        & (F.col("eff_partner") == F.lit(False))
    b = _flag_quantity(fine, cond)
    per_root = b.join(_flat_price(prices, sku), "master").groupBy(
        "date_recorded", "master", "root", "profile_type").agg(
        F.sum("quantity").alias("quantity"), F.max("price").alias("price"), F.max("price_type").alias("price_type"))
    ckeys = ["date_recorded", "master", "profile_type"]
    comb = per_root.groupBy(*ckeys).agg(F.sum("quantity").alias("combined_quantity"),
                                        F.max("price").alias("pool_price"),
                                        F.max("price_type").alias("pool_price_type"))
    out = per_root.join(comb, ckeys)
    total = F.col("combined_quantity").cast("double") * F.col("pool_price").cast("double")
    return _norm(out.select(
        "date_recorded", F.col("root").alias("ltp"), F.lit(item).alias("item"), F.lit(code).alias("sku"),
        F.lit(None).cast("boolean").alias("partner_pricing"), "quantity",
        share_of(F.col("quantity"), F.col("combined_quantity"), total).alias("amount"),
        F.col("pool_price_type").alias("price_type")))


def per_unit_lines(dmarc_hwm: DataFrame, unified: DataFrame, prices: DataFrame) -> DataFrame:
    """Per-unit add-on by plan code (domains), positive totals only, pooled and spread."""
    u = unified.select(F.col("global_tenant_id").alias("root"), F.col("master_tenant_id").alias("master"))
    base = dmarc_hwm.join(u, "root").groupBy(
        "date_recorded", "master", "root", "dmarc_plan").agg(
        F.sum("dmarc_domains_number").alias("quantity")).filter(F.col("quantity") > 0)
    ckeys = ["date_recorded", "master", "dmarc_plan"]
    comb = base.groupBy(*ckeys).agg(F.sum("quantity").alias("combined_quantity"))
    p = prices.filter((F.col("tier_min") == 1) & F.col("sku").isin(*sorted(set(DMARC_PRICE_SKU.values())))).select(
        F.col("tenant_global_id").alias("master"), F.col("sku").alias("_psku"), "price", "price_type")
    tier = comb.join(p, "master").filter(lookup(F.col("dmarc_plan"), DMARC_PRICE_SKU) == F.col("_psku")) \
        .groupBy(*ckeys, "combined_quantity", "price").agg(F.max("price_type").alias("price_type")) \
        .withColumn("total", F.col("combined_quantity").cast("double") * F.col("price").cast("double"))
    out = base.join(tier, ckeys)
    plan = F.col("dmarc_plan")
    return _norm(out.select(
        "date_recorded", F.col("root").alias("ltp"), lookup(plan, DMARC_ITEM).alias("item"),
        lookup(plan, DMARC_SKU).alias("sku"), F.lit(None).cast("boolean").alias("partner_pricing"), "quantity",
        share_of(F.col("quantity"), F.col("combined_quantity"), F.col("total")).alias("amount"), "price_type"))


def min_commit_lines(lines: DataFrame, commits: DataFrame, unified: DataFrame, as_of) -> DataFrame:
    """Monthly-minimum top-up when a pool's total is short of the commitment.

    Pools with no billing at all still get the full commitment (left join).
    """
    d = as_date(as_of)
    u = unified.select(F.col("global_tenant_id").alias("ltp"), F.col("master_tenant_id").alias("master"))
    mc = commits.filter(F.lit(d).between(F.col("start_date"), F.col("end_date"))
                        & (F.col("monthly_commitment_amount") > 0)).select(
        F.col("tenant_global_id").alias("ltp"), "monthly_commitment_amount")
    mc = mc.join(u, "ltp", "left").withColumn("master", F.coalesce("master", "ltp"))
    totals = lines.join(u, "ltp").groupBy("date_recorded", "master").agg(
        F.sum(F.col("amount").cast("decimal(38,10)")).alias("total"))
    j = mc.join(totals, "master", "left")
    short = F.coalesce(F.col("total"), F.lit(0)) < F.col("monthly_commitment_amount")
    return _norm(j.filter(short).select(
        F.coalesce(F.col("date_recorded"), F.lit(d)).alias("date_recorded"), "ltp",
        F.lit("Monthly Minimum").alias("item"), F.lit("IS-LTP-MIN").alias("sku"),
        F.lit(None).cast("boolean").alias("partner_pricing"), F.lit(1).alias("quantity"),
        (F.col("monthly_commitment_amount").cast("decimal(38,10)") - F.coalesce(F.col("total"), F.lit(0)))
        .alias("amount")), F.lit("Minimum Commitment"))


def daily_lines(hwm: DataFrame, dmarc_hwm: DataFrame, meta: DataFrame, price_list: DataFrame,
                pools: DataFrame, rules: DataFrame, commits: DataFrame, as_of,
                materialize=lambda df: df) -> DataFrame:
    """The root-level daily bill: 8 branches unioned.

    ``materialize`` is applied to the shared seat grain, the resolved prices and
    the union of the charges (the plan layer passes a write to the shared
    checkpoint folder), so each is computed once although several branches and
    the minimum-commitment top-up read it.
    """
    prices = materialize(resolve_prices(price_list, as_of))
    unified = pool_map(meta, pools)
    live_rules = active_rules(rules, as_of)
    fine = materialize(seat_grain(hwm, meta, unified, live_rules))
    branches = [
        plan_lines(fine, prices),
        exception_lines(hwm, meta, live_rules),
        premium_lines(fine, prices),
        tiered_addon_lines(fine, prices),
        flat_addon_lines(fine, prices, "simulation_and_training_bundle_plus", "STBP", "S&T Bundle Plus",
                         "IS-LTP-STBP", ["Complete Protect", "SAT Suite"]),
        flat_addon_lines(fine, prices, "ato", "ATO", "Account Takeover", "IS-LTP-ATO", ["Complete Protect"]),
        per_unit_lines(dmarc_hwm, unified, prices),
    ]
    charges = branches[0]
    for b in branches[1:]:
        charges = charges.unionByName(b)
    # the top-up reads the pool totals of all charges: compute the branches once
    charges = materialize(charges)
    return charges.unionByName(min_commit_lines(charges, commits, unified, as_of))


# ---------------------------------------------------------------------------
# Legacy add-on menu
# ---------------------------------------------------------------------------
class Addon(NamedTuple):
    """A flat add-on: billed where the flag is set and none of ``without`` is, on the plans named."""

    item: str
    sku: str
    flag: str
    price: str                            # price-list sku
    without: tuple[str, ...] = ()
    only: tuple[str, ...] = ()            # plans; empty: any
    never: tuple[str, ...] = ()           # plans
    commercial: bool = False              # not for partner tenants


# The menu. Premium packs (item: the pack) and domains (quantity: the domains) come besides.
_TRAINING = ("Phishing Simulation and Training", "SAT Suite")
_BUNDLE, _PLUS = "simulation_and_training_bundle", "simulation_and_training_bundle_plus"
ADDON_MENU = [
    Addon("Incident Management", "IS-LTP-IM", "incident_management", "Incident Management"),
    Addon("themis co-pilot", "IS-LTP-THEMIS", "themis_co_pilot", "THEMIS", ("ai_empower_bundle", _PLUS), (), ("Complete Protect",)),
    Addon("url scans", "IS-LTP-URL", "link_scanning", "URL", (), (), ("Complete Protect", "Core", "Email Protect")),
    Addon("attachment scans", "IS-LTP-AS", "file_scanning", "AS", (), (), ("Complete Protect", "Core", "Email Protect")),
    Addon("Security Awareness Training", "IS-LTP-PSTSAT", "security_awareness_training", "PSTSAT", (_BUNDLE, _PLUS), _TRAINING),
    Addon("Security Awareness Training", "IS-LTP-SAT", "security_awareness_training", "SAT", (_BUNDLE, _PLUS), (),
          ("Complete Protect", *_TRAINING)),
    Addon("S&T Bundle", "IS-LTP-PSTSTB", _BUNDLE, "PSTSTB", (_PLUS,), _TRAINING, (), True),
    Addon("S&T Bundle", "IS-LTP-STB", _BUNDLE, "STB", (_PLUS,), (), ("Complete Protect", *_TRAINING), True),
    Addon("AI Empower Bundle", "IS-LTP-AIEB", "ai_empower_bundle", "AIEB", (_PLUS,), (), ("Complete Protect",), True),
    Addon("S&T Plus Bundle", "IS-LTP-STBP", _PLUS, "STBP", (), (), ("Complete Protect",), True),
    Addon("Account Takeover", "IS-LTP-ATO", "ato", "ATO", (), (), ("Complete Protect",), True),
    Addon("Multi Tenant", "IS-LTP-MT", "multi_tenancy", "MT", (), (), ("Complete Protect",), True),
]


def enabled(a: Addon) -> Column:
    """Is the add-on billed for a snapshot row (unknown flags count as not set, neither is one that another must be without)."""
    cond = F.col(a.flag) == F.lit(True)
    for other in a.without:
        cond = cond & (F.col(other) == F.lit(False))
    if a.only:
        cond = cond & F.col("plan_name").isin(*a.only)
    if a.never:
        cond = cond & ~F.col("plan_name").isin(*a.never)
    return cond & (F.col("partner_pricing") == F.lit(False)) if a.commercial else cond


def addon_menu(rows: DataFrame, meta: DataFrame, prices: DataFrame) -> DataFrame:
    """All flat add-ons of the legacy menu in one pass.

    Each snapshot row emits one entry per enabled add-on (``explode`` of a
    definition array), then a single aggregate prices every add-on; the
    reference scans the table once per add-on and unions the branches.
    Set-union semantics are kept with a final ``distinct``.
    """
    h = rows.filter(F.col("approved") & F.col("billing_status").isin("Active", "Active-POC"))
    m = meta.select(F.col("tenant_global_id").alias("root"), "profile_type")
    h = h.join(m, "root", "left")

    def entry(cond, item, sku, psku, a, lic, s):
        return F.when(cond, F.struct(item.alias("item"), F.lit(sku).alias("sku"), F.lit(psku).alias("psku"),
                                     a.cast("bigint").alias("a"), lic.cast("bigint").alias("l"),
                                     s.cast("bigint").alias("s")))

    seats = (F.col("active_profiles"), F.col("licensed_profiles"), F.col("shared_profiles"))
    defs = [entry(F.col("premium_name").isin(*PREMIUM_NAMES), F.col("premium_name"), "IS-LTP-PSCP", "PSCP", *seats)]
    defs += [entry(enabled(a), F.lit(a.item), a.sku, a.price, *seats) for a in ADDON_MENU]
    dom = F.col("dmarc_domains_number")
    defs.append(entry((F.col("dmarc_management") == F.lit(True)) & F.col("dmarc_plan").isNotNull()
                      & (dom > 0), F.lit("DMARC Domains"), "IS-LTP-DMARC", "DMARC", dom, dom, F.lit(None)))
    ex = h.select("date_recorded", "root", "profile_type",
                  F.explode(F.filter(F.array(*defs), lambda x: x.isNotNull())).alias("e"))
    g = ex.groupBy("date_recorded", "root", "profile_type", "e.item", "e.sku", "e.psku").agg(
        F.sum("e.a").alias("sa"), F.sum("e.l").alias("sl"), F.sum("e.s").alias("ss"))
    domains = F.col("sku") == "IS-LTP-DMARC"
    qty = F.when(domains, F.col("sa")).otherwise(seat_quantity(F.col("profile_type"), F.col("sa"), F.col("sl"),
                                                               F.col("ss")))
    skus = ["PSCP", *dict.fromkeys(a.price for a in ADDON_MENU), "DMARC"]
    p = prices.filter((F.col("tier_min") == 1) & (F.col("is_nfr") == F.lit(False)) & F.col("sku").isin(*skus)).select(
        F.col("tenant_global_id").alias("root"), F.col("sku").alias("psku"), "price")
    out = g.withColumn("quantity", qty).join(multiplied(p), ["root", "psku"], "left")
    return out.select("date_recorded", F.col("root").alias("ltp"), "item", "sku",
                      F.col("quantity").cast("bigint").alias("quantity"),
                      F.lit(None).cast("boolean").alias("partner_pricing"),
                      (F.col("quantity").cast("decimal(20,0)") * F.col("price").cast("decimal(18,4)"))
                      .cast("double").alias("amount")).distinct()
