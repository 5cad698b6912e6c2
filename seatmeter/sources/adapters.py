"""Billing-domain tables derived from the driver tables.

The driver supplies TPC-H-style tables; the billing operators need tenants,
daily snapshots, account meta, price lists and rule tables. Each adapter here
is a deterministic DataFrame transformation of driver tables, so its size grows
with them; the same recipe is written in SQL in ``seatmeter.plans.oracle`` for
the DuckDB cross-check.

Recipe (all rules are arithmetic on keys, no randomness):
* company/brand: customer c_custkey; roots are ids < 10 and every third id, every other id hangs
  under id div 10, but for short chains (ids k % 101 in 35 .. 40 hang under k - 1), which give the
  tree more than seven levels at any scale. The region prefix
  of a tree is taken from its root's nation -> region.
* tenant history: one row per (events.user_id, day) joined to the tree.
* account meta / pools / price list / exceptions / commitments: one row (or a
  few exploded rows) per root or tenant of the customer table.
* FX: one rate per currency and event day.
* usage lines: lineitem x orders x customer x part at monthly grain.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import tree as tree_ops
from ..functions.joins import spread, tiny
from .tables import Tables

# ---------------------------------------------------------------------------
# Fixed values (must be identical in the SQL recipes of seatmeter.plans.oracle)
# ---------------------------------------------------------------------------
AS_OF = dt.date(2024, 1, 30)           # run date of the event-driven billing day
REGION_CODES = ["US", "EU", "CA", "AE", "US"]        # by r_regionkey 0..4
CURRENCIES = ["USD", "EUR", "CAD", "AED", "GBP"]     # by r_regionkey 0..4
PROFILE_TYPES = ["active", "license", "shared"]      # by root id % 3
# Plan of a tenant-day from the alphabetically first event type of the day.
PLAN_BY_EVENT = {
    "click": "Complete Protect",
    "error": "Core",
    "purchase": "Email Protect",
    "signup": "Starter",
    "view": "No_Plan",
}
FIXED_PLAN = "Email Protect"                          # tenants with user_id % 4 = 0
TRAINING_PLANS = {3: "SAT Suite", 7: "Phishing Simulation and Training"}   # by user_id % 19, before all others
PREMIUM_BY_MOD5 = {0: "NINJIO", 3: "Habitu8"}
# Feature flags of a tenant that only show in the snapshot: column -> (divisor, remainder) of its id.
FLAGS = {
    "security_awareness_training": (6, 1), "simulation_and_training_bundle": (9, 2), "ai_empower_bundle": (10, 3),
    "themis_co_pilot": (8, 4), "teams_protection": (5, 2), "file_scanning": (7, 5), "link_scanning": (4, 3),
    "multi_tenancy": (11, 6),
}
PARTNER_SEATS = 90                   # seats that partner tenants have besides those of their events
FREE_NFR_ROOTS = (1, 2, 3, 4)           # remainders by 5 of partners whose list gives partner seats free
# Price list: sku -> base unit price; tiers (min, max, multiplier).
PLAN_SKUS = ["Email Protect", "Complete Protect", "CORE", "Platform Protect", "SAT_SUITE", "STARTER", "PST"]
ADDON_SKUS = ["PSCP", "Incident Management", "STBP", "ATO", "DMARC", "DMARC_PRO", "THEMIS", "URL", "AS", "PSTSAT", "SAT",
              "PSTSTB", "STB", "AIEB", "MT"]
BASE_PRICE = {
    "Email Protect": 2.5, "Complete Protect": 4.0, "CORE": 1.5, "Platform Protect": 3.0,
    "SAT_SUITE": 2.0, "STARTER": 1.0, "PST": 1.2,
    "PSCP": 0.6, "Incident Management": 0.8, "STBP": 0.7, "ATO": 0.9, "DMARC": 5.0, "DMARC_PRO": 9.0,
    "THEMIS": 0.35, "URL": 0.25, "AS": 0.3, "PSTSAT": 0.45, "SAT": 0.55, "PSTSTB": 0.65, "STB": 0.75, "AIEB": 1.1, "MT": 0.15,
}
TIERS = [(1, 100, 1.0), (101, 1000, 0.85), (1001, 999999999, 0.7)]
ROOTS_A_TASK = 2000                     # roots whose price rows one task makes (not in the SQL recipes)
# ---------------------------------------------------------------------------


# Roots (partners): the ids below FIRST_ROOTS and every ROOT_EVERY-th id, so that their number grows
# with the customers; root 1 still holds about a quarter of all tenants.
FIRST_ROOTS = 10
ROOT_EVERY = 3
# Chains: ids whose remainder lies in this range hang under the id before and are no roots.
CHAIN_EVERY, CHAIN = 101, (35, 40)


def chained(k) -> "F.Column":
    return (k % CHAIN_EVERY).between(*CHAIN)


def is_root(k) -> "F.Column":
    return (k < FIRST_ROOTS) | ((k % ROOT_EVERY == 0) & ~chained(k))


def owner_of(k) -> "F.Column":
    return F.when(chained(k), k - 1).otherwise(F.expr("c_custkey div 10"))


def snapshots(as_of) -> list:
    """The days that meta and prices are recorded on for a run date: the 1st and the day itself."""
    return sorted({as_of.replace(day=1), as_of})


def _case_lookup(col, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def _by_index(col, values: list):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (col + 1).cast("int"))


def company_brand(t: Tables) -> tuple[DataFrame, DataFrame]:
    """company (id, brand_id, name, region, approved) and brand (id, owner_id, name)."""
    cust = t.customer.select("c_custkey", "c_name", "c_nationkey")
    region = t.nation.select("n_nationkey", "n_regionkey")
    company = cust.join(tiny(region), cust.c_nationkey == region.n_nationkey, "left").select(
        F.col("c_custkey").alias("id"),
        F.when(~is_root(F.col("c_custkey")), F.col("c_custkey")).cast("bigint").alias("brand_id"),
        F.col("c_name").alias("name"),
        _by_index(F.col("n_regionkey"), REGION_CODES).alias("region"),
    )
    brand = cust.filter(~is_root(F.col("c_custkey"))).select(
        F.col("c_custkey").alias("id"),
        owner_of(F.col("c_custkey")).alias("owner_id"),
        F.concat(F.lit("Brand "), owner_of(F.col("c_custkey")).cast("string")).alias("name"),
    )
    return company, brand


def tenant_tree(t: Tables) -> DataFrame:
    company, brand = company_brand(t)
    return tree_ops.decode(tree_ops.closure(company, brand))


def tenant_history(t: Tables, tree: DataFrame | None = None) -> DataFrame:
    """Daily tenant snapshot (one row per tenant per record_date)."""
    tree = tree if tree is not None else tenant_tree(t)
    ev = t.events.select("user_id", "ts", "event_type", "value")
    daily = ev.groupBy("user_id", F.to_date("ts").alias("record_date")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("event_type") == "error").alias("n_error"),
        F.count_if(F.col("event_type") == "view").alias("n_view"),
        F.min("event_type").alias("first_type"),
        F.max("value").alias("max_value"),
        F.bool_or(F.col("event_type") == "purchase").alias("incident_management"),
        F.bool_or(F.col("event_type") == "click").alias("simulation_and_training_bundle_plus"),
        F.bool_or(F.col("event_type") == "signup").alias("ato"),
    )
    u = F.col("user_id")
    nodes = tree.select("tenant_id", "tenant_name", "parent_name", "root", "parent_global_id",
                        "tenant_global_id", "tree_key", "id_path", "depth")
    hist = daily.join(nodes, daily.user_id == nodes.tenant_id)
    # partner tenants: every fourth, and the partners' own
    partner = (u % 4 == 1) | (u % ROOT_EVERY == 0)
    seats = F.when(partner, PARTNER_SEATS).otherwise(0)
    plan_id = _case_lookup(F.when(u % 4 == 0, F.lit("purchase")).otherwise(F.col("first_type")),
                           {t: i for i, t in enumerate(PLAN_BY_EVENT, 1)})
    return hist.select(
        "record_date", "root", "parent_global_id", "parent_name", "tenant_global_id", "tenant_name",
        "tree_key", "id_path", "depth",
        F.coalesce(_case_lookup(u % 19, TRAINING_PLANS), F.when(u % 4 == 0, F.lit(FIXED_PLAN)),
                   _case_lookup(F.col("first_type"), PLAN_BY_EVENT)).alias("plan_name"),
        _case_lookup(u % 5, PREMIUM_BY_MOD5).cast("string").alias("premium_name"),
        (F.col("n_events") * 40 + seats).cast("bigint").alias("active_profiles"),
        (F.col("n_events") * 40 + 5 + seats).cast("bigint").alias("licensed_profiles"),
        F.when(F.col("n_error") > 0, F.col("n_error")).cast("bigint").alias("shared_profiles"),
        (u % 13 != 5).alias("approved"),
        F.when(u % 11 == 4, "Inactive").when(u % 7 == 2, "Active-POC").otherwise("Active").alias("billing_status"),
        partner.alias("partner_pricing"),
        (u % 12 == 5).alias("not_nfr_partner"),
        "incident_management", "simulation_and_training_bundle_plus", "ato",
        (u % 4 != 0).alias("dmarc_management"),
        F.col("n_view").cast("int").alias("dmarc_domains_number"),
        F.when(u % 4 != 0, (u % 4)).cast("int").alias("dmarc_plan"),
        F.date_add(F.lit(dt.date(2023, 9, 1)), (u % 150).cast("int")).alias("registration_date"),
        # link_scanning is unknown for some tenants
        *[(F.when(u % 7 != 1, u % d == r) if c == "link_scanning" else u % d == r).alias(c) for c, (d, r) in FLAGS.items()],
        plan_id.cast("int").alias("plan_id"),
        F.when(u % 17 != 0, F.date_add(F.lit(dt.date(2024, 6, 1)), (u % 90).cast("int"))).alias("plan_expiry_date"),
        F.when(u % 9 == 0, F.date_add(F.lit(dt.date(2024, 2, 1)), (u % 30).cast("int"))).alias("trial_plan_expiry_date"),
    )


def account_meta(t: Tables, as_of=AS_OF) -> DataFrame:
    """One meta row per root and snapshot day (the 1st and ``as_of``)."""
    roots = t.customer.filter(is_root(F.col("c_custkey"))).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nat = t.nation.select("n_nationkey", "n_regionkey")
    r = roots.join(tiny(nat), roots.c_nationkey == nat.n_nationkey, "left")
    snaps = snapshots(as_of)
    r = r.withColumn("snapshot_date", F.explode(F.array(*[F.lit(d) for d in snaps])))
    k = F.col("c_custkey")
    return r.select(
        "snapshot_date",
        F.concat(_by_index(F.col("n_regionkey"), REGION_CODES), F.lit("-"), k.cast("string")).alias("tenant_global_id"),
        F.col("c_name").alias("tenant_name"),
        F.date_add(F.lit(dt.date(2023, 6, 1)), (k * 7 % 200).cast("int")).alias("registration_date"),
        F.concat(F.lit("AM-"), F.col("c_nationkey").cast("string")).alias("account_master_id"),
        (k != 9).alias("is_tracked"),
        (k % 5 != 0).alias("is_highwatermark"),
        _by_index(F.col("n_regionkey"), CURRENCIES).alias("currency"),
        _by_index(k % 3, PROFILE_TYPES).alias("profile_type"),
        F.when(F.col("c_mktsegment") == "BUILDING", "disti").when(F.col("c_mktsegment") == "MACHINERY", "oem")
        .otherwise("msp").alias("ltp_type"),
    )


def pools(meta: DataFrame, as_of=AS_OF) -> DataFrame:
    """Pooled roots: root n with n % 4 = 3 is priced together with the root before it."""
    meta = meta.filter(F.col("snapshot_date") == F.lit(as_of))
    num = F.regexp_replace("tenant_global_id", "[^0-9]", "").cast("bigint")
    m = meta.select("tenant_global_id", "tenant_name", num.alias("n"))
    masters = m.select(F.col("tenant_global_id").alias("master_tenant_id"), (F.col("n") + F.when(F.col("n") < FIRST_ROOTS, 1).otherwise(ROOT_EVERY)).alias("n"))
    return m.filter(F.col("n") % 4 == 3).join(masters, "n").select(
        F.col("tenant_global_id").alias("global_tenant_id"), "tenant_name", "master_tenant_id")


def price_list(meta: DataFrame, as_of=AS_OF) -> DataFrame:
    """Long price list: root x sku x is_nfr x tier, two snapshots, promo rows.

    Built with ``explode`` of small literal arrays per root row (no join). A root gives about two
    hundred rows, so the roots are spread first; a root's rows stay in one partition, so what groups
    the list by root needs no shuffle of its own.
    """
    meta = spread(meta.filter(F.col("snapshot_date") == F.lit(as_of)), "tenant_global_id", rows=ROOTS_A_TASK)
    num = F.regexp_replace("tenant_global_id", "[^0-9]", "").cast("bigint")
    skus = F.array(*[F.struct(F.lit(s).alias("sku"), F.lit(BASE_PRICE[s]).alias("base"))
                     for s in PLAN_SKUS + ADDON_SKUS])
    tiers = F.array(*[F.struct(F.lit(a).alias("tier_min"), F.lit(b).alias("tier_max"), F.lit(m).alias("mult"))
                      for a, b, m in TIERS])
    days = snapshots(as_of)
    snaps = F.array(*[F.lit(d) for d in days])
    # promos only on one plan sku; add-on skus carry no partner price rows
    promoted = (F.col("s.sku") == "Email Protect") & (F.col("n") % 3 != 0)
    rows = (
        meta.select("tenant_global_id", num.alias("n"))
        .withColumn("s", F.explode(skus)).withColumn("t", F.explode(tiers))
        .withColumn("is_nfr", F.explode(F.when(F.col("s.sku").isin(*PLAN_SKUS), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
        .withColumn("snapshot_date", F.explode(snaps))
        .withColumn("kind", F.explode(F.when(promoted, F.array(F.lit("std"), F.lit("promo"))).otherwise(F.array(F.lit("std")))))
    )
    base = (F.col("s.base") * F.col("t.mult") * (F.lit(1.0) + F.col("n") % 100 / 100.0)
            * F.when(F.col("is_nfr"), F.when((F.col("n") % 5).isin(*FREE_NFR_ROOTS), 0.0).otherwise(0.5)).otherwise(1.0)
            * F.when(F.col("snapshot_date") == F.lit(as_of.replace(day=1)), 0.95).otherwise(1.0))
    promo = F.col("kind") == "promo"
    live = dt.date(2024, 1, 15), dt.date(2024, 2, 15)
    ended = dt.date(2023, 12, 1), dt.date(2024, 1, 20)
    return rows.select(
        "snapshot_date", "tenant_global_id", F.col("s.sku").alias("sku"), "is_nfr",
        F.col("t.tier_min").cast("int").alias("tier_min"), F.col("t.tier_max").cast("int").alias("tier_max"),
        F.round((base * F.when(promo, 0.8).otherwise(1.0)).cast("decimal(38,10)"), 4).cast("decimal(18,4)").alias("price"),
        F.when(promo & (F.col("n") % 3 == 1), F.lit(live[0])).when(promo, F.lit(ended[0]))
        .otherwise(F.lit(dt.date(2020, 1, 1))).alias("start_date"),
        F.when(promo & (F.col("n") % 3 == 1), F.lit(live[1])).when(promo, F.lit(ended[1]))
        .otherwise(F.lit(dt.date(2099, 12, 31))).alias("end_date"),
        F.when(promo, "Promo Price").otherwise("Standard Price").alias("price_type"),
    )


def exceptions(tree: DataFrame) -> DataFrame:
    """Tenant-level rate overrides: tenants with id % 20 = 8 on the fixed plan, two tiers each."""
    k = F.col("tenant_id")
    rows = tree.filter(~is_root(k) & (k % 4 == 0) & (k % 20 == 8)).withColumn(
        "t", F.explode(F.array(
            F.struct(F.lit(1).alias("tier_min"), F.lit(20).alias("tier_max"), F.lit(0.5).alias("rate")),
            F.struct(F.lit(21).alias("tier_min"), F.lit(999999).alias("tier_max"), F.lit(0.4).alias("rate")))))
    return rows.select(
        F.col("tenant_global_id").alias("tenant_id"), "tenant_name",
        F.lit("USD").alias("currency"), F.lit("active").alias("profile_type"),
        F.lit(FIXED_PLAN).alias("item"), F.lit("IS-LTP-EP").alias("sku"),
        F.lit(False).alias("partner_pricing"),
        F.col("t.tier_min").cast("int").alias("tier_min"),
        F.col("t.rate").cast("decimal(18,4)").alias("tier_rate"),
        F.col("t.tier_max").cast("int").alias("tier_max"),
        F.lit(dt.date(2024, 1, 1)).alias("start_date"), F.lit(dt.date(2024, 12, 31)).alias("end_date"),
        F.lit("Tenant").alias("tenant_msp"),
        F.col("root").alias("parent_id"),
    )


def min_commitments(meta: DataFrame, as_of=AS_OF) -> DataFrame:
    """Monthly minimums for roots with id % 4 = 1."""
    meta = meta.filter(F.col("snapshot_date") == F.lit(as_of))
    num = F.regexp_replace("tenant_global_id", "[^0-9]", "").cast("bigint")
    m = meta.select("tenant_global_id", "tenant_name", num.alias("n"))
    return m.filter(F.col("n") % 4 == 1).select(
        "tenant_global_id", "tenant_name",
        (F.lit(1500) + F.col("n") % 10 * 1000).cast("decimal(18,4)").alias("monthly_commitment_amount"),
        F.lit(dt.date(2024, 1, 1)).alias("start_date"), F.lit(dt.date(2024, 12, 31)).alias("end_date"),
    )


def fx_rates(t: Tables) -> DataFrame:
    """One rate per currency per event day: 1 + 0.1 * region + day / 1000."""
    days = t.events.select(F.to_date("ts").alias("startdate")).distinct()
    reg =F.explode(F.array(*[F.struct(F.lit(i).alias("r"), F.lit(c).alias("isocode"))
                              for i, c in enumerate(CURRENCIES)]))
    return days.select("startdate", reg.alias("c")).select(
        F.col("c.isocode").alias("isocode"),
        F.round((F.lit(1.0) + F.col("c.r") * 0.1 + F.dayofmonth("startdate") / 1000.0).cast("decimal(38,10)"), 4)
        .cast("decimal(18,4)").alias("conversionrate"),
        "startdate",
    )


# ---------------------------------------------------------------------------
# Usage lines (lineitem world): monthly metered usage per partner and item
# ---------------------------------------------------------------------------
# Item tiers (min, max, multiplier of the item's base price).
ITEM_TIERS = [(1, 50, 1.0), (51, 200, 0.9), (201, None, 0.8)]
MIN_BILLED_QTY = 100
ITEMS = [f"Brand#{i}" for i in range(1, 26)]        # the 25 part brands, by rule


def usage_keys(t: Tables) -> DataFrame:
    """One row per lineitem with numeric partner/tenant keys (cheap to shuffle).

    Orders meet their customers before the lines, and the lines carry what is computed from them instead of what it
    is computed from: they move once to their part and once to their order.
    """
    li = t.lineitem.select(
        "l_orderkey", "l_partkey", F.to_date(F.date_trunc("month", "l_shipdate")).alias("billing_date"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.round((F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).cast("decimal(38,10)"), 4)
        .cast("decimal(18,4)").alias("revenue"))
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("order_date"))
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    p = t.part.select("p_partkey", F.col("p_brand").alias("item"), F.col("p_type").alias("sku"), F.col("p_retailprice").alias("list_price"))
    n = t.nation.select("n_nationkey", "n_regionkey")
    moved = F.col("o_orderpriority") == "5-LOW"   # these orders are billed through the next partner
    owned = (o.join(c, o.o_custkey == c.c_custkey).join(tiny(n), F.col("c_nationkey") == n.n_nationkey).select(
        "o_orderkey", "c_nationkey",
        F.when(moved, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey")).alias("channel_nationkey"),
        F.col("n_regionkey").alias("region_key"), "o_custkey",
        (F.col("o_orderpriority") == "1-URGENT").alias("is_nfr"),
        F.when(F.col("c_mktsegment") == "BUILDING", "disti").when(F.col("c_mktsegment") == "MACHINERY", "oem")
        .otherwise("msp").alias("ltp_type"),
        "order_date"))
    j = li.join(p, li.l_partkey == p.p_partkey).join(owned, F.col("l_orderkey") == owned.o_orderkey)
    return j.select("billing_date", "c_nationkey", "channel_nationkey", "region_key", "o_custkey", "item", "sku", "is_nfr",
                    "quantity", "revenue", "list_price", "ltp_type", "order_date")


def with_ids(df: DataFrame) -> DataFrame:
    """String partner / channel / pool / tenant ids from the numeric keys."""
    return df.select(
        "*",
        F.concat(F.lit("N-"), F.col("c_nationkey").cast("string")).alias("ltp"),
        F.concat(F.lit("N-"), F.col("channel_nationkey").cast("string")).alias("channel_ltp"),
        F.concat(F.lit("R-"), F.col("region_key").cast("string")).alias("pool"),
        F.concat(F.lit("C-"), F.col("o_custkey").cast("string")).alias("tenant"),
    ).drop("c_nationkey", "channel_nationkey", "o_custkey")


def usage_lines(t: Tables) -> DataFrame:
    """One row per lineitem: month, partner (nation), pool (region), tenant (customer), item (brand)."""
    return with_ids(usage_keys(t))


def item_tiers(t: Tables) -> DataFrame:
    """Tier rows per item: base = min list price of the brand / 100, times the tier multiplier."""
    base = t.part.groupBy(F.col("p_brand").alias("item")).agg(F.min("p_retailprice").alias("rp"))
    tiers = F.array(*[F.struct(F.lit(a).cast("int").alias("tier_min"), F.lit(b).cast("int").alias("tier_max"),
                               F.lit(m).alias("mult")) for a, b, m in ITEM_TIERS])
    return base.select("item", "rp", F.explode(tiers).alias("t")).select(
        "item", "t.tier_min", "t.tier_max",
        F.round((F.col("rp") / 100.0 * F.col("t.mult")).cast("decimal(38,10)"), 4).cast("decimal(18,4)")
        .alias("price"))


# ---------------------------------------------------------------------------
# Wide legacy price table: one column per plan, partner flag and breakpoint
# ---------------------------------------------------------------------------
# Column stem -> (plan, base price); a partner column has the stem's name with NFR.
WIDE_PLANS = {"EP": ("Email Protect", 2.4), "CORE": ("Core", 1.4), "CP": ("Complete Protect", 3.9),
              "SAT_SUITE": ("SAT Suite", 1.9)}
WIDE_BREAKS = [1, 100, 350, 750]


def wide_prices(meta: DataFrame, as_of=AS_OF) -> DataFrame:
    """One row per partner: EP_1, EP_100, ..., EPNFR_1, ... A price is 5 % lower at each breakpoint; partners
    whose number is divisible by 7 have none for SAT_SUITE."""
    n = F.regexp_replace("tenant_global_id", "[^0-9]", "").cast("bigint")
    cols = []
    for stem, (_, base) in WIDE_PLANS.items():
        for i, b in enumerate(WIDE_BREAKS):
            price = F.round((F.lit(base) * (1 - 0.05 * i) + n % 50 / 100.0).cast("decimal(38,10)"), 4).cast("decimal(18,4)")
            cols.append((F.when(n % 7 != 0, price) if stem == "SAT_SUITE" else price).alias(f"{stem}_{b}"))
        cols.append((F.round((F.lit(base) / 2).cast("decimal(38,10)"), 4).cast("decimal(18,4)")).alias(f"{stem}NFR_1"))
    return meta.filter(F.col("snapshot_date") == F.lit(as_of)).select("tenant_global_id", "profile_type", *cols)


# ---------------------------------------------------------------------------
# Activity documents: a period and a list of daily objects, as an API delivers them
# ---------------------------------------------------------------------------
# Counters of a daily object by the day's events of each type; a NULL one is absent from the object.
ACTIVITY_COUNTERS = {
    "acceptedLinesAdded": "n_purchase * 3", "acceptedLinesDeleted": "n_error", "agentRequests": "n_click",
    "apiKeyReqs": "nullif(n_signup, 0)", "bugbotUsages": "nullif(n_error, 0)", "chatRequests": "n_view",
    "cmdkUsages": "n_click + n_view", "composerRequests": "n_all", "subscriptionIncludedReqs": "n_all - n_purchase",
    "totalAccepts": "n_purchase", "totalApplies": "n_purchase + n_click", "totalLinesAdded": "n_all * 5",
    "totalLinesDeleted": "n_error * 2", "totalRejects": "n_error", "totalTabsAccepted": "n_click",
    "totalTabsShown": "n_click + n_error", "usageBasedReqs": "nullif(n_purchase, 0)",
}


def activity_docs(t: Tables) -> DataFrame:
    """One document per user and week: period (JSON object of epoch ms), data (JSON).

    data is an array of daily objects, ordered by day; by user_id % 7: 3 has none (NULL), 4 a scalar, 5 the objects
    as members of one object, 6 an empty array.
    """
    types = ("view", "signup", "purchase", "click", "error")
    u = F.col("user_id")
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n_all"), *[F.count_if(F.col("event_type") == x).alias(f"n_{x}") for x in types],
        F.min("event_type").alias("first_type"))
    one = F.struct(
        F.date_format("day", "yyyy-MM-dd").alias("day"), F.concat(F.lit("u"), u.cast("string"), F.lit("@example.com")).alias("email"),
        u.cast("string").alias("userId"), (F.col("n_purchase") > 0).alias("isActive"),
        F.concat(F.lit("1."), (u % 10).cast("string")).alias("clientVersion"), F.col("first_type").alias("mostUsedModel"),
        F.when(u % 2 == 0, ".py").alias("applyMostUsedExtension"), F.when(u % 3 == 0, ".sql").alias("tabMostUsedExtension"),
        *[F.expr(e).alias(n) for n, e in ACTIVITY_COUNTERS.items()])
    docs = daily.select("user_id", F.to_date(F.date_trunc("week", "day")).alias("week"), "day", one.alias("one")) \
        .groupBy("user_id", "week").agg(F.array_sort(F.collect_list(F.struct("day", "one"))).alias("d"))
    objects = F.transform("d", lambda x: x["one"])
    members = F.map_from_entries(F.transform("d", lambda x: F.struct(F.date_format(x["day"], "yyyyMMdd"), x["one"])))
    start = F.unix_date("week") * F.lit(86_400_000).cast("bigint")
    period = F.to_json(F.struct(start.alias("startDate"), (start + 7 * 86_400_000 - 1).alias("endDate")))
    data = (F.when(u % 7 == 3, F.lit(None)).when(u % 7 == 4, F.lit('"no data"')).when(u % 7 == 5, F.to_json(members))
            .when(u % 7 == 6, F.lit("[]")).otherwise(F.to_json(objects)))
    return docs.select(period.alias("period"), data.alias("data"))


# ---------------------------------------------------------------------------
# CRM tables from orders, customers and nations
# ---------------------------------------------------------------------------
OPP_TYPES = {"1-URGENT": "Renewal", "2-HIGH": "Renewal/Upsell", "3-MEDIUM": "Terminated"}
OPP_STAGES = {"F": "Closed Won", "P": "Closed Lost"}


def opportunities(t: Tables) -> DataFrame:
    """An order as an opportunity: its type by priority, its stage by status; the loss is the price, but a gain for every 13th."""
    k = F.col("o_orderkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    return t.orders.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        k.alias("opp_id"), F.col("o_custkey").alias("account_id"), F.col("c_nationkey").alias("owner_id"),
        _case_lookup(F.col("o_orderpriority"), OPP_TYPES, "New").alias("type"), _case_lookup(F.col("o_orderstatus"), OPP_STAGES, "Open").alias("stage"),
        F.to_date("o_orderdate").alias("churn_date"),
        F.when(k % 13 == 0, F.col("o_totalprice")).otherwise(-F.col("o_totalprice")).alias("change_in_arr"), F.col("o_totalprice").alias("arr"),
        F.when(k % 97 != 0, k % 4000).alias("users"), F.when(k % 5 != 0, F.concat(F.lit("reason "), (k % 5).cast("string"))).alias("loss_reason"))


def accounts(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("account_id"), F.col("c_name").alias("account_name"), F.col("c_acctbal").alias("total_arr"))


def owners(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("owner_id"), F.col("n_name").alias("owner_name"))


def pocs(t: Tables) -> DataFrame:
    """Trials: the lines 1 and 2 of every third order."""
    li = t.lineitem.filter((F.col("l_orderkey") % 3 == 0) & F.col("l_linenumber").isin(1, 2))
    return li.select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("poc_id"), F.col("l_orderkey").alias("opp_id"),
                     F.concat(F.lit("POC "), F.col("l_linenumber").cast("string")).alias("poc_name"), F.to_date("l_shipdate").alias("end_date"))


def people(t: Tables) -> DataFrame:
    """Three of four users are known people."""
    u = F.col("user_id")
    return t.events.select("user_id").distinct().filter(u % 4 != 0).select(
        F.concat(F.lit("u"), u.cast("string"), F.lit("@example.com")).alias("email"),
        F.element_at(F.array(F.lit("backend"), F.lit("frontend"), F.lit("data")), (u % 3 + 1).cast("int")).alias("skill_set"),
        F.concat(F.lit("team "), (u % 5).cast("string")).alias("team"))


def sprints(t: Tables) -> DataFrame:
    """Sprints of ten days; weekends belong to none."""
    day = F.to_date("ts")
    return t.events.select(day.alias("datestamp")).distinct().filter(~F.dayofweek("datestamp").isin(1, 7)).select(
        "datestamp", F.concat(F.lit("Sprint "), F.floor(F.dayofyear("datestamp") / 10).cast("string")).alias("sprint"))


def past_activity(t: Tables, until) -> DataFrame:
    """Activity of the days up to ``until`` as it was stored, of all users."""
    ev = t.events.select("user_id", F.to_date("ts").alias("date"), "event_type").filter(F.col("date") <= F.lit(until))
    n = lambda x: F.count_if(F.col("event_type") == x)
    g = ev.groupBy("user_id", "date").agg(F.count(F.lit(1)).alias("n_all"), n("purchase").alias("n_purchase"), n("error").alias("n_error"), n("click").alias("n_click"))
    return g.select(F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email"), "date",
                    (F.col("n_all") * 5 + F.col("n_error") * 2).alias("suggested"), (F.col("n_purchase") * 3 + F.col("n_error")).alias("accepted"),
                    F.col("n_click").alias("agent_requests"))
