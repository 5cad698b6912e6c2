"""Sub-tenant (layer-grain) pricing read back from the root bill.

The root bill is small (partners x items); each sub-tenant row joins it on
(first layer, item, partner flag). Several price types for one item fan that
join out, as in the reference; the tests pin the row counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.joins import multiplied
from .pricing import DMARC_ITEM, DMARC_PRICE_SKU, DMARC_SKU, PLAN_SKUS, PREMIUM_NAMES, effective_partner, lookup, \
    price_sku

LAYERS = ["first_layer_id", "second_layer_id", "third_layer_id", "fourth_layer_id", "fifth_layer_id"]
# The billed tenant is known by its own full id, however deep it hangs; the layers are only shown.
TENANT = "tenant_global_id"
# The price-list skus of the flat add-ons.
FLAT_SKUS = ["PSCP", "Incident Management", "STBP", "ATO"]
OUT = ["billing_date", TENANT, *LAYERS, "item", "sku", "partner_pricing", "billable_quantity", "amount", "price_type"]


def item_price_type(pt: Column) -> Column:
    """Price type read from the root bill: '' and NULL mean Standard; only the long labels map."""
    v = F.coalesce(F.nullif(pt, F.lit("")), F.lit("Standard"))
    return F.when(v == "Promo Price", "Promo").when(v == "Exceptional Price", "Exceptional").otherwise("Standard")


def base_rows(layered: DataFrame, meta: DataFrame) -> DataFrame:
    """One row per sub-tenant with its own billable seats (no aggregation)."""
    m = meta.select(F.col("tenant_global_id").alias("first_layer_id"), "profile_type")
    g = layered.filter(F.col("approved") & F.col("billing_status").isin("Active", "Active-POC"))
    pt, a = F.col("profile_type"), F.col("active_profiles")
    qty = (F.when(pt == "active", a).when(pt == "license", F.col("licensed_profiles"))
           .when(pt == "shared", F.coalesce(a - F.col("shared_profiles"), a)))
    return g.join(m, "first_layer_id").filter(pt.isNotNull()).select(
        F.col("date_recorded").alias("billing_date"), TENANT, *LAYERS, "plan_name", "premium_name",
        effective_partner().alias("partner_pricing"), "incident_management",
        "simulation_and_training_bundle_plus", "ato", "profile_type", qty.alias("billable_quantity"))


def _bill(itemized: DataFrame) -> DataFrame:
    """The root bill as a lookup (partners x items: a dimension, broadcast behind its size check)."""
    return itemized.select(F.col("ltp").alias("first_layer_id"), F.col("item").alias("_item"),
                           F.col("partner_pricing").alias("_pp"), F.col("quantity").alias("_q"),
                           F.col("amount").alias("_a"), F.col("price_type").alias("_pt"))


def blended(base: DataFrame, itemized: DataFrame) -> DataFrame:
    """Commercial plan seats at the parent line's blended rate, seats x amount / quantity."""
    b = base.filter((F.col("partner_pricing") == F.lit(False)) & F.col("plan_name").isin(*PLAN_SKUS))
    i = _bill(itemized)
    j = b.join(i, (b.first_layer_id == i.first_layer_id) & (b.plan_name == i._item)
               & (b.partner_pricing == i._pp), "left").drop(i.first_layer_id)
    rate = F.col("_a").cast("double") / F.nullif(F.col("_q"), F.lit(0)).cast("double")
    return j.select("billing_date", TENANT, *LAYERS, F.col("plan_name").alias("item"),
                    lookup(F.col("plan_name"), {p: v[1] for p, v in PLAN_SKUS.items()}).alias("sku"),
                    "partner_pricing", "billable_quantity", (F.col("billable_quantity") * rate).alias("amount"),
                    item_price_type(F.col("_pt")).alias("price_type"))


def _priced(b: DataFrame, prices: DataFrame, itemized: DataFrame, skus: Sequence[str]) -> DataFrame:
    """Rows with item, sku, partner_pricing, billable_quantity, price_sku (one of ``skus``), is_nfr (NULL: either) -> lines
    at the first tier's price, with the price type of the root bill's line of the same item and partner flag."""
    p = prices.filter((F.col("tier_min") == 1) & F.col("sku").isin(*skus)).select(F.col("tenant_global_id").alias("first_layer_id"), F.col("sku").alias("price_sku"),
                                             F.col("is_nfr").alias("_nfr"), "price")
    j = b.join(multiplied(p), ["first_layer_id", "price_sku"]).filter(F.col("is_nfr").isNull() | (F.col("is_nfr") == F.col("_nfr")))
    i = _bill(itemized)
    j = j.join(i, (j.first_layer_id == i.first_layer_id) & (j.item == i._item) & j.partner_pricing.eqNullSafe(i._pp), "left") \
        .drop(i.first_layer_id)
    amount = F.col("billable_quantity").cast("decimal(20,0)") * F.col("price").cast("decimal(18,4)")
    return j.select("billing_date", TENANT, *LAYERS, "item", "sku", "partner_pricing", "billable_quantity",
                    amount.cast("double").alias("amount"), item_price_type(F.col("_pt")).alias("price_type"))


def flat_lines(base: DataFrame, prices: DataFrame, itemized: DataFrame) -> DataFrame:
    """Partner-seat plan rate (P20) and flat add-ons per sub-tenant (P21): every row lists what it is billed for,
    then one price join and one bill join serve all items."""
    plan, commercial = F.col("plan_name"), F.col("partner_pricing") == F.lit(False)
    none = F.lit(None).cast("boolean")

    def entry(cond: Column, item: Column, sku: Column, price: Column, partner: Column, nfr: Column) -> Column:
        return F.when(cond, F.struct(item.alias("item"), sku.alias("sku"), price.alias("price_sku"), partner.alias("pp"), nfr.alias("is_nfr")))

    partner_plans = {p: v[2] for p, v in PLAN_SKUS.items() if v[2]}
    entries = [
        entry((F.col("partner_pricing") == F.lit(True)) & plan.isin(*partner_plans), plan, lookup(plan, partner_plans),
              price_sku(plan), F.lit(True), F.lit(True)),
        entry(F.col("premium_name").isin(*PREMIUM_NAMES), F.col("premium_name"), F.lit("IS-LTP-PSCP"), F.lit("PSCP"), none, none),
        entry(F.col("incident_management") == F.lit(True), F.lit("Incident Management"), F.lit("IS-LTP-IM"),
              F.lit("Incident Management"), none, none),
        entry((F.col("simulation_and_training_bundle_plus") == F.lit(True)) & ~plan.isin("Complete Protect", "SAT Suite") & commercial,
              F.lit("S&T Bundle Plus"), F.lit("IS-LTP-STBP"), F.lit("STBP"), none, none),
        entry((F.col("ato") == F.lit(True)) & (plan != "Complete Protect") & commercial, F.lit("Account Takeover"),
              F.lit("IS-LTP-ATO"), F.lit("ATO"), none, none),
    ]
    e = base.select("billing_date", TENANT, *LAYERS, "billable_quantity",
                    F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("e"))
    e = e.select("billing_date", TENANT, *LAYERS, "billable_quantity", "e.item", "e.sku", "e.price_sku", "e.is_nfr",
                 F.col("e.pp").alias("partner_pricing"))
    return _priced(e, prices, itemized, [*(PLAN_SKUS[x][0] for x in partner_plans), *FLAT_SKUS])


def per_leaf(layered_dmarc: DataFrame, dmarc_picks: DataFrame, prices: DataFrame, itemized: DataFrame) -> DataFrame:
    """Per-unit add-on joined on the billed tenant's own id (P22); positive counts only."""
    g = layered_dmarc.filter(F.col("approved") & F.col("billing_status").isin("Active", "Active-POC")
                             & F.col("dmarc_plan").isNotNull())
    d = dmarc_picks.select(TENANT, F.col("dmarc_domains_number").alias("_dom"))
    g = g.join(d, TENANT).filter(F.col("_dom").isNotNull() & (F.col("_dom") > 0))
    plan, none = F.col("dmarc_plan"), F.lit(None).cast("boolean")
    b = g.select(F.col("date_recorded").alias("billing_date"), TENANT, *LAYERS, F.col("_dom").alias("billable_quantity"),
                 lookup(plan, DMARC_ITEM).alias("item"), lookup(plan, DMARC_SKU).alias("sku"),
                 lookup(plan, DMARC_PRICE_SKU).alias("price_sku"), none.alias("partner_pricing"), none.alias("is_nfr"))
    return _priced(b, prices, itemized, sorted(set(DMARC_PRICE_SKU.values())))


def min_commit_passthrough(itemized: DataFrame) -> DataFrame:
    """Top-up rows of the root bill on the root itself, lower layers NULL."""
    i = itemized.filter(F.col("item") == "Monthly Minimum")
    return i.select("billing_date", F.col("ltp").alias(TENANT), F.col("ltp").alias("first_layer_id"),
                    *[F.lit(None).cast("string").alias(c) for c in LAYERS[1:]], "item", "sku", "partner_pricing",
                    F.col("quantity").alias("billable_quantity"), "amount", "price_type")


BRANCHES = ("blended", "flat", "per_unit", "min_commit")


def subtenant_lines(layered: DataFrame, layered_dmarc: DataFrame, dmarc_picks: DataFrame, meta: DataFrame,
                    prices: DataFrame, itemized: DataFrame, branches: Sequence[str] = BRANCHES) -> DataFrame:
    """The named branches of the sub-tenant lines, all by default."""
    base = base_rows(layered, meta)
    made = {"blended": lambda: blended(base, itemized), "flat": lambda: flat_lines(base, prices, itemized),
            "per_unit": lambda: per_leaf(layered_dmarc, dmarc_picks, prices, itemized),
            "min_commit": lambda: min_commit_passthrough(itemized)}
    out = reduce(DataFrame.unionByName, [made[b]().select(*OUT) for b in branches])
    return out.select("billing_date", TENANT, *LAYERS, "item", "sku", F.col("partner_pricing").cast("boolean"),
                      F.col("billable_quantity").cast("bigint"), F.col("amount").cast("double"), "price_type")
