"""Marts: itemized bills, pivots, sparse JSON, channel roll-ups (M1, M5-M9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date
from ..functions.money import dec

ITEM_KEYS = ["billing_date", "ltp", "item", "sku", "partner_pricing", "price_type"]


def itemize(lines: DataFrame, nfr: DataFrame | None, as_of, keys: Sequence[str] = ("ltp",),
            qty_col: str = "quantity", partner: Sequence[str] = ()) -> DataFrame:
    """Itemized bill (M1): lines grouped to the bill grain plus partner-seat lines.

    ``keys`` is the partner grain (the root, or the billed tenant with its layers); partner-seat
    lines have the partner's id in the keys named by ``partner`` (by default the first one), the other keys are NULL. Amounts are rounded to
    4 decimals per line and summed as DECIMAL, so totals do not depend on row order.
    """
    d = F.lit(as_date(as_of))
    grain = [*keys, "item", "sku", "partner_pricing", "price_type"]
    g = lines.groupBy(*grain).agg(F.sum(qty_col).cast("bigint").alias("quantity"),
                                  F.sum(dec("amount")).cast("double").alias("amount"))
    out = g.select(d.alias("billing_date"), *grain, "quantity", "amount")
    if nfr is not None:
        own = set(partner) or {keys[0]}
        n = nfr.select(d.alias("billing_date"),
                       *[(F.col("tenant_global_id") if k in own else F.lit(None).cast("string")).alias(k) for k in keys],
                       F.lit("NFR").alias("item"), F.lit("IS-LTP-NFR").alias("sku"),
                       F.lit(None).cast("boolean").alias("partner_pricing"),
                       F.lit(None).cast("string").alias("price_type"),
                       F.col("billable_qty").cast("bigint").alias("quantity"),
                       dec("invoice").cast("double").alias("amount"))
        out = out.unionByName(n)
    return out


def pivot_items(df: DataFrame, keys: Sequence[str], item_col: str, values: dict[str, str],
                measure: Column) -> DataFrame:
    """Conditional pivot (M5): one column per listed item (value -> column name), max(measure).

    The item list is fixed, so Spark does not scan for distinct items and the
    pivot stays one hash aggregate with partial aggregation.
    """
    aggs = [F.max(F.when(F.col(item_col) == v, measure)).alias(name) for v, name in values.items()]
    return df.groupBy(*keys).agg(*aggs)


def sparse_json(pairs: Sequence[tuple[str, Column]]) -> Column:
    """JSON object holding only the keys whose value is not NULL (M7)."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in pairs]))


def channel_rollup(bill: DataFrame, meta: DataFrame, names: DataFrame, as_of) -> DataFrame:
    """Item quantities by channel (M9): distributors by layers 1 + 2, direct partners (msp) by layer 1, with names.

    Every channel has one grain, so the second layer is part of the key for distributors and empty for the
    others: one aggregate over the pivoted bill gives both grains, without a copy of the rows per grain.
    """
    kind = meta.groupBy(F.col("tenant_global_id").alias("first_layer_id")).agg(F.max("ltp_type").alias("ltp_type"))
    b = bill.filter(F.col("billing_date") == F.lit(as_date(as_of))).join(kind, "first_layer_id") \
        .filter(F.col("ltp_type").isin("disti", "msp"))
    second = F.when(F.col("ltp_type") == "disti", F.coalesce("second_layer_id", F.lit(""))).otherwise("")
    # a tenant's largest quantity of each item first, as in the mailbox mart, then the sum over tenants
    per = b.groupBy("ltp_type", "first_layer_id", second.alias("second_layer_id"), "tenant_global_id").agg(
        *[F.max(F.when(billed(item, pp), F.col("quantity")).otherwise(0)).alias(name) for name, item, pp in MAILBOX_ITEMS])
    both = per.groupBy("ltp_type", "first_layer_id", "second_layer_id").agg(
        F.count(F.lit(1)).alias("tenants"), *[F.sum(name).cast("bigint").alias(f"{name}_of_Licenses") for name, _, _ in MAILBOX_ITEMS])
    n = names.select("tenant_global_id", "tenant_name")
    first = n.toDF("first_layer_id", "msp_parent_name")
    own = n.toDF("msp_id", "msp_name")
    direct = F.col("ltp_type") == "msp"
    out = both.withColumn("msp_id", F.when(direct, F.col("first_layer_id")).otherwise(F.col("second_layer_id")))
    out = out.join(first, "first_layer_id", "left").join(own, "msp_id", "left")
    return out.select(F.when(direct, "direct").otherwise("second_tier").alias("msp_type"),
                      F.col("first_layer_id").alias("msp_parent_id"), "msp_parent_name", "msp_id", "msp_name", "tenants",
                      *[f"{name}_of_Licenses" for name, _, _ in MAILBOX_ITEMS])


# Mailbox-mart pivot columns (column prefix, item, partner flag or None for any).
MAILBOX_ITEMS = [
    ("Email_Protect", "Email Protect", False),
    ("Email_Protect_NFR", "Email Protect", True),
    ("Complete_Protect", "Complete Protect", False),
    ("Complete_Protect_NFR", "Complete Protect", True),
    ("Core", "Core", False),
    ("Core_NFR", "Core", True),
    ("Platform_Protect", "Platform Protect", False),
    ("Platform_Protect_NFR", "Platform Protect", True),
    ("Phishing_Simulation_and_Training", "Phishing Simulation and Training", False),
    ("Phishing_Simulation_and_Training_NFR", "Phishing Simulation and Training", True),
    ("Starter", "Starter", None),
    ("Premium_Content_Habitu8", "Habitu8", None),
    ("Premium_Content_NINJIO", "NINJIO", None),
    ("Premium_Content_Cybermaniacs", "Cybermaniacs Videos", None),
    ("Account_Takeover", "Account Takeover", None),
    ("Incident_Management", "Incident Management", None),
    ("Multi_Tenant", "Multi Tenant", None),
    ("ST_Bundle", "S&T Bundle", None),
    ("ST_Bundle_Plus", "S&T Bundle Plus", None),
    ("Security_Awareness_Training", "Security Awareness Training", None),
    ("Security_Awareness_Training_Suite", "SAT Suite", False),
    ("Security_Awareness_Training_Suite_NFR", "SAT Suite", True),
    ("DMARC_Core_Management", "DMARC Core Management", None),
    ("DMARC_Pro_Management", "DMARC Pro", None),
    ("DMARC_Premium_Management", "DMARC Premium", None),
]
# Members of the billable-items object (key, pivot column, own label: (suffix, text) or None).
BILLABLE = [
    ("PREMIUM_SAT_PACK", "Premium_Content_Habitu8", ("NAME", "Habitu8")),
    ("PREMIUM_SAT_PACK", "Premium_Content_NINJIO", ("NAME", "NINJIO")),
    ("PREMIUM_SAT_PACK", "Premium_Content_Cybermaniacs", ("NAME", "Cybermaniacs Videos")),
    ("ATO", "Account_Takeover", None),
    ("INCIDENT_MANAGEMENT", "Incident_Management", None),
    ("SIMULATION_AND_TRAINING_BUNDLE", "ST_Bundle", None),
    ("SIMULATION_AND_TRAINING_BUNDLE_PLUS", "ST_Bundle_Plus", None),
    ("SECURITY_AWARENESS_TRAINING", "Security_Awareness_Training", None),
    ("DMARC_MANAGEMENT", "DMARC_Core_Management", ("PLAN", "Core Management")),
    ("DMARC_MANAGEMENT", "DMARC_Pro_Management", ("PLAN", "Pro")),
    ("DMARC_MANAGEMENT", "DMARC_Premium_Management", ("PLAN", "Premium")),
]
# Members of the add-on object and the snapshot columns they show.
ADD_ONS = [
    ("INCIDENT_MANAGEMENT", "incident_management"), ("SECURITY_AWARENESS_TRAINING", "security_awareness_training"),
    ("SIMULATION_AND_TRAINING_BUNDLE", "simulation_and_training_bundle"),
    ("SIMULATION_AND_TRAINING_BUNDLE_PLUS", "simulation_and_training_bundle_plus"),
    ("AI_EMPOWER_BUNDLE", "ai_empower_bundle"), ("THEMIS_CO_PILOT", "themis_co_pilot"), ("ATO", "ato"),
    ("TEAMS_PROTECTION", "teams_protection"), ("FILE_SCANNING", "file_scanning"), ("LINK_SCANNING", "link_scanning"),
    ("MULTI_TENANCY", "multi_tenancy"), ("SAT_CONTENT_PACK", "premium_name"), ("DMARC", "dmarc_management"),
]


def billed(item: str, partner: bool | None) -> Column:
    cond = F.col("item") == item
    return cond if partner is None else cond & (F.col("partner_pricing") == F.lit(partner))


def item_flags(sub_itemized: DataFrame) -> DataFrame:
    """Per billed tenant: for each listed item a flag and a quantity (M5 over the sub-tenant bill)."""
    aggs = []
    for name, item, pp in MAILBOX_ITEMS:
        cond = billed(item, pp)
        aggs += [F.max(F.when(cond, F.lit(True)).otherwise(F.lit(False))).alias(name),
                 F.max(F.when(cond, F.col("quantity")).otherwise(F.lit(0))).cast("bigint").alias(f"{name}_of_Licenses")]
    return sub_itemized.groupBy("billing_date", "tenant_global_id").agg(*aggs)


def json_text(value: Column) -> Column:
    """A boolean, number or string as JSON; NULL stays NULL."""
    listed = F.to_json(F.array(value))
    return F.when(value.isNotNull(), F.substring(listed, F.lit(2), F.length(listed) - 2))


def json_object(entries: Sequence[tuple[str, Column]]) -> Column:
    """JSON object from an ordered entry list (M7): members with a value only, by key; of equal keys the first entry wins."""
    listed = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(i).alias("i"), v.alias("v")) for i, (k, v) in enumerate(entries)])
    ordered = F.array_sort(F.filter(listed, lambda e: e["v"].isNotNull()))
    # a one-element transform binds the sorted list to a name
    fold = lambda s: F.filter(s, lambda e, i: (i == 0) | (e["k"] != F.coalesce(F.get(s, i - 1)["k"], F.lit(""))))
    members = F.transform(F.transform(F.array(ordered), fold)[0], lambda e: F.concat(F.lit('"'), e["k"], F.lit('":'), e["v"]))
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


def billable_items() -> Column:
    """The billed add-ons of a tenant with quantities (over the columns of ``item_flags``; no bill: no members)."""
    entries = []
    for key, col, label in BILLABLE:
        on = F.col(col) == F.lit(True)
        entries += [(key, F.when(on, F.lit("true"))),
                    (f"{key}_QUANTITY", F.when(on, json_text(F.coalesce(F.col(f"{col}_of_Licenses"), F.lit(0)))))]
        if label:
            entries.append((f"{key}_{label[0]}", F.when(on, json_text(F.lit(label[1])))))
    return json_object(entries)


def active_add_ons() -> Column:
    """The add-ons that the snapshot shows, whether billed or not; unknown ones are left out."""
    return json_object([(key, json_text(F.col(c))) for key, c in ADD_ONS])


def mailbox_mart(peak: DataFrame, history: DataFrame, meta: DataFrame, sub_itemized: DataFrame, as_of) -> DataFrame:
    """Billable-mailbox mart of all regions (M6): peak rows, the snapshot at the peak day, meta and the
    per-tenant item pivot of the sub-tenant bill, with both add-on objects. The region is a column."""
    d = as_date(as_of)
    flags = item_flags(sub_itemized.filter(F.col("billing_date") == F.lit(d))).drop("billing_date")
    flags = flags.withColumn("_billed", billable_items())
    gh = history.select(F.col("record_date").alias("_gh_date"), F.col("tenant_global_id").alias("_gh_id"),
                        F.col("billing_status").alias("_gh_status"), F.col("approved").alias("_gh_approved"),
                        F.col("registration_date").alias("_gh_reg"), F.col("tree_key").alias("_gh_key"),
                        F.col("plan_expiry_date").alias("_gh_expiry"), F.col("trial_plan_expiry_date").alias("_gh_trial"),
                        F.col("not_nfr_partner").alias("_gh_not_nfr"))
    m = meta.select(F.col("tenant_global_id").alias("root"), "profile_type",
                    F.col("is_highwatermark").alias("high_water_mark"))
    # both objects before the join: pivot columns and snapshot flags differ in case only
    g = peak.filter(F.col("date_recorded") == F.lit(d)).withColumn("_shown", active_add_ons()).drop(*[c for _, c in ADD_ONS])
    # the snapshot is needed on the picked days only (a month at most), not its whole past
    gh = gh.join(g.select(F.col("hwm_date").alias("_gh_date")).distinct(), "_gh_date", "left_semi")
    gh = gh.filter(F.col("_gh_status").isin("Active", "Active-POC") & F.col("_gh_approved"))
    j = (g.join(gh, (g.hwm_date == gh._gh_date) & (g.tenant_global_id == gh._gh_id))
         .join(m, "root", "left").join(flags, "tenant_global_id", "left"))
    a, lic, sh = (F.coalesce(F.col(c), F.lit(0)) for c in ("active_profiles", "licensed_profiles", "shared_profiles"))
    pt = F.col("profile_type")
    billable = (F.when(pt == "active", a).when(pt == "license", lic)
                .when(pt == "shared", F.when(F.col("shared_profiles").isNull(), a)
                      .otherwise(F.coalesce(F.col("active_profiles") - F.col("shared_profiles"), F.lit(0)))))
    pivot_cols = [c for name, _, _ in MAILBOX_ITEMS for c in (name, f"{name}_of_Licenses")]
    return j.select(
        F.lit(d).alias("record_date"), F.regexp_extract("tenant_global_id", "[A-Za-z]+", 0).alias("region"),
        F.date_sub(F.col("date_recorded"), 1).alias("billing_date"),
        F.regexp_replace("tenant_global_id", "[^0-9]", "").alias("tenant_number"), "tenant_name",
        F.regexp_replace("parent_global_id", "[^0-9]", "").alias("parent_number"), "parent_name",
        lic.alias("licensed_profiles"), a.alias("active_profiles"), sh.alias("shared_profiles"),
        billable.alias("billable_profiles"), "plan_id", "plan_name", F.col("_gh_expiry").alias("plan_expiry_date"),
        F.col("_gh_trial").alias("trial_plan_expiry_date"), F.col("_gh_reg").alias("registration_date"),
        F.lit(None).cast("string").alias("parent_type"), F.coalesce("_billed", F.lit("{}")).alias("billable_items"),
        F.col("_shown").alias("active_add_ons"), "high_water_mark",
        F.when(F.col("_gh_not_nfr") == F.lit(True), F.lit(False)).otherwise(F.col("partner_pricing"))
        .alias("not_for_resale_flag"),
        F.col("_gh_key").alias("tree_key"), *pivot_cols)


def mailbox_api(mart: DataFrame) -> DataFrame:
    """What the API gives of the mart (M8): rows with a billable quantity, objects as JSON text, no pivot columns."""
    return mart.filter(F.col("billable_profiles").isNotNull()).select(
        "record_date", "region", "billing_date", "tenant_number", "tenant_name", "parent_number", "parent_name",
        "licensed_profiles", "active_profiles", "shared_profiles", "billable_profiles", "plan_id", "plan_expiry_date",
        "trial_plan_expiry_date", "registration_date", "parent_type", "billable_items", "active_add_ons",
        F.col("not_for_resale_flag").alias("is_partner"), "tree_key")
