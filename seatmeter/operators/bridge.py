"""Recurring-revenue bridge: prior vs current snapshot, buckets, price/volume split.

One pass pivots both snapshot dates (conditional sums, S3); lookups are joins
on the pivot grain or on small dimension tables (rates, currency, FX). The
channel-migration flag (S6) is computed as one aggregate over (tenant, item,
sku) instead of a self-join with ``<>``, so a tenant listed under many
partners cannot fan the join out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import bridge_anchors
from ..functions.joins import multiplied
from ..functions.money import money  # noqa: F401
from .sinks import materialize

GRAIN = ["global_tenant_id", "first_layer_id", "second_layer_id", "third_layer_id", "fourth_layer_id",
         "fifth_layer_id", "item", "sku", "is_nfr"]
META = ["global_tenant_id", "item", "sku", "is_nfr"]


def fact(lines: DataFrame) -> DataFrame:
    """Bridge fact (S1): per billing date and grain, quantity, MRR, partner total and metadata.

    ``lines`` has billing_date, the grain columns, quantity, revenue (DECIMAL),
    list_price, ltp_type, order_date, account_master_id.

    The lines move once, to their tenant, where they are grouped and get its registration date. The
    partner totals are summed from the lines and written first: by their size the planner knows whether
    the grouped rows must move to them.
    """
    g = lines.repartition("global_tenant_id").groupBy("billing_date", *GRAIN).agg(
        F.sum("quantity").alias("billed_qty"), F.sum("revenue").alias("tenant_mrr"),
        F.max("list_price").alias("max_price"), F.max("ltp_type").alias("ltp_type"),
        F.max("account_master_id").alias("account_master_id"))
    partner = materialize(lines.groupBy("billing_date", "first_layer_id").agg(F.sum("quantity").alias("total_ltp_billed_qty")),
                          "bridge-partners")
    reg = lines.groupBy(F.col("global_tenant_id")).agg(F.min("order_date").alias("registration_date"))
    out = g.join(reg, "global_tenant_id").join(partner, ["billing_date", "first_layer_id"])
    return out.select("global_tenant_id", "billing_date", "first_layer_id",
                      *[c for c in out.columns if c not in ("global_tenant_id", "billing_date", "first_layer_id", "registration_date")],
                      "registration_date")


def two_period_pivot(f: DataFrame, prior, current) -> DataFrame:
    """Prior/current conditional sums per grain, NULL-safe zero, x12 for ARR (S3)."""
    p, c = F.lit(prior), F.lit(current)
    d = F.col("billing_date")

    def pick(col: str, when: Column, scale: int = 1) -> Column:
        v = F.col(col) * F.lit(scale) if scale != 1 else F.col(col)
        return F.coalesce(F.sum(F.when(d == when, v).otherwise(F.lit(0))), F.lit(0))

    return f.filter(d.isin(p, c)).groupBy(*GRAIN).agg(
        pick("billed_qty", p).alias("billed_qty_prior"), pick("billed_qty", c).alias("billed_qty_current"),
        pick("tenant_mrr", p).alias("tenant_mrr_prior"), pick("tenant_mrr", c).alias("tenant_mrr_current"),
        pick("tenant_mrr", p, 12).alias("tenant_arr_prior"), pick("tenant_mrr", c, 12).alias("tenant_arr_current"),
        pick("total_ltp_billed_qty", p).alias("total_ltp_qty_prior"),
        pick("total_ltp_billed_qty", c).alias("total_ltp_qty_current"))


def snapshot_meta(f: DataFrame, day, suffix: str) -> DataFrame:
    return f.filter(F.col("billing_date") == F.lit(day)).groupBy(*META).agg(
        *[F.max(c).alias(f"{c}_{suffix}") for c in ("ltp_type", "registration_date", "account_master_id",
                                                     "max_price")])


def as_of_snapshot(df: DataFrame, date_col: str, day) -> DataFrame:
    """Rows of the latest snapshot on or before ``day`` (S4): a scalar subquery, evaluated once."""
    latest = df.filter(F.col(date_col) <= F.lit(day)).agg(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) == latest)


def channel_flags(f: DataFrame, prior, current) -> DataFrame:
    """(tenant, item, sku) billed under a different first layer on the two dates."""
    d = F.col("billing_date")
    lay = F.col("first_layer_id")
    g = f.filter(d.isin(F.lit(prior), F.lit(current))).groupBy("global_tenant_id", "item", "sku").agg(
        F.min(F.when(d == F.lit(prior), lay)).alias("p0"), F.max(F.when(d == F.lit(prior), lay)).alias("p1"),
        F.min(F.when(d == F.lit(current), lay)).alias("c0"), F.max(F.when(d == F.lit(current), lay)).alias("c1"))
    both = F.col("p0").isNotNull() & F.col("c0").isNotNull()
    same = (F.col("p0") == F.col("p1")) & (F.col("c0") == F.col("c1")) & (F.col("p0") == F.col("c0"))
    return g.filter(both & ~same).select("global_tenant_id", "item", "sku", F.lit(True).alias("channel_changed"))


def bucket() -> Column:
    """Bucket classifier (S9), first match wins; NULL quantities count as 0."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    qp, qc = z("billed_qty_prior"), z("billed_qty_current")
    tp, tc = z("tenant_qty_prior_total"), z("tenant_qty_curr_total")
    mp, mc = z("tenant_mrr_prior"), z("tenant_mrr_current")
    flat = (qc == qp) & (mc == mp)
    return (F.when((tp == 0) & (qc > 0), "New")
            .when((tc == 0) & (tp > 0), "Churn")
            .when((F.col("channel_changed") == F.lit(True)) & (((qp > 0) & (qc == 0)) | ((qp == 0) & (qc > 0))),
                  "Change of Channel")
            .when((tp > 0) & (qc > qp), "Upsell")
            .when((tp > 0) & (qc < qp), "Downsell")
            .when(flat & (F.col("billing_currency") != "USD"), "FX Impact")
            .when(flat, "No Change")
            .otherwise("Billing Rate Change"))


def mrr_bridge(f: DataFrame, rates: DataFrame, currency: DataFrame, fx: DataFrame, as_of) -> DataFrame:
    """The bridge.

    rates: snapshot_date, tenant_global_id, sku, price; currency: first_layer_id, currency;
    fx: isocode, conversionrate, startdate.
    """
    prior, current = bridge_anchors(as_of)
    piv = two_period_pivot(f, prior, current)
    mc, mp = snapshot_meta(f, current, "c"), snapshot_meta(f, prior, "p")
    totals = piv.groupBy("global_tenant_id").agg(F.sum("billed_qty_prior").alias("tenant_qty_prior_total"),
                                                 F.sum("billed_qty_current").alias("tenant_qty_curr_total"))
    er = as_of_snapshot(rates, "snapshot_date", current).groupBy(
        F.col("tenant_global_id").alias("first_layer_id"), F.col("sku").alias("item")).agg(
        F.min("price").alias("actual_effective_rate"))
    cur = currency.groupBy("first_layer_id").agg(F.max(F.upper(F.trim("currency"))).alias("currency"))
    fxp = as_of_snapshot(fx, "startdate", prior).select(F.col("isocode").alias("billing_currency"),
                                                        F.col("conversionrate").alias("prior_rate"))
    fxc = as_of_snapshot(fx, "startdate", current).select(F.col("isocode").alias("billing_currency"),
                                                          F.col("conversionrate").alias("current_rate"))
    flags = channel_flags(f, prior, current)

    def nsafe(left: DataFrame, right: DataFrame) -> DataFrame:
        r = right.withColumnRenamed("global_tenant_id", "_t").withColumnRenamed("item", "_i") \
            .withColumnRenamed("sku", "_s").withColumnRenamed("is_nfr", "_n")
        cond = ((left["global_tenant_id"] == r["_t"]) & (left["item"] == r["_i"])
                & left["sku"].eqNullSafe(r["_s"]) & left["is_nfr"].eqNullSafe(r["_n"]))
        return left.join(r, cond, "left").drop("_t", "_i", "_s", "_n")

    e = nsafe(nsafe(piv, mc), mp)
    e = (e.join(totals, "global_tenant_id", "left")
         .join(er, ["first_layer_id", "item"], "left")
         .join(cur, "first_layer_id", "left")
         .withColumn("billing_currency", F.coalesce(F.col("currency"), F.lit("USD"))).drop("currency")
         .join(fxp, "billing_currency", "left")
         .join(fxc, "billing_currency", "left")
         .join(flags, ["global_tenant_id", "item", "sku"], "left"))
    dbl = lambda c: F.col(c).cast("double")
    e = e.select(
        *GRAIN,
        *[F.coalesce(F.col(f"{c}_c"), F.col(f"{c}_p")).alias(c)
          for c in ("ltp_type", "registration_date", "account_master_id", "max_price")],
        "billed_qty_prior", "billed_qty_current", "tenant_qty_prior_total", "tenant_qty_curr_total",
        *[dbl(c).alias(c) for c in ("tenant_mrr_prior", "tenant_mrr_current", "tenant_arr_prior",
                                    "tenant_arr_current")],
        "total_ltp_qty_prior", "total_ltp_qty_current",
        dbl("actual_effective_rate").alias("actual_effective_rate"), "billing_currency",
        F.coalesce(dbl("prior_rate"), F.lit(1.0)).alias("prior_fx_rate"),
        F.coalesce(dbl("current_rate"), F.lit(1.0)).alias("current_fx_rate"),
        F.coalesce(F.col("channel_changed"), F.lit(False)).alias("channel_changed"),
    )
    c = F.col
    e = e.select(
        "*",
        (c("billed_qty_current") - c("billed_qty_prior")).alias("net_qty_change"),
        (c("tenant_mrr_current") - c("tenant_mrr_prior")).alias("net_mrr_change"),
        (c("tenant_arr_current") - c("tenant_arr_prior")).alias("net_arr_change"),
        (c("tenant_mrr_prior") * c("prior_fx_rate")).alias("tenant_mrr_usd_prior"),
        (c("tenant_mrr_current") * c("current_fx_rate")).alias("tenant_mrr_usd_current"),
        (c("tenant_arr_prior") * c("prior_fx_rate")).alias("tenant_arr_usd_prior"),
        (c("tenant_arr_current") * c("current_fx_rate")).alias("tenant_arr_usd_current"),
        ((c("tenant_mrr_prior") * c("current_fx_rate") - c("tenant_mrr_prior") * c("prior_fx_rate")) * 12)
        .alias("fx_impact_arr_usd"),
        F.when(c("billed_qty_current") != 0, c("tenant_mrr_current") / c("billed_qty_current"))
        .when(c("billed_qty_prior") != 0, c("tenant_mrr_prior") / c("billed_qty_prior")).alias("implied_effective_rate"),
    )
    e = e.withColumn("arr_bucket", bucket())
    rate = F.coalesce(F.when(c("actual_effective_rate") != 0, c("actual_effective_rate")),
                      c("implied_effective_rate"), F.lit(0.0))
    b = c("arr_bucket")
    vol = (F.when(b.isin("No Change", "FX Impact"), F.lit(0.0))
           .when(b == "New", c("billed_qty_current") * rate)
           .when(b == "Churn", -c("billed_qty_prior") * rate)
           .when(b.isin("Upsell", "Downsell", "Change of Channel"), (c("billed_qty_current") - c("billed_qty_prior")) * rate)
           .otherwise(F.lit(0.0)))
    e = e.withColumn("effective_rate", rate).withColumn("volume_impact_mrr", vol)
    e = e.select(
        "*",
        (c("volume_impact_mrr") * 12).alias("volume_impact_arr"),
        (c("net_mrr_change") - c("volume_impact_mrr")).alias("billing_rate_change_mrr"),
        ((c("net_mrr_change") - c("volume_impact_mrr")) * 12).alias("billing_rate_change_arr"),
        (c("volume_impact_mrr") * c("prior_fx_rate")).alias("volume_impact_mrr_usd"),
        (c("volume_impact_mrr") * 12 * c("prior_fx_rate")).alias("volume_impact_arr_usd"),
        ((c("net_mrr_change") - c("volume_impact_mrr")) * c("current_fx_rate")).alias("billing_rate_change_mrr_usd"),
        ((c("net_mrr_change") - c("volume_impact_mrr")) * 12 * c("current_fx_rate")).alias("billing_rate_change_arr_usd"),
        (c("tenant_mrr_usd_current") - c("tenant_mrr_usd_prior")).alias("net_mrr_change_usd"),
        (c("tenant_arr_usd_current") - c("tenant_arr_usd_prior")).alias("net_arr_change_usd"),
    )
    e = e.filter(~((c("billed_qty_prior") == 0) & (c("billed_qty_current") == 0)
                   & (c("tenant_mrr_prior") == 0) & (c("tenant_mrr_current") == 0)))
    money_cols = [n for n, t in e.dtypes if t == "double"]
    return e.select(F.lit(current).alias("snapshot_date"), F.lit(prior).alias("prior_dt"),
                    F.lit(current).alias("current_dt"),
                    *[money(n).alias(n) if n in money_cols else F.col(n) for n in e.columns])


def bill_fact(sub_itemized: DataFrame, meta: DataFrame, price_list: DataFrame, day) -> DataFrame:
    """Bridge fact from one day's sub-tenant bill.

    The bill is joined to the deduplicated meta, the max price per (partner,
    sku, flag) and the partner roll-up of the day. The roll-up and price joins
    use plain equality on the partner flag, so add-on rows (flag NULL) get NULL
    totals and prices, as in the reference.
    """
    b = sub_itemized.filter(F.col("billing_date") == F.lit(day))
    m = meta.groupBy(F.col("snapshot_date").alias("billing_date"), F.col("tenant_global_id").alias("first_layer_id")) \
        .agg(F.max("ltp_type").alias("ltp_type"), F.max("registration_date").alias("registration_date"),
             F.max("account_master_id").alias("account_master_id"))
    p = price_list.groupBy(F.col("snapshot_date").alias("_pd"), F.col("tenant_global_id").alias("_pt"),
                           F.col("sku").alias("_ps"), F.col("is_nfr").alias("_pn")) \
        .agg(F.max("price").alias("max_price"))
    bs = b.groupBy(F.col("billing_date").alias("_bd"), F.col("first_layer_id").alias("_bl"),
                   F.col("item").alias("_bi"), F.col("sku").alias("_bs"), F.col("partner_pricing").alias("_bp")) \
        .agg(F.sum("quantity").alias("total_ltp_billed_qty"),
             F.sum(F.col("amount").cast("decimal(18,4)")).cast("double").alias("ltp_sku_mrr"))
    j = (b.join(m, ["billing_date", "first_layer_id"], "left")
         .join(multiplied(p), (F.col("billing_date") == F.col("_pd")) & (F.col("first_layer_id") == F.col("_pt"))
               & (F.col("item") == F.col("_ps")) & (F.col("partner_pricing") == F.col("_pn")), "left")
         .join(bs, (F.col("billing_date") == F.col("_bd")) & (F.col("first_layer_id") == F.col("_bl"))
               & (F.col("item") == F.col("_bi")) & (F.col("sku") == F.col("_bs"))
               & (F.col("partner_pricing") == F.col("_bp")), "left"))
    lay = ["second_layer_id", "third_layer_id", "fourth_layer_id", "fifth_layer_id"]
    return j.select(
        "billing_date", "first_layer_id", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in lay],
        F.col("tenant_global_id").alias("global_tenant_id"), "item", "sku", F.col("partner_pricing").alias("is_nfr"),
        "ltp_type", "registration_date", "account_master_id", F.col("max_price").cast("double").alias("max_price"),
        F.col("quantity").alias("billed_qty"), "total_ltp_billed_qty", F.col("amount").alias("tenant_mrr"),
        "ltp_sku_mrr")
