"""The work of a multiplied or regrouped table is spread over tasks and moved no more often than needed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seatmeter.functions.joins import multiplied
from seatmeter.operators import bridge, pricing, subtenant
from seatmeter.plans import catalog
from seatmeter.sources import adapters as A
from seatmeter.sources.tables import Tables


def _meta(spark, n=400):
    """Meta of n roots in one partition, as a small file is read."""
    rows = [(A.AS_OF, f"US-{k}", f"T{k}") for k in range(n)]
    return spark.createDataFrame(rows, "snapshot_date date, tenant_global_id string, tenant_name string").coalesce(1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_price_list_is_made_by_many_tasks(spark):
    prices = A.price_list(_meta(spark))
    per_task = prices.groupBy(F.spark_partition_id().alias("p")).count().collect()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(per_task) == n
    assert max(r["count"] for r in per_task) < 2 * prices.count() / n
    # what follows keeps a root's rows where they are: no second shuffle of the multiplied rows
    assert _plan(pricing.resolve_prices(prices, A.AS_OF)).count("Exchange hashpartitioning") == 1


def test_price_list_tasks_grow_with_the_roots(spark):
    """More roots give more tasks, not larger ones, however few shuffle partitions the session has."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = (least + 2) * 2000
    meta = spark.range(n).select(F.lit(A.AS_OF).alias("snapshot_date"), F.concat(F.lit("US-"), F.col("id")).alias("tenant_global_id")).coalesce(1)
    listed = A.price_list(meta).filter((F.col("sku") == "PSCP") & (F.col("tier_min") == 1) & (F.col("snapshot_date") == F.lit(A.AS_OF)))
    per_task = [r["count"] for r in listed.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(per_task) == least + 2 and sum(per_task) == n
    assert max(per_task) < 1.2 * 2000


def test_price_list_rows_of_a_root(spark):
    rows = A.price_list(_meta(spark, 7)).filter("tenant_global_id in ('US-4', 'US-6')").collect()
    for root, promo in (("US-4", True), ("US-6", False)):
        got = [r for r in rows if r.tenant_global_id == root]
        days, tiers = 2, 3
        assert len(got) == len(set(got)) == days * tiers * (2 * 7 + 15 + (2 if promo else 0))
        assert {(r.sku, r.is_nfr) for r in got if r.price_type == "Promo Price"} == ({("Email Protect", False), ("Email Protect", True)} if promo else set())
        assert {r.sku for r in got if r.is_nfr} == set(A.PLAN_SKUS)
    assert {r.start_date for r in rows if r.price_type == "Promo Price"} == {dt.date(2024, 1, 15)}


def _broadcast_parts(plan):
    """The parts of a plan that are sent to all tasks."""
    lines = plan.splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    for i, x in enumerate(lines):
        if "BroadcastExchange" in x:
            below = next((k for k in range(i + 1, len(lines)) if depth[k] <= depth[i]), len(lines))
            yield "\n".join(lines[i:below])


def _seats(spark):
    """Three tenants of the roots US-4 and US-6 as the bill's operators read them."""
    cols = ("date_recorded date, root string, tenant_global_id string, plan_name string, premium_name string, profile_type string, active_profiles long, "
            "licensed_profiles long, shared_profiles long, partner_pricing boolean, dmarc_plan int, dmarc_domains_number int")
    rows = [(A.AS_OF, "US-4", "US-41", "Email Protect", "NINJIO", "active", 10, 15, None, False, 1, 3),
            (A.AS_OF, "US-4", "US-42", "Core", None, "active", 20, 25, 2, True, 2, 2),
            (A.AS_OF, "US-6", "US-61", "Starter", None, "active", 7, 9, None, False, None, None)]
    df = spark.createDataFrame(rows, cols)
    flags = ["incident_management", "simulation_and_training_bundle_plus", "ato"]
    others = ["themis_co_pilot", "ai_empower_bundle", "link_scanning", "file_scanning", "security_awareness_training", "simulation_and_training_bundle",
              "multi_tenancy", "not_nfr_partner"]
    return df.select("*", *[F.lit(True).alias(x) for x in (*flags, "approved", "dmarc_management")], *[F.lit(False).alias(x) for x in others],
                     F.lit("Active").alias("billing_status"), F.col("root").alias("master"), F.col("partner_pricing").alias("eff_partner"),
                     *[F.col(x).alias(y) for x, y in (("active_profiles", "sum_a"), ("licensed_profiles", "sum_l"), ("shared_profiles", "sum_s"))],
                     F.col("root").alias("first_layer_id"), *[F.lit("").alias(f"{n}_layer_id") for n in ("second", "third", "fourth", "fifth")])


def _price_joins(spark, path):
    """Every step that joins more than a few rows a root of the price list, made from meta in a small file: name -> result."""
    _meta(spark, 7).write.parquet(path)
    dated = spark.read.parquet(path).select("*", F.lit("msp").alias("ltp_type"), F.lit(A.AS_OF).alias("registration_date"),
                                            F.lit("AM").alias("account_master_id"))
    meta = dated.withColumn("profile_type", F.lit("active"))
    listed = A.price_list(meta).filter(F.col("snapshot_date") == F.lit(A.AS_OF))
    prices, rows = pricing.resolve_prices(listed, A.AS_OF), _seats(spark)
    unified = pricing.pool_map(meta, spark.createDataFrame([], "global_tenant_id string, master_tenant_id string"))
    bill = spark.createDataFrame([], "ltp string, item string, partner_pricing boolean, quantity long, amount double, price_type string")
    sub = spark.createDataFrame([(A.AS_OF, "US-4", "US-41", "Email Protect", "x", False, 5, 1.0)], "billing_date date, first_layer_id string, "
                                "tenant_global_id string, item string, sku string, partner_pricing boolean, quantity long, amount double")
    sub = sub.select("*", *[F.lit("").alias(f"{n}_layer_id") for n in ("second", "third", "fourth", "fifth")])
    picks = rows.select("tenant_global_id", "dmarc_domains_number")
    return {"plan_lines": pricing.plan_lines(rows, multiplied(prices)),
            "per_unit_lines": pricing.per_unit_lines(rows.drop("master"), unified, multiplied(prices)),
            "addon_menu": pricing.addon_menu(rows.drop("profile_type"), meta, prices),
            "flat_lines": subtenant.flat_lines(subtenant.base_rows(rows.drop("profile_type"), meta), listed, bill),
            "per_leaf": subtenant.per_leaf(rows, picks, listed, bill), "bill_fact": bridge.bill_fact(sub, dated, listed, A.AS_OF)}


PRICED = {   # item, quantity, amount of root US-4; its prices are 4 % above the base, partner seats are free, the promotion is 20 % off
    "plan_lines": {("Email Protect", 10, 20.8), ("Core", 20, 0.0)},
    "per_unit_lines": {("DMARC Core Management", 3, 15.6), ("DMARC Pro", 2, 18.72)},
    "addon_menu": {("NINJIO", 10, 6.24), ("Incident Management", 30, 24.96), ("S&T Plus Bundle", 10, 7.28), ("Account Takeover", 10, 9.36), ("DMARC Domains", 5, 26.0)},
    "flat_lines": {("Core", 20, 0.0), ("NINJIO", 10, 6.24), ("Incident Management", 10, 8.32), ("Incident Management", 20, 16.64),
                   ("S&T Bundle Plus", 10, 7.28), ("Account Takeover", 10, 9.36)},
    "per_leaf": {("DMARC Core Management", 3, 15.6), ("DMARC Pro", 2, 18.72)},
    "bill_fact": {("Email Protect", 5, 2.6)},
}


@pytest.mark.parametrize("step", sorted(PRICED))
def test_price_list_is_not_sent_to_all_tasks(spark, tmp_path, step):
    """Its many rows come from a file of few bytes, by which the planner took it for a small side."""
    out = _price_joins(spark, str(tmp_path / "meta"))[step]
    assert "Generate explode" in _plan(out)
    assert not [x for x in _broadcast_parts(_plan(out)) if "Generate explode" in x]
    cols = {"flat_lines": ("item", "billable_quantity", "amount"), "per_leaf": ("item", "billable_quantity", "amount"),
            "bill_fact": ("item", "billed_qty", "max_price")}.get(step, ("item", "quantity", "amount"))
    own = F.col("ltp" if "ltp" in out.columns else "first_layer_id") == "US-4"
    assert {(r[0], r[1], round(r[2], 4)) for r in out.filter(own).select(*cols).collect()} == PRICED[step]


@pytest.mark.parametrize("name", ["pool_allocate", "per_unit_addon", "addon_menu", "subtenant_flat"])
def test_queries_do_not_send_the_price_list(spark, sf_small, name):
    plan = _plan(catalog.QUERIES[name](spark, sf_small))
    assert "kind#" in plan                    # the list's own last explode
    assert not [x for x in _broadcast_parts(plan) if "kind#" in x]


def test_bridge_fact_moves_its_lines_once(spark):
    jan, feb = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    lines = [("C-1", jan, "P-1", "a", 5, "10.00", "msp", dt.date(2023, 3, 1)), ("C-1", jan, "P-1", "a", 7, "1.50", "oem", dt.date(2023, 2, 1)),
             ("C-1", feb, "P-2", "a", 2, "3.00", "msp", dt.date(2023, 4, 1)), ("C-2", jan, "P-1", None, None, None, None, None),
             ("C-3", feb, "P-2", "b", 4, "8.00", "msp", dt.date(2023, 5, 1)), ("C-3", feb, "P-2", "b", 4, "8.00", "msp", dt.date(2023, 5, 1)),
             (None, feb, "P-2", "b", 9, "1.00", "msp", dt.date(2023, 1, 1)), ("C-4", feb, None, "b", 9, "1.00", "msp", dt.date(2023, 1, 1))]
    df = spark.createDataFrame(lines, "global_tenant_id string, billing_date date, first_layer_id string, item string, quantity long, rev string, ltp_type string, order_date date")
    df = df.select("*", *[F.lit("").alias(f"{n}_layer_id") for n in ("second", "third", "fourth", "fifth")], F.lit("s").alias("sku"), F.lit(False).alias("is_nfr"),
                   F.col("rev").cast("decimal(18,4)").alias("revenue"), F.lit(1.0).alias("list_price"), F.lit("AM").alias("account_master_id"))
    out = bridge.fact(df)
    # the lines to their tenant, and the tenants' first orders there
    assert _plan(out).count("Exchange hashpartitioning") == 2
    got = {(r.global_tenant_id, r.billing_date, r.first_layer_id): (r.billed_qty, r.tenant_mrr and float(r.tenant_mrr), r.ltp_type, r.total_ltp_billed_qty, r.registration_date)
           for r in out.collect()}
    # rows without tenant or partner give none, but those without a tenant count for their partner
    assert got == {("C-1", jan, "P-1"): (12, 11.5, "oem", 12, dt.date(2023, 2, 1)), ("C-1", feb, "P-2"): (2, 3.0, "msp", 19, dt.date(2023, 2, 1)),
                   ("C-2", jan, "P-1"): (None, None, None, 12, None), ("C-3", feb, "P-2"): (8, 16.0, "msp", 19, dt.date(2023, 5, 1))}
    assert out.columns[:3] == ["global_tenant_id", "billing_date", "first_layer_id"] and out.columns[-1] == "registration_date"


def test_usage_lines_move_to_part_and_order_only(spark, sf_small):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(A.usage_keys(Tables(spark, sf_small)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    # lines by part and by order, parts, customers, orders by customer and by key
    assert plan.count("Exchange hashpartitioning") == 6
    assert "l_extendedprice" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
    assert sum("o_custkey" in x and "Exchange hashpartitioning" in x for x in plan.splitlines()) == 1
    tops = plan[:plan.index("SortMergeJoin") + 200]
    assert "l_orderkey" in tops                # the wide rows meet their order last
