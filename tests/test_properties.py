
import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E
from seatmeter.operators import pricing


def test_bridge_volume_plus_rate_is_net_change(spark, sf_small):
    b = E.queries()["mrr_bridge"](spark, sf_small)
    bad = b.filter(F.abs(F.col("volume_impact_mrr") + F.col("billing_rate_change_mrr") - F.col("net_mrr_change"))
                   > 0.0002)
    assert b.count() > 0 and bad.count() == 0


def test_bridge_buckets_are_known(spark, sf_small):
    b = E.queries()["mrr_bridge"](spark, sf_small)
    known = {"New", "Churn", "Change of Channel", "Upsell", "Downsell", "FX Impact", "No Change",
             "Billing Rate Change"}
    assert {r[0] for r in b.select("arr_bucket").distinct().collect()} <= known


def test_layers_recompose_the_path(spark, sf_small):
    rows = E.queries()["layer_columns"](spark, sf_small).collect()
    for r in rows:
        ids = [r[c] for c in ("first_layer_id", "second_layer_id", "third_layer_id", "fourth_layer_id",
                              "fifth_layer_id")]
        used = [x.split("-")[1] for x in ids if x]
        assert used == [p.lstrip("X") for p in r["tree_key"].split(" ") if p]
        assert all(x == "" for x in ids[len(used):])


def test_one_row_per_bill_grain(spark, sf_small):
    bill = E.queries()["itemized_bill"](spark, sf_small)
    grain = ["billing_date", "ltp", "item", "sku", "partner_pricing", "price_type"]
    assert bill.count() == bill.select(*grain).distinct().count()


def test_addon_lines_have_null_partner_flag(spark, sf_small):
    lines = E.queries()["bill_lines"](spark, sf_small)
    addons = lines.filter(~F.col("item").isin(*pricing.PLAN_SKUS))
    assert addons.filter(F.col("partner_pricing").isNotNull()).count() == 0


def test_promo_override(spark):
    d = dt.date(2024, 1, 30)
    rows = [
        # tenant, sku, nfr, tmin, tmax, price, start, end, type
        ("A", "X", False, 1, None, 2.0, dt.date(2020, 1, 1), dt.date(2099, 1, 1), "Standard Price"),
        ("A", "X", False, 1, None, 1.0, dt.date(2024, 1, 30), dt.date(2024, 2, 1), "Promo Price"),   # live today
        ("B", "X", False, 1, None, 3.0, dt.date(2020, 1, 1), dt.date(2099, 1, 1), "Standard Price"),
        ("B", "X", False, 1, None, 1.5, dt.date(2023, 1, 1), dt.date(2024, 1, 29), "Promo Price"),   # ended
    ]
    pl = spark.createDataFrame(rows, "tenant_global_id string, sku string, is_nfr boolean, tier_min int, "
                                     "tier_max int, price double, start_date date, end_date date, price_type string")
    out = {r["tenant_global_id"]: (r["price"], r["price_type"])
           for r in pricing.resolve_prices(pl, d, snapshot=False).collect()}
    assert out == {"A": (1.0, "Promo Price"), "B": (3.0, "Standard Price")}


def test_min_commit_tops_up_short_pools_and_idle_partners(spark):
    d = dt.date(2024, 1, 30)
    lines = spark.createDataFrame([(d, "P1", 40.0), (d, "P2", 10.0), (d, "P3", 500.0)],
                                  "date_recorded date, ltp string, amount double")
    unified = spark.createDataFrame([("P1", "P1"), ("P2", "P1"), ("P3", "P3"), ("P4", "P4")],
                                    "global_tenant_id string, master_tenant_id string")
    commits = spark.createDataFrame(
        [("P1", 100.0, dt.date(2024, 1, 1), dt.date(2024, 12, 31)),   # pool P1+P2 = 50 -> top-up 50
         ("P3", 100.0, dt.date(2024, 1, 1), dt.date(2024, 12, 31)),   # already above
         ("P4", 70.0, dt.date(2024, 1, 1), dt.date(2024, 12, 31))],   # no billing at all -> full 70
        "tenant_global_id string, monthly_commitment_amount double, start_date date, end_date date")
    out = {r["ltp"]: r["amount"] for r in pricing.min_commit_lines(lines, commits, unified, d).collect()}
    assert out == {"P1": 50.0, "P4": 70.0}


def test_pooled_threshold_uses_pool_total(spark):
    df = spark.createDataFrame([("m", "R", "a", 30), ("m", "R", "b", 30), ("m", "S", "c", 30)],
                               "k string, pool string, member string, q int")
    tiers = spark.createDataFrame([(1, 50, 2.0), (51, None, 1.0)], "tier_min int, tier_max int, price double")
    out = pricing.pooled_threshold(df, ["k"], "pool", "member", "q", tiers.withColumn("k", F.lit("m")), ["k"])
    got = {r["member"]: r["amount"] for r in out.collect()}
    assert got == {"a": 30.0, "b": 30.0, "c": 60.0}


def test_daily_job_is_idempotent(spark, sf_small):
    import tempfile
    from seatmeter.plans import daily_bill as B, daily_job
    d = B.Domain(spark, sf_small)
    out = tempfile.mkdtemp(prefix="seatmeter-day-")
    first = daily_job.run_day(d, out)

    def rows(p):
        import glob
        return spark.read.parquet(p).count() if glob.glob(f"{p}/*/*.parquet") else 0

    counts = {k: rows(p) for k, p in first.items()}
    daily_job.run_day(d, out)            # the same day again
    again = {k: rows(p) for k, p in first.items()}
    assert counts == again and counts["root_itemized"] > 0


def test_bill_bridge_volume_plus_rate_is_net_change(spark, sf_small):
    b = E.queries()["mrr_bridge_bill"](spark, sf_small)
    bad = b.filter(F.abs(F.col("volume_impact_mrr") + F.col("billing_rate_change_mrr") - F.col("net_mrr_change"))
                   > 0.0002)
    assert b.count() > 0 and bad.count() == 0
    assert b.filter(F.col("prior_dt") >= F.col("current_dt")).count() == 0
