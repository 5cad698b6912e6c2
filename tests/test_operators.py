"""Hand-computed cases for the core operators (tier edges, ties, windows, paths, buckets)."""

import datetime as dt

from pyspark.sql import functions as F

from seatmeter.functions.dates import billing_window, bridge_anchors
from seatmeter.functions import paths
from seatmeter.functions.tiers import graduated_piece
from seatmeter.operators import pricing, select


def _tiers(spark):
    return spark.createDataFrame([(1, 10, 2.0), (11, 50, 1.5), (51, None, 1.0)],
                                 "tier_min int, tier_max int, price double")


def test_graduated_edges(spark):
    q = spark.createDataFrame([(k, v) for k, v in enumerate([0, 10, 11, 50, 51, 100])], "k int, quantity int")
    out = pricing.graduated(q, _tiers(spark), F.lit(True), ["k", "quantity"])
    got = {r["quantity"]: float(r["amount"]) for r in out.collect()}
    assert got == {0: 0.0, 10: 20.0, 11: 21.5, 50: 80.0, 51: 81.0, 100: 130.0}


def test_graduated_null_quantity_stays_null(spark):
    df = spark.createDataFrame([(None, 1, 10, 2.0)], "q int, lo int, hi int, p double")
    assert df.select(graduated_piece("q", "lo", "hi", "p").alias("a")).first()["a"] is None


def test_volume_prices_whole_quantity_at_reached_tier(spark):
    q = spark.createDataFrame([(1, 10), (2, 11), (3, 60)], "k int, quantity int")
    out = pricing.volume(q, _tiers(spark), F.lit(True), ["k", "quantity"])
    got = {r["quantity"]: float(r["amount"]) for r in out.collect()}
    assert got == {10: 20.0, 11: 16.5, 60: 60.0}


def test_single_tier_waterfall_equals_volume(spark):
    one = spark.createDataFrame([(1, None, 3.0)], "tier_min int, tier_max int, price double")
    q = spark.createDataFrame([(1, 7), (2, 40)], "k int, quantity int")
    g = {r["k"]: float(r["amount"]) for r in pricing.graduated(q, one, F.lit(True), ["k"]).collect()}
    v = {r["k"]: float(r["amount"]) for r in pricing.volume(q, one, F.lit(True), ["k", "quantity"]).collect()}
    assert g == v == {1: 21.0, 2: 120.0}


def test_allocation_sums_to_pool_amount(spark):
    parts = spark.createDataFrame([("p", "a", 1), ("p", "b", 3), ("z", "c", 0)], "pool string, m string, q int")
    amounts = spark.createDataFrame([("p", 100.0), ("z", 50.0)], "pool string, pool_amount double")
    out = pricing.allocate(parts, ["pool"], "q", amounts).collect()
    by = {r["m"]: r["amount"] for r in out}
    assert by == {"a": 25.0, "b": 75.0, "c": 0.0}


def test_peak_picks_earliest_day_on_ties(spark):
    df = spark.createDataFrame([("t", dt.date(2024, 1, 5), 9), ("t", dt.date(2024, 1, 3), 9),
                                ("t", dt.date(2024, 1, 4), 2)], "k string, d date, m int")
    assert select.peak(df, ["k"], "m", "d").first()["d"] == dt.date(2024, 1, 3)


def test_billing_window_day_one_settles_previous_month():
    assert billing_window(dt.date(2024, 3, 1)) == (dt.date(2024, 2, 2), dt.date(2024, 3, 1))
    assert billing_window(dt.date(2024, 3, 17)) == (dt.date(2024, 3, 2), dt.date(2024, 3, 17))
    assert bridge_anchors(dt.date(2024, 3, 1)) == (dt.date(2024, 2, 1), dt.date(2024, 3, 1))


def test_path_decode_and_layers(spark):
    df = spark.createDataFrame([("XXXXXX1 XXXXX12 XXXX123 ", "US")], "tree_key string, p string")
    r = df.select(paths.root_id("tree_key", "p").alias("root"), paths.depth("tree_key").alias("depth"),
                  paths.parent_id("tree_key", "p").alias("parent"), paths.self_id("tree_key", "p").alias("me"),
                  paths.layer("tree_key", "p", 3).alias("l3"), paths.layer("tree_key", "p", 5).alias("l5")).first()
    assert (r["root"], r["depth"], r["parent"], r["me"], r["l3"], r["l5"]) == ("US-1", 2, "US-12", "US-123",
                                                                                "US-123", "")


def test_path_piece_keeps_last_seven_digits(spark):
    r = spark.range(1).select(paths.path_piece(F.lit(12345678)).alias("k")).first()
    assert r["k"] == "2345678 "


def test_bucket_null_quantities_do_not_fall_to_rate_change(spark):
    from seatmeter.operators.bridge import bucket
    rows = [(None, 5, 0, 5, 0.0, 10.0, False, "USD"), (5, None, 5, 0, 10.0, 0.0, False, "USD"),
            (5, 8, 5, 8, 10.0, 16.0, False, "USD"), (5, 5, 5, 5, 10.0, 10.0, False, "EUR")]
    df = spark.createDataFrame(rows, "billed_qty_prior int, billed_qty_current int, tenant_qty_prior_total int, "
                                     "tenant_qty_curr_total int, tenant_mrr_prior double, tenant_mrr_current double, "
                                     "channel_changed boolean, billing_currency string")
    assert [r[0] for r in df.select(bucket()).collect()] == ["New", "Churn", "Upsell", "FX Impact"]


def test_tree_closure_stops_on_cycles_and_builds_paths(spark):
    from seatmeter.operators import tree
    # company 1 is a root, 2 hangs under 1 (brand 20), 3 under 2 (brand 30); a duplicate row of company 1
    # under brand 40 (owned by 2) would loop 1 -> 2 -> 1 -> ... without the guard
    company = spark.createDataFrame([(1, None, "A", "US"), (2, 20, "B", "US"), (3, 30, "C", "US"), (1, 40, "A", "US")],
                                    "id bigint, brand_id bigint, name string, region string")
    brand = spark.createDataFrame([(20, 1, "b20"), (30, 2, "b30"), (40, 2, "b40")],
                                  "id bigint, owner_id bigint, name string")
    out = tree.decode(tree.closure(company, brand))
    got = sorted((r["tenant_global_id"], r["depth"], r["tree_key"]) for r in out.collect())
    assert got == [("US-1", 0, "XXXXXX1 "), ("US-2", 1, "XXXXXX1 XXXXXX2 "),
                   ("US-3", 2, "XXXXXX1 XXXXXX2 XXXXXX3 ")]


def _chain(spark, ids):
    company = spark.createDataFrame([(i, None if k == 0 else i, f"t{i}", "US") for k, i in enumerate(ids)],
                                    "id bigint, brand_id bigint, name string, region string")
    brand = spark.createDataFrame([(i, p, f"b{i}") for p, i in zip(ids, ids[1:])], "id bigint, owner_id bigint, name string")
    return company, brand


def test_tree_keeps_long_ids_apart(spark):
    from seatmeter.operators import tree
    # equal last seven digits under one root, and an id that ends with its parent's digits
    company = spark.createDataFrame([(1, None, "A", "US"), (20000001, 2, "B", "US"), (30000001, 3, "C", "US"),
                                     (1111111, 4, "D", "US"), (11111111, 5, "E", "US"), (7, 6, "F", "US")],
                                    "id bigint, brand_id bigint, name string, region string")
    brand = spark.createDataFrame([(2, 1, "b"), (3, 1, "b"), (4, 1, "b"), (5, 1111111, "b"), (6, 11111111, "b")],
                                  "id bigint, owner_id bigint, name string")
    out = {r["tenant_id"]: r for r in tree.with_layers(tree.decode(tree.closure(company, brand))).collect()}
    assert len(out) == 6 and len({r["tenant_global_id"] for r in out.values()}) == 6
    assert (out[7]["depth"], out[7]["parent_global_id"], out[7]["root"]) == (3, "US-11111111", "US-1")
    assert out[20000001]["second_layer_id"] == "US-20000001"


def test_tree_of_any_depth(spark):
    from seatmeter.operators import tree
    ids = list(range(1, 122))                # deeper than any fixed bound of a hundred
    out = tree.decode(tree.closure(*_chain(spark, ids)))
    got = {r["tenant_id"]: (r["depth"], r["tenant_global_id"]) for r in out.collect()}
    assert got == {i: (k, f"US-{i}") for k, i in enumerate(ids)}
    six = tree.with_layers(tree.decode(tree.closure(*_chain(spark, ids[:6])))).filter("depth = 5").first()
    assert six["fifth_layer_id"] == "US-5" and six["tenant_global_id"] == "US-6"


def test_tree_without_roots(spark):
    from seatmeter.operators import tree
    company, brand = _chain(spark, [1, 2])
    assert tree.closure(company.filter("id > 1"), brand).count() == 0
