"""Tier operators against a brute-force Python computation on random schedules (one Spark job)."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from seatmeter.operators import pricing


def _schedule(rng):
    cuts = sorted(rng.sample(range(2, 400), rng.randint(0, 4)))
    lows = [1] + cuts
    highs = [c - 1 for c in cuts] + [None if rng.random() < 0.7 else rng.randint(lows[-1], 600)]
    return [(lo, hi, round(rng.uniform(0.1, 9.9), 4)) for lo, hi in zip(lows, highs)]


def _brute_graduated(q, tiers):
    total = Decimal(0)
    for lo, hi, price in tiers:
        top = q if hi is None else min(q, hi)
        total += max(0, top - (lo - 1)) * Decimal(str(price))
    return total


def _brute_volume(q, tiers):
    for lo, hi, price in tiers:
        if q >= lo and (hi is None or q <= hi):
            return q * Decimal(str(price))
    return None


def test_random_schedules_match_brute_force(spark):
    rng = random.Random(7)
    cases, tier_rows = [], []
    for k in range(300):
        tiers = _schedule(rng)
        q = rng.randint(0, 700)
        cases.append((k, q, tiers))
        tier_rows += [(k, lo, hi, p) for lo, hi, p in tiers]
    qdf = spark.createDataFrame([(k, q) for k, q, _ in cases], "k int, quantity int")
    tdf = spark.createDataFrame(tier_rows, "k int, tier_min int, tier_max int, price double")
    grad = {r["k"]: r["amount"] for r in pricing.graduated(qdf, tdf, "k", ["k"]).collect()}
    vol = {r["k"]: r["amount"] for r in pricing.volume(qdf, tdf, "k", ["k"]).collect()}
    for k, q, tiers in cases:
        assert grad[k] == _brute_graduated(q, tiers), (k, q, tiers)
        want = _brute_volume(q, tiers)
        assert vol.get(k) == want, (k, q, tiers)


def test_graduated_is_monotone_in_quantity(spark):
    tiers = spark.createDataFrame([(1, 10, 5.0), (11, 100, 3.0), (101, None, 1.0)],
                                  "tier_min int, tier_max int, price double")
    q = spark.range(0, 300).select(F.col("id").cast("int").alias("quantity"))
    out = pricing.graduated(q, tiers, F.lit(True), ["quantity"]).orderBy("quantity").collect()
    amounts = [r["amount"] for r in out]
    assert all(a <= b for a, b in zip(amounts, amounts[1:]))
