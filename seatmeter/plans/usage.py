"""Usage-metered pricing on the lineitem world (P9, P24-P27, M5) and its oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import marts, pricing
from ..operators.sinks import materialize
from ..sources import adapters as A
from ..sources.tables import Tables, state_of
from . import oracle_bridge as OB
from .oracle_base import register, with_ctes

register("usage", (), """
    SELECT CAST(date_trunc('month', l.l_shipdate) AS DATE) AS billing_date,
           'N-' || CAST(c.c_nationkey AS VARCHAR) AS ltp,
           'N-' || CAST(CASE WHEN o.o_orderpriority = '5-LOW' THEN (c.c_nationkey + 1) % 25 ELSE c.c_nationkey END
                        AS VARCHAR) AS channel_ltp,
           'R-' || CAST(n.n_regionkey AS VARCHAR) AS pool, n.n_regionkey AS region_key,
           'C-' || CAST(o.o_custkey AS VARCHAR) AS tenant, p.p_brand AS item, p.p_type AS sku,
           o.o_orderpriority = '1-URGENT' AS is_nfr, CAST(l.l_quantity AS BIGINT) AS quantity,
           CAST(ROUND(CAST(l.l_extendedprice * (1.0::DOUBLE - l.l_discount) AS DECIMAL(38,10)), 4) AS DECIMAL(18,4))
             AS revenue,
           p.p_retailprice AS list_price,
           CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'disti' WHEN c.c_mktsegment = 'MACHINERY' THEN 'oem'
                ELSE 'msp' END AS ltp_type,
           CAST(o.o_orderdate AS DATE) AS order_date
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN part p ON l.l_partkey = p.p_partkey JOIN nation n ON c.c_nationkey = n.n_nationkey""")
_TIERS = ", ".join(f"({a}, {'NULL' if b is None else b}, {m}::DOUBLE)" for a, b, m in A.ITEM_TIERS)
register("item_tiers", (), f"""
    SELECT b.item, CAST(t.tier_min AS INTEGER) AS tier_min, CAST(t.tier_max AS INTEGER) AS tier_max,
           CAST(ROUND(CAST(b.rp / 100.0::DOUBLE * t.mult AS DECIMAL(38,10)), 4) AS DECIMAL(18,4)) AS price
    FROM (SELECT p_brand AS item, min(p_retailprice) AS rp FROM part GROUP BY 1) b
    CROSS JOIN (VALUES {_TIERS}) t(tier_min, tier_max, mult)""")
register("monthly", ("usage",), """
    SELECT billing_date, ltp, pool, item, sum(quantity) AS quantity FROM usage GROUP BY ALL""")


def _piece(q, lo, hi, price):
    return (f"CAST(greatest(0, CASE WHEN {hi} IS NULL THEN {q} ELSE least({q}, {hi}) END - ({lo} - 1)) "
            f"AS DECIMAL(20,0)) * CAST({price} AS DECIMAL(18,4))")


SQL = {
    "tier_graduated": with_ctes(["monthly", "item_tiers"], f"""
        SELECT m.billing_date, m.ltp, m.item, CAST(m.quantity AS BIGINT) AS quantity,
               CAST(sum({_piece('m.quantity', 't.tier_min', 't.tier_max', 't.price')}) AS DOUBLE) AS amount
        FROM monthly m JOIN item_tiers t ON m.item = t.item GROUP BY m.billing_date, m.ltp, m.item, m.quantity"""),
    "tier_volume": with_ctes(["monthly", "item_tiers"], """
        SELECT m.billing_date, m.ltp, m.item, CAST(m.quantity AS BIGINT) AS quantity,
               CAST(CAST(m.quantity AS DECIMAL(20,0)) * t.price AS DOUBLE) AS amount
        FROM monthly m JOIN item_tiers t ON m.item = t.item
        WHERE m.quantity >= t.tier_min AND (t.tier_max IS NULL OR m.quantity <= t.tier_max)"""),
    "pooled_threshold": with_ctes(["monthly", "item_tiers"], """
        WITH mb AS (SELECT billing_date, item, pool, ltp, sum(quantity) AS member_qty FROM monthly GROUP BY ALL),
             pl AS (SELECT billing_date, item, pool, sum(member_qty) AS pool_qty FROM mb GROUP BY ALL)
        SELECT mb.billing_date, mb.item, mb.pool, mb.ltp, CAST(mb.member_qty AS BIGINT) AS member_qty,
               CAST(pl.pool_qty AS BIGINT) AS pool_qty, t.tier_min,
               CAST(CAST(mb.member_qty AS DECIMAL(20,0)) * t.price AS DOUBLE) AS amount
        FROM mb JOIN pl ON mb.billing_date = pl.billing_date AND mb.item = pl.item AND mb.pool = pl.pool
        JOIN item_tiers t ON mb.item = t.item
        WHERE pl.pool_qty >= t.tier_min AND (t.tier_max IS NULL OR pl.pool_qty <= t.tier_max)"""),
    "min_quantity": with_ctes(["monthly", "item_tiers"], f"""
        SELECT m.billing_date, m.ltp, m.item, CAST(m.quantity AS BIGINT) AS quantity,
               CAST(CAST(greatest(m.quantity, {A.MIN_BILLED_QTY}) AS DECIMAL(20,0)) * t.price AS DOUBLE) AS amount
        FROM monthly m JOIN item_tiers t ON m.item = t.item AND t.tier_min = 1"""),
    "item_pivot": with_ctes(["monthly"], "SELECT billing_date, ltp, " + ", ".join(
        f"CAST(max(CASE WHEN item = '{v}' THEN quantity END) AS BIGINT) AS brand_{v.split('#')[1]}"
        for v in A.ITEMS) + " FROM monthly GROUP BY billing_date, ltp"),
}

# The wide table is stated here by plan; a breakpoint's price holds for the units above it.
register("wide_tiers", ("meta_all",), f"""
    WITH plans(stem, plan_name, base) AS (VALUES {", ".join(f"('{k}', '{p}', {b}::DOUBLE)" for k, (p, b) in A.WIDE_PLANS.items())}),
    steps(step, tier_min, tier_max) AS (VALUES (0, 1, 100), (1, 101, 350), (2, 351, 750), (3, 751, NULL)),
    payers AS (
      SELECT tenant_global_id, profile_type, CAST(string_split(tenant_global_id, '-')[2] AS BIGINT) AS n FROM meta_all
      WHERE snapshot_date = DATE '{A.AS_OF.isoformat()}')
    SELECT tenant_global_id, profile_type, plan_name, false AS is_nfr, CAST(tier_min AS INTEGER) AS tier_min, CAST(tier_max AS INTEGER) AS tier_max,
           CAST(ROUND(CAST(base * (1 - 0.05::DOUBLE * step) + n % 50 / 100.0::DOUBLE AS DECIMAL(38,10)), 4) AS DECIMAL(18,4)) AS price
    FROM payers, plans, steps WHERE stem <> 'SAT_SUITE' OR n % 7 <> 0
    UNION ALL
    SELECT tenant_global_id, profile_type, plan_name, true, 1, NULL::INTEGER, CAST(ROUND(CAST(base / 2 AS DECIMAL(38,10)), 4) AS DECIMAL(18,4))
    FROM payers, plans""")
SQL["tier_wide_unpivot"] = with_ctes(["wide_tiers"], "SELECT * FROM wide_tiers")
SQL["wide_graduated"] = with_ctes(["wide_tiers", "hwm_rows"], f"""
    WITH kinds AS (SELECT DISTINCT tenant_global_id, profile_type FROM wide_tiers),
    seats AS (
      SELECT root AS tenant_global_id, plan_name, partner_pricing AS is_nfr,
             CASE profile_type WHEN 'active' THEN sum(active_profiles) WHEN 'license' THEN sum(licensed_profiles)
                  ELSE coalesce(sum(active_profiles) - sum(shared_profiles), sum(active_profiles)) END AS quantity
      FROM hwm_rows h JOIN kinds k ON h.root = k.tenant_global_id
      WHERE approved AND billing_status IN ('Active', 'Active-POC') GROUP BY root, plan_name, partner_pricing, profile_type)
    SELECT tenant_global_id, plan_name, is_nfr, CAST(quantity AS BIGINT) AS quantity,
           CAST(sum({_piece('quantity', 'tier_min', 'tier_max', 'price')}) AS DOUBLE) AS amount
    FROM seats JOIN wide_tiers USING (tenant_global_id, plan_name, is_nfr) GROUP BY ALL""")
_CACHE: dict = {}


FACT_KEYS = ["billing_date", "c_nationkey", "channel_nationkey", "region_key", "o_custkey", "item", "sku", "is_nfr",
             "ltp_type"]


def usage(spark, sf_dir):
    """The monthly usage fact, written once per (session, folder) like a stored fact table.

    Lines are aggregated to (month, partner, channel, tenant, item, sku, flag)
    after one shuffle; every consumer rolls up from this grain exactly (sums of
    sums, min of mins, max of maxes). Few lines share a key, so the fact is about
    as long as the lines, but narrower.
    """
    key = ("usage-fact", *state_of(spark, sf_dir))
    if key not in _CACHE:
        lines = A.usage_keys(Tables(spark, sf_dir))
        unit = F.round((F.col("revenue").cast("double") / F.col("quantity")).cast("decimal(38,10)"), 4) \
            .cast("decimal(18,4)")
        # grouped on numeric keys (small shuffle records); string ids are derived after the shuffle
        # and moved as they are: sums of decimals are wider than the lines, and few lines would meet before
        fact = lines.repartition(*FACT_KEYS).groupBy(*FACT_KEYS).agg(
            F.sum("quantity").alias("quantity"), F.sum("revenue").alias("revenue"),
            F.max("list_price").alias("list_price"), F.min("order_date").alias("order_date"),
            F.min(unit).alias("unit_price"))
        _CACHE[key] = materialize(A.with_ids(fact), "usage-fact")
    return _CACHE[key]


def monthly(spark, sf_dir):
    """Quantities by month, partner, pool and item, straight from the lines (a few rows a partner and month)."""
    lines = A.usage_keys(Tables(spark, sf_dir))
    g = lines.groupBy("billing_date", "c_nationkey", "region_key", "item").agg(F.sum("quantity").alias("quantity"))
    return g.select("billing_date", F.concat(F.lit("N-"), F.col("c_nationkey").cast("string")).alias("ltp"),
                    F.concat(F.lit("R-"), F.col("region_key").cast("string")).alias("pool"), "item", "quantity")


def tiers(spark, sf_dir):
    return A.item_tiers(Tables(spark, sf_dir))


def tier_graduated(spark, sf):
    out = pricing.graduated(monthly(spark, sf), tiers(spark, sf), "item",
                            ["billing_date", "ltp", "item", "quantity"])
    return out.select("billing_date", "ltp", "item", F.col("quantity").cast("bigint"),
                      F.col("amount").cast("double"))


def _wide(spark, sf):
    from .catalog import domain
    d = domain(spark, sf)
    return d, pricing.unpivot_wide(A.wide_prices(d.meta_all, d.as_of), ["tenant_global_id", "profile_type"],
                                   {stem: plan for stem, (plan, _) in A.WIDE_PLANS.items()})


def tier_wide_unpivot(spark, sf):
    """The wide legacy price table as tier rows."""
    return _wide(spark, sf)[1]


def wide_graduated(spark, sf):
    """Plan seats of every partner priced by the wide table (P24, P9): seats by plan and partner flag, graduated."""
    from . import daily_bill as B
    d, tiers = _wide(spark, sf)
    rows = B.peak_rows(d).filter(F.col("approved") & F.col("billing_status").isin("Active", "Active-POC"))
    kind = tiers.select(F.col("tenant_global_id").alias("root"), "profile_type").distinct()
    seats = rows.join(kind, "root").groupBy("root", "plan_name", "partner_pricing", "profile_type").agg(
        F.sum("active_profiles").alias("a"), F.sum("licensed_profiles").alias("l"), F.sum("shared_profiles").alias("s"))
    seats = seats.select(F.col("root").alias("tenant_global_id"), "plan_name", F.col("partner_pricing").alias("is_nfr"),
                         pricing.seat_quantity(F.col("profile_type"), F.col("a"), F.col("l"), F.col("s")).cast("bigint").alias("quantity"))
    keys = ["tenant_global_id", "plan_name", "is_nfr"]
    out = pricing.graduated(seats, tiers.drop("profile_type"), keys, [*keys, "quantity"])
    return out.withColumn("amount", F.col("amount").cast("double"))


def tier_volume(spark, sf):
    out = pricing.volume(monthly(spark, sf), tiers(spark, sf), "item",
                         ["billing_date", "ltp", "item", "quantity"])
    return out.select("billing_date", "ltp", "item", F.col("quantity").cast("bigint"),
                      F.col("amount").cast("double"))


def pooled_threshold(spark, sf):
    out = pricing.pooled_threshold(monthly(spark, sf), ["billing_date", "item"], "pool", "ltp", "quantity",
                                   tiers(spark, sf), ["item"])
    return out.select("billing_date", "item", "pool", "ltp", F.col("member_qty").cast("bigint"),
                      F.col("pool_qty").cast("bigint"), "tier_min", "amount")


def min_quantity(spark, sf):
    m = monthly(spark, sf).join(tiers(spark, sf).filter("tier_min = 1"), "item")
    return m.select("billing_date", "ltp", "item", F.col("quantity").cast("bigint"),
                    pricing.min_quantity(F.col("quantity"), A.MIN_BILLED_QTY, F.col("price")).cast("double")
                    .alias("amount"))


def item_pivot(spark, sf):
    names = {v: f"brand_{v.split('#')[1]}" for v in A.ITEMS}
    out = marts.pivot_items(monthly(spark, sf), ["billing_date", "ltp"], "item", names, F.col("quantity"))
    return out.select("billing_date", "ltp", *[F.col(n).cast("bigint") for n in names.values()])


QUERIES = {
    "tier_graduated": tier_graduated, "tier_wide_unpivot": tier_wide_unpivot, "wide_graduated": wide_graduated,
    "tier_volume": tier_volume,
    "pooled_threshold": pooled_threshold, "min_quantity": min_quantity, "item_pivot": item_pivot,
}


# ---------------------------------------------------------------------------
# Recurring-revenue bridge over the monthly usage fact
# ---------------------------------------------------------------------------
import datetime as _dt  # noqa: E402

from ..operators import bridge as S  # noqa: E402

BRIDGE_AS_OF = _dt.date(2001, 2, 1)   # a day-1 run: prior = 2001-01-01, current = 2001-02-01
_CUR = "[" + ", ".join(f"'{c}'" for c in A.CURRENCIES) + "]"
_FXV = ", ".join(f"({i}, '{c}')" for i, c in enumerate(A.CURRENCIES))


def bridge_lines(spark, sf):
    u = usage(spark, sf)
    return u.select(
        "billing_date", F.col("tenant").alias("global_tenant_id"), F.col("channel_ltp").alias("first_layer_id"),
        *[F.lit("").alias(f"{n}_layer_id") for n in ("second", "third", "fourth", "fifth")],
        "item", "sku", "is_nfr", "quantity", "revenue", "list_price", "ltp_type", "order_date",
        F.concat(F.lit("AM-"), F.col("region_key").cast("string")).alias("account_master_id"))


def bridge_rates(spark, sf):
    return usage(spark, sf).groupBy(F.col("billing_date").alias("snapshot_date"),
                                    F.col("channel_ltp").alias("tenant_global_id"), F.col("item").alias("sku")) \
        .agg(F.min("unit_price").alias("price"))


def bridge_currency(spark, sf):
    n = Tables(spark, sf).nation
    return n.select(F.concat(F.lit("N-"), F.col("n_nationkey").cast("string")).alias("first_layer_id"),
                    F.element_at(F.array(*[F.lit(c) for c in A.CURRENCIES]), F.col("n_regionkey") + 1)
                    .alias("currency"))


def bridge_fx(spark, sf):
    months = Tables(spark, sf).orders.select(F.to_date(F.date_trunc("month", "o_orderdate")).alias("startdate")) \
        .distinct()
    cur = F.explode(F.array(*[F.struct(F.lit(i).alias("r"), F.lit(c).alias("isocode"))
                              for i, c in enumerate(A.CURRENCIES)]))
    return months.select("startdate", cur.alias("c")).select(
        F.col("c.isocode").alias("isocode"),
        F.round((F.lit(1.0) + F.col("c.r") * 0.1 + F.month("startdate") / 1000.0).cast("decimal(38,10)"), 4)
        .cast("decimal(18,4)").alias("conversionrate"), "startdate")


def stored_fact(spark, sf):
    """The bridge fact (S1) written once per (session, folder), like the reference's stored fact table;
    the pivot, both metadata snapshots and the channel flags all read it."""
    key = ("bridge-fact", *state_of(spark, sf))
    if key not in _CACHE:
        # each file in the order of the billing dates, so that only the bridge's two days are read of it; a folder
        # a date would move all rows once more
        fact = S.fact(bridge_lines(spark, sf)).sortWithinPartitions("billing_date")
        _CACHE[key] = materialize(fact, "bridge-fact")
    return _CACHE[key]


def bridge_fact(spark, sf):
    f = stored_fact(spark, sf)
    return f.select(*[F.col(c).cast("double").alias(c) if c == "tenant_mrr" else
                      (S.money(c).alias(c) if c == "max_price" else F.col(c)) for c in f.columns])


def two_period_pivot(spark, sf):
    prior, current = S.bridge_anchors(BRIDGE_AS_OF)
    p = S.two_period_pivot(stored_fact(spark, sf), prior, current)
    return p.select(*[F.col(c).cast("double").alias(c) if c.startswith("tenant_") else F.col(c) for c in p.columns])


def channel_migration(spark, sf):
    prior, current = S.bridge_anchors(BRIDGE_AS_OF)
    return S.channel_flags(stored_fact(spark, sf), prior, current)


def as_of_rates(spark, sf):
    _, current = S.bridge_anchors(BRIDGE_AS_OF)
    return S.as_of_snapshot(bridge_rates(spark, sf), "snapshot_date", current)


def mrr_bridge(spark, sf):
    f = stored_fact(spark, sf)
    return S.mrr_bridge(f, bridge_rates(spark, sf), bridge_currency(spark, sf), bridge_fx(spark, sf), BRIDGE_AS_OF)


_P, _C = (f"DATE '{d.isoformat()}'" for d in S.bridge_anchors(BRIDGE_AS_OF))
_G = OB.G
register("b_lines", ("usage",), """
    SELECT billing_date, tenant AS global_tenant_id, channel_ltp AS first_layer_id, '' AS second_layer_id,
           '' AS third_layer_id, '' AS fourth_layer_id, '' AS fifth_layer_id, item, sku, is_nfr, quantity, revenue,
           list_price, ltp_type, order_date, 'AM-' || CAST(region_key AS VARCHAR) AS account_master_id
    FROM usage""")
register("b_fact", ("b_lines",), f"""
    SELECT billing_date, {_G}, sum(quantity) AS billed_qty, sum(revenue) AS tenant_mrr, max(list_price) AS max_price,
           max(ltp_type) AS ltp_type, max(account_master_id) AS account_master_id,
           sum(sum(quantity)) OVER (PARTITION BY billing_date, first_layer_id) AS total_ltp_billed_qty,
           min(min(order_date)) OVER (PARTITION BY global_tenant_id) AS registration_date
    FROM b_lines GROUP BY billing_date, {_G}""")
register("b_pivot", ("b_fact",), OB.pivot("b_fact", _P, _C))
register("b_rates", ("usage",), """
    SELECT billing_date AS snapshot_date, channel_ltp AS tenant_global_id, item AS sku,
           min(CAST(ROUND(CAST(CAST(revenue AS DOUBLE) / quantity AS DECIMAL(38,10)), 4) AS DECIMAL(18,4))) AS price
    FROM usage GROUP BY ALL""")
register("b_fx", (), f"""
    SELECT c.isocode,
           CAST(ROUND(CAST(1.0::DOUBLE + c.r * 0.1::DOUBLE + month(d.startdate) / 1000.0::DOUBLE AS DECIMAL(38,10)), 4)
                AS DECIMAL(18,4)) AS conversionrate, d.startdate
    FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS startdate FROM orders) d
    CROSS JOIN (VALUES {_FXV}) c(r, isocode)""")
register("b_flags", ("b_fact",), OB.moved("b_fact", _P, _C))
register("b_bridge", ("b_pivot", "b_fact", "b_rates", "b_fx", "b_flags"), OB.bridge(
    "b_fact", "b_pivot", "b_flags", "b_rates", "b_fx",
    f"SELECT 'N-' || CAST(n_nationkey AS VARCHAR) AS first_layer_id, ({_CUR})[n_regionkey + 1] AS currency FROM nation", _P, _C))

SQL.update({
    "bridge_fact": with_ctes(["b_fact"], f"""
        SELECT billing_date, {_G}, CAST(billed_qty AS BIGINT) AS billed_qty, CAST(tenant_mrr AS DOUBLE) AS tenant_mrr,
               {OB._r('max_price')} AS max_price, ltp_type, account_master_id,
               CAST(total_ltp_billed_qty AS BIGINT) AS total_ltp_billed_qty, registration_date FROM b_fact"""),
    "two_period_pivot": with_ctes(["b_pivot"], "SELECT * FROM b_pivot"),
    "channel_migration": with_ctes(["b_flags"], "SELECT * FROM b_flags"),
    "as_of_rates": with_ctes(["b_rates"], f"""
        SELECT * FROM b_rates WHERE snapshot_date = (SELECT max(snapshot_date) FROM b_rates
                                                      WHERE snapshot_date <= {_C})"""),
    "mrr_bridge": with_ctes(["b_bridge"], "SELECT * FROM b_bridge"),
})
QUERIES.update({
    "bridge_fact": bridge_fact, "two_period_pivot": two_period_pivot, "channel_migration": channel_migration,
    "as_of_rates": as_of_rates, "mrr_bridge": mrr_bridge,
})
