"""Registered queries: name -> (spark callable, oracle SQL or None).

Every callable takes (spark, sf_dir) and reads the driver tables of that folder
(directly or through the adapters), so its work grows with the data.
Amount columns are rounded to 4 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.joins import multiplied
from ..functions.money import money
from ..operators import hwm, pricing, sinks
from ..session import apply_defaults
from ..sources.tables import state_of
from . import daily_bill as B
from . import oracle_bill  # noqa: F401  (registers the bill CTEs)
from .oracle_base import with_ctes

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

_DOMAINS: dict[tuple, B.Domain] = {}


def domain(spark: SparkSession, sf_dir: str) -> B.Domain:
    """One Domain per session and state of the folder: the history/peak tables are materialised once."""
    key = state_of(spark, sf_dir)
    if key not in _DOMAINS:
        apply_defaults(spark)
        _DOMAINS[key] = B.Domain(spark, sf_dir)
    return _DOMAINS[key]


def release(spark: SparkSession) -> None:
    """Forget all kept results and delete their tables; frames made from them can no longer be read."""
    from . import usage
    _DOMAINS.clear()
    usage._CACHE.clear()
    sinks.release(spark)


def query(name: str, oracle: str | None = None):
    """Register ``fn`` under ``name``; the registered callable first applies the library's
    session defaults (UTC session zone, AQE, a checkpoint folder when none is set)."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__ = getattr(fn, "__name__", name)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _lines_out(df: DataFrame) -> DataFrame:
    return df.select("date_recorded", "ltp", "item", "sku", "partner_pricing", "quantity",
                     money("amount").alias("amount"), "price_type")


_LINES_SQL = ("SELECT date_recorded, ltp, item, sku, partner_pricing, CAST(quantity AS BIGINT) AS quantity, "
              "CAST(ROUND(CAST(amount AS DECIMAL(38,10)), 4) AS DOUBLE) AS amount, price_type FROM {}")

# ---------------------------------------------------------------------------
# Tree (T1-T3)
# ---------------------------------------------------------------------------
TREE_COLS = ["tenant_id", "parent_id", "parent_name", "tenant_name", "indented_name", "root", "depth",
             "parent_global_id", "tenant_global_id", "tree_key"]


@query("tree_closure", with_ctes(["tree"], f"SELECT {', '.join(TREE_COLS)} FROM tree"))
def q_tree_closure(spark, sf):
    return domain(spark, sf).tree.select(*TREE_COLS)


# ---------------------------------------------------------------------------
# Peak selection
# ---------------------------------------------------------------------------

@query("hwm_month", with_ctes(["picks"], "SELECT * FROM picks"))
def q_hwm_month(spark, sf):
    d = domain(spark, sf)
    return hwm.month_picks(d.history, d.meta_all, d.as_of)


@query("hwm_rejoin", with_ctes(["hwm_rows"], "SELECT * FROM hwm_rows"))
def q_hwm_rejoin(spark, sf):
    return B.peak_rows(domain(spark, sf))


@query("hwm_addon_count", with_ctes(["addon_picks"], "SELECT * FROM addon_picks"))
def q_hwm_addon_count(spark, sf):
    d = domain(spark, sf)
    return hwm.addon_peak(d.history, d.meta_all, d.as_of)


# ---------------------------------------------------------------------------
# Pricing (P1-P18)
# ---------------------------------------------------------------------------

@query("price_promo_override", with_ctes(["prices"], "SELECT * FROM prices"))
def q_price_promo_override(spark, sf):
    d = domain(spark, sf)
    return pricing.resolve_prices(d.price_list, d.as_of)


def _branch(name: str, cte: str, build):
    @query(name, with_ctes([cte], _LINES_SQL.format(cte)))
    def fn(spark, sf):
        d = domain(spark, sf)
        return _lines_out(build(d))
    fn.__name__ = f"q_{name}"
    return fn


def _ctx(d: B.Domain):
    meta = d.meta
    prices = pricing.resolve_prices(d.price_list, d.as_of)
    unified = pricing.pool_map(meta, d.pools)
    rules = pricing.active_rules(d.exceptions, d.as_of)
    fine = pricing.seat_grain(B.peak_rows(d), meta, unified, rules)
    return meta, prices, unified, rules, fine


def _with_ctx(build):
    def run(d):
        meta, prices, unified, rules, fine = _ctx(d)
        return build(d, meta, prices, unified, rules, fine)
    return run


_branch("pool_allocate", "plan_lines",
        _with_ctx(lambda d, meta, prices, unified, rules, fine: pricing.plan_lines(fine, multiplied(prices))))
_branch("exception_pricing", "exc_lines",
        _with_ctx(lambda d, meta, prices, unified, rules, fine: pricing.exception_lines(B.peak_rows(d), meta, rules)))
_branch("flat_addon", "premium_lines",
        _with_ctx(lambda d, meta, prices, unified, rules, fine: pricing.premium_lines(fine, prices)))
_branch("tiered_addon", "im_lines",
        _with_ctx(lambda d, meta, prices, unified, rules, fine: pricing.tiered_addon_lines(fine, prices)))
_branch("flat_addon_bundle", "stbp_lines", _with_ctx(lambda d, meta, prices, unified, rules, fine: pricing.flat_addon_lines(
    fine, prices, "simulation_and_training_bundle_plus", "STBP", "S&T Bundle Plus", "IS-LTP-STBP",
    ["Complete Protect", "SAT Suite"])))
_branch("flat_addon_takeover", "ato_lines", _with_ctx(lambda d, meta, prices, unified, rules, fine: pricing.flat_addon_lines(
    fine, prices, "ato", "ATO", "Account Takeover", "IS-LTP-ATO", ["Complete Protect"])))
_branch("per_unit_addon", "dmarc_lines",
        _with_ctx(lambda d, meta, prices, unified, rules, fine: pricing.per_unit_lines(B.addon_rows(d), unified, multiplied(prices))))
_branch("min_commit", "topup", lambda d: B.root_lines(d).filter(F.col("sku") == "IS-LTP-MIN"))
_branch("bill_lines", "lines", lambda d: B.root_lines(d))


# ---------------------------------------------------------------------------
# Allowance and itemized bill
# ---------------------------------------------------------------------------

@query("partner_totals", with_ctes(["partner_tot"], """
    SELECT ltp, total_customers, CAST(total_emails AS BIGINT) AS total_emails FROM partner_tot"""))
def q_partner_totals(spark, sf):
    from ..operators import allowance
    d = domain(spark, sf)
    return allowance.partner_totals(B.peak_rows(d), d.meta)


@query("free_allowance", with_ctes(["nfr"], """
    SELECT tenant_global_id, tenant_name, account_master_id, item, CAST(quantity AS BIGINT) AS quantity,
           CAST(ROUND(CAST(amount AS DECIMAL(38,10)), 4) AS DOUBLE) AS amount, total_customers,
           CAST(total_emails AS BIGINT) AS total_emails, CAST(billable_qty AS BIGINT) AS billable_qty, currency,
           nfr_rate, CAST(ROUND(CAST(invoice AS DECIMAL(38,10)), 4) AS DOUBLE) AS invoice
    FROM nfr"""))
def q_free_allowance(spark, sf):
    n = B.partner_seats(domain(spark, sf))
    return n.withColumn("amount", money("amount")).withColumn("invoice", money("invoice"))


@query("itemized_bill", with_ctes(["itemized"], "SELECT * FROM itemized"))
def q_itemized_bill(spark, sf):
    return B.itemized(domain(spark, sf))


# ---------------------------------------------------------------------------
# More peak-selection variants
# ---------------------------------------------------------------------------
from .oracle_bill import RANK, register_picks  # noqa: E402
from ..operators import select  # noqa: E402
from ..sources import adapters as A  # noqa: E402
import datetime as _dt  # noqa: E402

BACKFILL_AS_OF = _dt.date(2024, 1, 1)     # a day-1 run: settles the previous month
register_picks("_b", BACKFILL_AS_OF)


@query("latest_per_key", with_ctes(["live"], """
    SELECT tenant_global_id, root AS resolved_root FROM live
    QUALIFY row_number() OVER (PARTITION BY tenant_global_id ORDER BY record_date DESC) = 1"""))
def q_latest_per_key(spark, sf):
    d = domain(spark, sf)
    return select.latest(hwm.billable_rows(d.history, d.as_of), ["tenant_global_id"], "record_date") \
        .select("tenant_global_id", F.col("root").alias("resolved_root"))


def _pm(d):
    return hwm.profile_metrics(d.history, d.meta, d.as_of)


@query("priority_pick", with_ctes(["pm"], f"""
    SELECT tenant_global_id, is_highwatermark, plan_name FROM (
      SELECT *, count(DISTINCT plan_name) OVER (PARTITION BY tenant_global_id, is_highwatermark) AS n_plans FROM pm)
    WHERE n_plans > 1
    QUALIFY row_number() OVER (PARTITION BY tenant_global_id, is_highwatermark ORDER BY {RANK}, plan_name) = 1"""))
def q_priority_pick(spark, sf):
    from pyspark.sql import Window
    pm = _pm(domain(spark, sf))
    w = Window.partitionBy("tenant_global_id", "is_highwatermark")
    multi = pm.withColumn("_multi", F.min("plan_name").over(w) != F.max("plan_name").over(w)).filter("_multi")
    return select.pick_by_priority(multi, ["tenant_global_id", "is_highwatermark"], "plan_name",
                                   hwm.PLAN_PRIORITY).select("tenant_global_id", "is_highwatermark", "plan_name")


@query("peak_pick", with_ctes(["pmf"], """
    SELECT tenant_global_id, record_date, profile_count FROM pmf WHERE is_highwatermark
    QUALIFY row_number() OVER (PARTITION BY tenant_global_id ORDER BY profile_count DESC, record_date) = 1"""))
def q_peak_pick(spark, sf):
    rows = hwm.restrict_to_top_plan(_pm(domain(spark, sf)))
    return select.peak(rows.filter("is_highwatermark"), ["tenant_global_id"], "profile_count", "record_date") \
        .select("tenant_global_id", "record_date", "profile_count")


@query("backfill_period", with_ctes(["picks_b"], "SELECT * FROM picks_b"))
def q_backfill_period(spark, sf):
    d = domain(spark, sf)
    return hwm.month_picks(d.history, d.meta_all, BACKFILL_AS_OF, meta_as_of=d.as_of)


_W0, _W1 = (f"DATE '{x.isoformat()}'" for x in hwm.billing_window(A.AS_OF))
_PC = """CASE m.profile_type WHEN 'active' THEN coalesce(h.active_profiles, 0)
                WHEN 'license' THEN coalesce(h.licensed_profiles, 0)
                WHEN 'shared' THEN coalesce(h.active_profiles - coalesce(h.shared_profiles, 0), 0) END"""


@query("recent_plan_hwm", with_ctes(["recent_picks"], "SELECT * FROM recent_picks"))
def q_recent_plan_hwm(spark, sf):
    d = domain(spark, sf)
    return hwm.recent_plan_picks(d.history, d.meta_all, d.as_of)


@query("hwm_max_by", with_ctes(["history", "meta_all"], f"""
    WITH r AS (
      SELECT h.record_date, h.tenant_global_id, m.is_highwatermark, h.plan_name, {_PC} AS profile_count
      FROM history h JOIN meta_all m ON h.root = m.tenant_global_id
      WHERE m.snapshot_date = DATE '{A.AS_OF.isoformat()}'
        AND h.record_date > DATE '2024-01-01' AND h.record_date <= DATE '2024-02-01'
        AND h.approved AND h.billing_status = 'Active'),
    pk AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY tenant_global_id, is_highwatermark
                                                      ORDER BY profile_count DESC, record_date) = 1),
    lt AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY tenant_global_id, is_highwatermark
                                                      ORDER BY record_date DESC) = 1)
    SELECT pk.tenant_global_id, pk.is_highwatermark,
           CASE WHEN pk.is_highwatermark THEN pk.record_date ELSE lt.record_date END AS record_date,
           CASE WHEN pk.is_highwatermark THEN pk.plan_name ELSE lt.plan_name END AS plan_name,
           CASE WHEN pk.is_highwatermark THEN pk.profile_count ELSE lt.profile_count END AS profile_count
    FROM pk JOIN lt ON pk.tenant_global_id = lt.tenant_global_id AND pk.is_highwatermark = lt.is_highwatermark"""))
def q_hwm_max_by(spark, sf):
    d = domain(spark, sf)
    meta = hwm.snapshot(d.meta_all, d.as_of, tracked_only=False)
    return hwm.month_peak_max_by(d.history, meta, _dt.date(2024, 1, 1))


@query("point_in_time", with_ctes(["history", "meta"], f"""
    SELECT DATE '{A.AS_OF.isoformat()}' AS date_recorded, h.* EXCLUDE (record_date), h.record_date AS hwm_date
    FROM history h WHERE h.record_date = DATE '{A.AS_OF.isoformat()}' AND h.approved
      AND h.billing_status IN ('Active', 'Active-POC') AND h.root IN (SELECT tenant_global_id FROM meta)"""))
def q_point_in_time(spark, sf):
    d = domain(spark, sf)
    return hwm.point_in_time(d.history, d.meta_all, d.as_of)


# ---------------------------------------------------------------------------
# Layers (T11-T14)
# ---------------------------------------------------------------------------
from ..functions import paths  # noqa: E402
from ..operators import tree as tree_ops  # noqa: E402

_LAYER_SQL = ", ".join(
    f"coalesce(left(root, 2) || '-' || string_split(id_path, '/')[{i}], '') AS {n}_layer_id"
    for i, n in enumerate(["first", "second", "third", "fourth", "fifth"], 1))
_LAYERS = [f"{n}_layer_id" for n in ["first", "second", "third", "fourth", "fifth"]]


def _layered(d):
    rows = B.peak_rows(d)
    meta = d.meta.select(F.col("tenant_global_id").alias("root"), F.lit("ltp").alias("is_ltp"))
    rows = rows.join(meta, "root", "left").withColumn("is_ltp", F.coalesce("is_ltp", F.lit("not_ltp")))
    return tree_ops.with_layers(rows)


@query("layer_columns", with_ctes(["hwm_rows", "meta"], f"""
    SELECT tenant_global_id, root, tree_key,
           if(root IN (SELECT tenant_global_id FROM meta), 'ltp', 'not_ltp') AS is_ltp, {_LAYER_SQL}
    FROM hwm_rows"""))
def q_layer_columns(spark, sf):
    return _layered(domain(spark, sf)).select("tenant_global_id", "root", "tree_key", "is_ltp", *_LAYERS)


_NAME_JOINS = "\n".join(
    f"LEFT JOIN history n{i} ON n{i}.record_date = l.date_recorded AND n{i}.tenant_global_id = l.{n}_layer_id"
    for i, n in enumerate(["first", "second", "third", "fourth", "fifth"], 1))
_NAME_COLS = ", ".join(f"coalesce(n{i}.tenant_name, '') AS {n}_layer_name"
                       for i, n in enumerate(["first", "second", "third", "fourth", "fifth"], 1))


@query("layer_names", with_ctes(["hwm_rows", "history"], f"""
    SELECT l.tenant_global_id, {', '.join('l.' + c for c in _LAYERS)}, {_NAME_COLS}
    FROM (SELECT date_recorded, tenant_global_id, {_LAYER_SQL} FROM hwm_rows) l
    {_NAME_JOINS}"""))
def q_layer_names(spark, sf):
    d = domain(spark, sf)
    rows = tree_ops.with_layers(B.peak_rows(d)).withColumn("record_date", F.col("date_recorded"))
    named = tree_ops.layer_names(rows.select("record_date", "tenant_global_id", *_LAYERS), d.history)
    return named.select("tenant_global_id", *_LAYERS, *[c.replace("_id", "_name") for c in _LAYERS])


@query("leaf_layer", with_ctes(["hwm_rows"], """
    SELECT tenant_global_id, left(root, 2) || '-' || string_split(id_path, '/')[-1] AS leaf_id, len(string_split(id_path, '/')) AS n_layers
    FROM hwm_rows"""))
def q_leaf_layer(spark, sf):
    """The billed tenant at the end of the path of full ids, at any depth."""
    rows = B.peak_rows(domain(spark, sf))
    return rows.select("tenant_global_id", tree_ops.leaf_id().alias("leaf_id"), F.size(F.split("id_path", paths.ID_SEP)).cast("bigint").alias("n_layers"))


@query("region_split", with_ctes(["tree"], """
    SELECT tenant_global_id, regexp_extract(tenant_global_id, '^([A-Za-z]+)-', 1) AS region,
           regexp_replace(tenant_global_id, '[^0-9]', '', 'g') AS tenant_number FROM tree"""))
def q_region_split(spark, sf):
    t = domain(spark, sf).tree
    return t.select("tenant_global_id", paths.region_of("tenant_global_id").alias("region"),
                    paths.number_of("tenant_global_id").alias("tenant_number"))


# ---------------------------------------------------------------------------
# Seats, FX, rule comparison
# ---------------------------------------------------------------------------
from ..operators import allowance as N  # noqa: E402


@query("seats_by_profile", with_ctes(["base"], """
    SELECT date_recorded, master, root, plan_name, eff_partner, profile_type, CAST(quantity AS BIGINT) AS quantity FROM base"""))
def q_seats_by_profile(spark, sf):
    fine = _ctx(domain(spark, sf))[4]
    return pricing._regroup(fine, ["date_recorded", "master", "root", "plan_name", "eff_partner", "profile_type"]) \
        .withColumn("quantity", F.col("quantity").cast("bigint"))


@query("fx_lag_join", with_ctes(["fx"], """
    SELECT isocode, conversionrate, CAST(startdate AS DATE) + 1 AS fx_date FROM fx"""))
def q_fx_lag_join(spark, sf):
    return N.fx_lag(domain(spark, sf).fx)


FX_TARGET = _dt.date(2024, 2, 10)


ANOTHER_DAY = _dt.date(2024, 1, 20)       # a mid-month run date with dated snapshots of its own
oracle_bill.derive_day("_m", ANOTHER_DAY, ("meta_all", "meta_run", "pools", "price_list", "commitments"))


@query("itemized_backfill", with_ctes(["itemized_m"], "SELECT * FROM itemized_m"))
def q_itemized_backfill(spark, sf):
    return B.itemized(domain(spark, sf).at(ANOTHER_DAY))


@query("fx_nearest", with_ctes(["fx"], f"""
    SELECT isocode, conversionrate, startdate FROM fx
    QUALIFY row_number() OVER (PARTITION BY isocode
                               ORDER BY abs(datediff('day', startdate, DATE '{FX_TARGET.isoformat()}')), startdate) = 1"""))
def q_fx_nearest(spark, sf):
    return N.fx_nearest(domain(spark, sf).fx, FX_TARGET)


_PUBLISHED = "(FROM fx WHERE (day(startdate) + ascii(isocode)) % 5 = 0 AND isocode <> 'GBP')"


def _published(fx):
    """Rates as they are published: every few days, and none for one currency."""
    return fx.filter(((F.dayofmonth("startdate") + F.ascii("isocode")) % 5 == 0) & (F.col("isocode") != "GBP"))


@query("fx_nearest_join", with_ctes(["history", "meta_all", "fx"], f"""
    WITH days AS (
      SELECT h.record_date, h.tenant_global_id, m.currency FROM history h JOIN meta_all m
        ON m.tenant_global_id = h.root AND m.snapshot_date = DATE '{A.AS_OF.isoformat()}'),
    near AS (
      SELECT record_date, currency, startdate, conversionrate
      FROM (SELECT DISTINCT record_date, currency FROM days) JOIN {_PUBLISHED} ON isocode = currency
      QUALIFY row_number() OVER (PARTITION BY record_date, currency ORDER BY abs(record_date - startdate), startdate) = 1)
    SELECT record_date, tenant_global_id, currency, startdate, conversionrate
    FROM days LEFT JOIN near USING (record_date, currency)"""))
def q_fx_nearest_join(spark, sf):
    """Every tenant day with the published rate nearest to it."""
    d = domain(spark, sf)
    m = hwm.snapshot(d.meta_all, d.as_of, tracked_only=False).select(F.col("tenant_global_id").alias("root"), "currency")
    days = d.history.select("record_date", "root", "tenant_global_id").join(m, "root").drop("root")
    return N.fx_nearest_join(days, _published(d.fx)).select("record_date", "tenant_global_id", "currency", "startdate", "conversionrate")


@query("allowance_nearest", with_ctes(["nfr_m", "fx"], f"""
    WITH r AS (
      SELECT isocode, CAST(conversionrate AS DOUBLE) AS rate FROM {_PUBLISHED}
      QUALIFY row_number() OVER (PARTITION BY isocode ORDER BY abs(startdate - DATE '{ANOTHER_DAY.isoformat()}'), startdate) = 1)
    SELECT tenant_global_id, item, CAST(quantity AS BIGINT) AS quantity, CAST(billable_qty AS BIGINT) AS billable_qty, currency,
           CASE item WHEN 'Complete Protect' THEN 2 WHEN 'Email Protect' THEN 1 END * coalesce(rate, 1.0::DOUBLE) AS nfr_rate
    FROM nfr_m LEFT JOIN r ON isocode = currency"""))
def q_allowance_nearest(spark, sf):
    """The partner-seat allowance of a backfilled day at the published rate nearest to it."""
    d = domain(spark, sf).at(ANOTHER_DAY)
    n = N.allowance(B.peak_rows(d), hwm.snapshot(d.meta_all, ANOTHER_DAY), B.root_lines(d), _published(d.fx), ANOTHER_DAY, rate="nearest")
    return n.select("tenant_global_id", "item", F.col("quantity").cast("bigint"), F.col("billable_qty").cast("bigint"), "currency", "nfr_rate")


@query("rule_compare", with_ctes(["lines", "partner_tot", "meta"], f"""
    SELECT ltp, item, CAST(quantity AS BIGINT) AS quantity, {oracle_bill.MONEY('amount')} AS row_amount,
           {oracle_bill.MONEY('paid')} AS ltp_total_paid, total_customers, CAST(total_emails AS BIGINT) AS total_emails,
           CAST(v[1] AS BIGINT) AS billable_qty_old, CAST(v[2] AS BIGINT) AS billable_qty_new
    FROM (
      SELECT *, list_transform([amount > 0, coalesce(paid, 0) > 0],
                               lambda spends: greatest(quantity - if(coalesce(big, false) OR coalesce(spends, false), 100, 0), 0)) AS v
      FROM (SELECT *, sum(CAST(amount AS DECIMAL(38,10))) OVER (PARTITION BY ltp) AS paid,
                   total_customers > 1 OR total_emails > 100 AS big
            FROM lines LEFT JOIN partner_tot USING (ltp)))
    WHERE partner_pricing AND quantity > 1 AND item IN ('Complete Protect', 'Email Protect') AND v[1] <> v[2]
      AND ltp IN (SELECT tenant_global_id FROM meta WHERE ltp_type = 'msp' AND registration_date + 90 <= snapshot_date)"""))
def q_rule_compare(spark, sf):
    d = domain(spark, sf)
    out = N.rule_compare(B.root_lines(d), B.peak_rows(d), d.meta, d.as_of)
    return out.select("ltp", "item", F.col("quantity").cast("bigint"), money("row_amount").alias("row_amount"),
                      money("ltp_total_paid").alias("ltp_total_paid"), "total_customers", F.col("total_emails").cast("bigint"),
                      F.col("billable_qty_old").cast("bigint"), F.col("billable_qty_new").cast("bigint"))


# ---------------------------------------------------------------------------
# Usage-metered pricing
# ---------------------------------------------------------------------------
from . import usage as _usage  # noqa: E402

for _name, _fn in _usage.QUERIES.items():
    query(_name, _usage.SQL[_name])(_fn)

# ---------------------------------------------------------------------------
# Staging, CRM and metrics
# ---------------------------------------------------------------------------
from . import crm_metrics as _crm  # noqa: E402

for _name, _fn in _crm.QUERIES.items():
    query(_name, _crm.SQL.get(_name))(_fn)

# ---------------------------------------------------------------------------
# Sub-tenant pricing
# ---------------------------------------------------------------------------
_SUB = ("billing_date, tenant_global_id, first_layer_id, second_layer_id, third_layer_id, fourth_layer_id, fifth_layer_id, item, "
        "sku, partner_pricing, CAST(billable_quantity AS BIGINT) AS billable_quantity, "
        "CAST(ROUND(CAST(amount AS DECIMAL(38,10)), 4) AS DOUBLE) AS amount, price_type FROM {}")


def _sub_out(df):
    return df.select("billing_date", "tenant_global_id", "first_layer_id", "second_layer_id", "third_layer_id", "fourth_layer_id",
                     "fifth_layer_id", "item", "sku", "partner_pricing",
                     F.col("billable_quantity").cast("bigint"), money("amount").alias("amount"), "price_type")


@query("subtenant_lines", with_ctes(["sub_lines"], "SELECT " + _SUB.format("sub_lines")))
def q_subtenant_lines(spark, sf):
    return _sub_out(B.subtenant_lines(domain(spark, sf)))


@query("subtenant_blended", with_ctes(["sub_blended"], "SELECT " + _SUB.format("sub_blended")))
def q_subtenant_blended(spark, sf):
    return _sub_out(B.subtenant_lines(domain(spark, sf), only=("blended",)))


@query("subtenant_per_unit", with_ctes(["sub_leaf"], "SELECT " + _SUB.format("sub_leaf")))
def q_subtenant_per_unit(spark, sf):
    return _sub_out(B.subtenant_lines(domain(spark, sf), only=("per_unit",)))


# ---------------------------------------------------------------------------
# Tenant enrichment, sinks and JSON
# ---------------------------------------------------------------------------
from . import tenants as _tenants  # noqa: E402

for _name, _fn in _tenants.QUERIES.items():
    query(_name, _tenants.SQL.get(_name))(_fn)

# ---------------------------------------------------------------------------
# Sub-tenant itemized bill and the regional mailbox mart (M1, M5-M7)
# ---------------------------------------------------------------------------
@query("subtenant_itemized", with_ctes(["sub_itemized"], "SELECT * FROM sub_itemized"))
def q_subtenant_itemized(spark, sf):
    return B.subtenant_itemized(domain(spark, sf))


@query("mailbox_mart", with_ctes(["mailbox"], "SELECT * FROM mailbox"))
def q_mailbox_mart(spark, sf):
    """The mart of all regions."""
    return B.mailbox_mart(domain(spark, sf))


@query("no_peak_lines", with_ctes(["lines_np"], _LINES_SQL.format("lines_np")))
def q_no_peak_lines(spark, sf):
    """Root bill lines of the run date's own rows, without peaks."""
    return _lines_out(B.root_lines(domain(spark, sf), peak=False))


@query("no_peak_bill", with_ctes(["itemized_np"], "SELECT * FROM itemized_np"))
def q_no_peak_bill(spark, sf):
    """The itemized bill without peaks; its partner-seat lines come from the peak calculation (M1)."""
    return B.itemized(domain(spark, sf), peak=False)


@query("no_peak_subtenant", with_ctes(["sub_lines_np"], "SELECT " + _SUB.format("sub_lines_np")))
def q_no_peak_subtenant(spark, sf):
    """Sub-tenant lines without peaks, priced from the no-peak bill."""
    return _sub_out(B.subtenant_lines(domain(spark, sf), peak=False))


@query("addon_menu", with_ctes(["addon_menu"], "SELECT * FROM addon_menu"))
def q_addon_menu(spark, sf):
    d = domain(spark, sf)
    picks = hwm.recent_plan_picks(d.history, d.meta_all, d.as_of)
    rows = hwm.rejoin(d.history, picks, d.as_of)
    return pricing.addon_menu(rows, d.meta, pricing.resolve_prices(d.price_list, d.as_of))


@query("subtenant_flat", with_ctes(["sub_flat"], "SELECT " + _SUB.format("sub_flat")))
def q_subtenant_flat(spark, sf):
    return _sub_out(B.subtenant_lines(domain(spark, sf), only=("flat",)))


@query("bridge_bill_fact", with_ctes(["bill_fact"], "SELECT * FROM bill_fact"))
def q_bridge_bill_fact(spark, sf):
    from ..operators import bridge
    d = domain(spark, sf)
    return bridge.bill_fact(B.subtenant_itemized(d), d.meta_all, d.price_list, d.as_of)


# ---------------------------------------------------------------------------
# The bridge over two days' sub-tenant bills (S1-S11 on the bill)
# ---------------------------------------------------------------------------
from . import oracle_bridge as OB  # noqa: E402
from .oracle_base import register as _register  # noqa: E402
from ..functions.dates import bridge_anchors as _anchors  # noqa: E402

_PRIOR, _CURRENT = _anchors(A.AS_OF)
oracle_bill.derive_day("_p", _PRIOR)


_register("bb_fact", ("bill_fact", "bill_fact_p"), """
    SELECT * REPLACE (CAST(tenant_mrr AS DECIMAL(18,4)) AS tenant_mrr) FROM bill_fact
    UNION ALL
    SELECT * REPLACE (CAST(tenant_mrr AS DECIMAL(18,4)) AS tenant_mrr) FROM bill_fact_p""")
_register("bb_rates", ("price_list",), "SELECT snapshot_date, tenant_global_id, sku, price FROM price_list")
_DAYS = [f"DATE '{d.isoformat()}'" for d in (_PRIOR, _CURRENT)]
_register("bb_pivot", ("bb_fact",), OB.pivot("bb_fact", *_DAYS))
_register("bb_flags", ("bb_fact",), OB.moved("bb_fact", *_DAYS))
_register("bb_bridge", ("bb_pivot", "bb_fact", "bb_rates", "fx", "bb_flags", "meta_all"), OB.bridge(
    "bb_fact", "bb_pivot", "bb_flags", "bb_rates", "fx",
    "SELECT tenant_global_id AS first_layer_id, max(upper(trim(currency))) AS currency "
    f"FROM {OB.latest('meta_all', 'snapshot_date', _DAYS[1])} GROUP BY ALL", *_DAYS))


@query("mrr_bridge_bill", with_ctes(["bb_bridge"], "SELECT * FROM bb_bridge"))
def q_mrr_bridge_bill(spark, sf):
    return B.bill_bridge(domain(spark, sf))
