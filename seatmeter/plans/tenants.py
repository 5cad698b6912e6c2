"""Tenant enrichment marts (T4-T10), sinks and JSON outputs (M2, M7, M8, M9) with oracle SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import labels as L
from ..operators import marts, sinks, tree as tree_ops
from ..sources.tables import Tables
from .oracle_base import with_ctes
from .oracle_bill import MAILBOX

QUERIES: dict = {}
SQL: dict = {}


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _snap(o):
    """Order rows read as tenant snapshots (codes and dates by rule)."""
    k = F.col("o_orderkey")
    d = F.to_date("o_orderdate")
    return o.select(
        "o_orderkey", "o_custkey",
        F.when(k % 9 != 0, k % 9).cast("int").alias("plan_id"),
        F.when(k % 8 != 0, k % 8).cast("int").alias("premium_id"),
        F.when(k % 4 == 0, F.lit(2)).cast("int").alias("trial_plan_id"),
        F.date_add(d, (k % 60).cast("int")).alias("plan_expiry"),
        F.date_add(d, (k % 20).cast("int")).alias("trial_expiry"),
        F.date_sub(d, (F.col("o_custkey") % 45).cast("int")).alias("registered"),
        F.date_add(d, 10).alias("roundup"),
        F.when(k % 6 != 5, k % 6).cast("int").alias("server_type"),
        F.when(k % 7 != 0, k % 3 == 0).alias("enabled"))


_SNAP_SQL = """
    SELECT o_orderkey, o_custkey,
           CAST(CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 9 END AS INTEGER) AS plan_id,
           CAST(CASE WHEN o_orderkey % 8 <> 0 THEN o_orderkey % 8 END AS INTEGER) AS premium_id,
           CAST(CASE WHEN o_orderkey % 4 = 0 THEN 2 END AS INTEGER) AS trial_plan_id,
           CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) AS plan_expiry,
           CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) AS trial_expiry,
           CAST(o_orderdate AS DATE) - CAST(o_custkey % 45 AS INTEGER) AS registered,
           CAST(o_orderdate AS DATE) + 10 AS roundup,
           CAST(CASE WHEN o_orderkey % 6 <> 5 THEN o_orderkey % 6 END AS INTEGER) AS server_type,
           CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 3 = 0 END AS enabled
    FROM orders"""


def _names(m):
    return "MAP {" + ", ".join(f"{k}: '{v}'" for k, v in m.items()) + "}"


@q("status_classifier", f"""
    WITH s AS ({_SNAP_SQL}),
    told AS (
      SELECT *, coalesce(trial_plan_id IS NOT NULL AND trial_expiry >= roundup AND registered IS NOT NULL, false) AS on_trial,
             coalesce(plan_id IS NOT NULL AND plan_expiry >= roundup, false) AS paying,
             datediff('day', registered, roundup) AS age, coalesce(enabled, false) AS is_on,
             {_names(L.INTEGRATION_TYPES)} AS kinds, {_names(L.PLAN_NAMES)} AS plans, {_names(L.PREMIUM_NAMES)} AS packs
      FROM s)
    SELECT o_orderkey, coalesce(plans[plan_id], CAST(plan_id AS VARCHAR), 'No_Plan') AS plan_name,
           coalesce(packs[premium_id], CAST(premium_id AS VARCHAR), 'No Premium') AS premium_name,
           CASE WHEN on_trial AND age < 30 THEN 'POC' WHEN on_trial THEN if(plan_id IS NULL, 'Inactive', 'Active') || '-POC'
                ELSE if(paying, 'Active', 'Inactive') END AS billing_status,
           is_on OR coalesce(server_type <> 0, true) AS integration,
           if(server_type = 0, if(is_on, 'GMAIL', 'NONE'), kinds[server_type]) AS integration_type
    FROM told""")
def status_classifier(spark, sf):
    s = _snap(Tables(spark, sf).orders)
    flag, kind = L.integration(F.col("server_type"), F.col("enabled"))
    return s.select(
        "o_orderkey", L.label(F.col("plan_id"), L.PLAN_NAMES, "No_Plan").alias("plan_name"),
        L.label(F.col("premium_id"), L.PREMIUM_NAMES, "No Premium").alias("premium_name"),
        L.billing_status(F.col("plan_id"), F.col("trial_plan_id"), F.col("plan_expiry"), F.col("trial_expiry"),
                         F.col("registered"), F.col("roundup")).alias("billing_status"),
        flag.alias("integration"), kind.alias("integration_type"))


@q("active_count", """
    SELECT o_custkey AS company_id, count(*) AS active_profiles FROM orders WHERE o_orderstatus = 'O' GROUP BY 1""")
def active_count(spark, sf):
    o = Tables(spark, sf).orders
    return o.filter(F.col("o_orderstatus") == "O").groupBy(F.col("o_custkey").alias("company_id")) \
        .agg(F.count(F.lit(1)).alias("active_profiles"))


@q("tagged_count", """
    SELECT o.o_custkey AS company_id, count(DISTINCT o.o_orderkey) AS shared_profiles
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
    WHERE p.p_type = 'PROMO' GROUP BY 1""")
def tagged_count(spark, sf):
    t = Tables(spark, sf)
    tag = t.part.filter(F.col("p_type") == "PROMO").select("p_partkey")
    links = t.lineitem.select("l_orderkey", "l_partkey").join(tag, F.col("l_partkey") == F.col("p_partkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(links, F.col("o_orderkey") == F.col("l_orderkey")) \
        .groupBy(F.col("o_custkey").alias("company_id")).agg(F.countDistinct("o_orderkey").alias("shared_profiles"))


@q("star_enrich", with_ctes(["tree"], """
    SELECT t.tenant_global_id, t.root, t.depth, t.tenant_name, n_name AS nation, c_acctbal AS balance, s_name AS owner_name,
           (SELECT nullif(count(*), 0) FROM orders WHERE o_custkey = t.tenant_id AND o_orderstatus = 'O') AS active_profiles,
           (SELECT nullif(count(DISTINCT o_orderkey), 0) FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
            WHERE o_custkey = t.tenant_id AND p_type = 'PROMO') AS shared_profiles,
           CAST((SELECT max(o_orderkey) FROM orders WHERE o_custkey = t.tenant_id) % 6 AS INTEGER) AS serverside_type,
           (SELECT bool_or(o_orderpriority = '1-URGENT') FROM orders WHERE o_custkey = t.tenant_id) AS webhook_enabled
    FROM tree t LEFT JOIN customer ON t.tenant_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN supplier ON s_suppkey = c_custkey % 13"""))
def star_enrich(spark, sf):
    """The tenant tree with its seven dimensions: company, nation, owner, active and shared counts, settings, webhook."""
    from .catalog import domain
    t = Tables(spark, sf)
    tree = domain(spark, sf).tree.select("tenant_id", "tenant_global_id", "root", "depth", "tenant_name")
    c = t.customer.select(F.col("c_custkey").alias("tenant_id"), "c_nationkey", F.col("c_acctbal").alias("balance"))
    n = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    owner = t.supplier.select(F.col("s_suppkey").alias("_owner"), F.col("s_name").alias("owner_name"))
    # settings and webhook are read off the same orders: one aggregate for both
    o = t.orders.groupBy(F.col("o_custkey").alias("tenant_id")).agg(
        (F.max("o_orderkey") % 6).cast("int").alias("serverside_type"), F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("webhook_enabled"))
    j = (tree.join(c, "tenant_id", "left").join(n, "c_nationkey", "left").join(owner, F.col("tenant_id") % 13 == F.col("_owner"), "left")
         .join(active_count(spark, sf).withColumnRenamed("company_id", "tenant_id"), "tenant_id", "left")
         .join(tagged_count(spark, sf).withColumnRenamed("company_id", "tenant_id"), "tenant_id", "left").join(o, "tenant_id", "left"))
    return j.select("tenant_global_id", "root", "depth", "tenant_name", "nation", "balance", "owner_name", "active_profiles",
                    "shared_profiles", "serverside_type", "webhook_enabled")


@q("history_union", with_ctes(["history"], """
    SELECT * FROM history WHERE record_date < DATE '2024-01-30'
    UNION
    SELECT * FROM history WHERE record_date >= DATE '2024-01-29'"""))
def history_union(spark, sf):
    """Stored history plus today's snapshot as one set (T10); only the days that both hold are compared."""
    from .catalog import domain
    import datetime as dt
    h = domain(spark, sf).history
    stored = h.filter(F.col("record_date") < F.lit(dt.date(2024, 1, 30)))
    today = h.filter(F.col("record_date") >= F.lit(dt.date(2024, 1, 29)))
    return sinks.unite(stored, today, "record_date")


# --- sinks and JSON (M2, M7, M8, M9) -------------------------------------------

@q("day_replace_sink", with_ctes(["itemized"], "SELECT * FROM itemized"))
def day_replace_sink(spark, sf):
    """Write the itemized bill twice with day replacement and read it back: no duplicates (M2-M4)."""
    from .catalog import domain
    from . import daily_bill as B
    bill = B.itemized(domain(spark, sf))
    from ..session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sinks/itemized-{uuid.uuid4().hex}"
    sinks.write_day(bill, path)
    sinks.write_day(bill, path)          # a re-run of the same day replaces it
    back = sinks.read_days(spark, path)
    return back.select(*bill.columns)


@q("sparse_json", with_ctes(["mailbox"], """
    SELECT region, tenant_number, billable_items, active_add_ons FROM mailbox"""))
def sparse_json(spark, sf):
    """The billed items and the active add-ons of every mailbox tenant as two JSON objects (M7)."""
    from .catalog import domain
    from . import daily_bill as B
    return B.mailbox_mart(domain(spark, sf)).select("region", "tenant_number", "billable_items", "active_add_ons")


@q("api_json", with_ctes(["mailbox"], """
    SELECT record_date, region, billing_date, tenant_number, tenant_name, parent_number, parent_name, licensed_profiles,
           active_profiles, shared_profiles, billable_profiles, plan_id, plan_expiry_date, trial_plan_expiry_date,
           registration_date, parent_type, billable_items, active_add_ons, not_for_resale_flag AS is_partner, tree_key
    FROM mailbox WHERE billable_profiles IS NOT NULL"""))
def api_json(spark, sf):
    """What the API gives of the mailbox mart, all regions (M8)."""
    from .catalog import domain
    from . import daily_bill as B
    return marts.mailbox_api(B.mailbox_mart(domain(spark, sf)))


_ROLLUP = ", ".join(f"CAST(sum({n}_of_Licenses) AS BIGINT) AS {n}_of_Licenses" for n, _, _ in MAILBOX)


@q("channel_rollup", with_ctes(["mailbox_flags", "sub_itemized", "meta", "tree"], f"""
    WITH placed AS (
      SELECT DISTINCT tenant_global_id, ltp_type, first_layer_id,
             if(ltp_type = 'disti', coalesce(second_layer_id, ''), first_layer_id) AS msp_id
      FROM sub_itemized JOIN (SELECT tenant_global_id AS first_layer_id, ltp_type FROM meta) USING (first_layer_id)
      WHERE ltp_type IN ('disti', 'msp'))
    SELECT if(ltp_type = 'msp', 'direct', 'second_tier') AS msp_type, first_layer_id AS msp_parent_id,
           any_value((SELECT tenant_name FROM tree t WHERE t.tenant_global_id = first_layer_id)) AS msp_parent_name, msp_id,
           any_value((SELECT tenant_name FROM tree t WHERE t.tenant_global_id = msp_id)) AS msp_name, count(*) AS tenants, {_ROLLUP}
    FROM placed JOIN mailbox_flags USING (tenant_global_id)
    GROUP BY ltp_type, first_layer_id, msp_id"""))
def channel_rollup(spark, sf):
    """Item quantities of distributors' partners and of direct partners (M9)."""
    from .catalog import domain
    from . import daily_bill as B
    d = domain(spark, sf)
    return marts.channel_rollup(B.subtenant_itemized(d), d.meta, d.tree, d.as_of)


@q("incremental_snapshot", """
    SELECT user_id, CAST(ts AS DATE) AS record_date, count(*) AS n_events,
           count(*) FILTER (WHERE event_type = 'error') AS n_error, min(event_type) AS first_type
    FROM events GROUP BY 1, 2""")
def incremental_snapshot(spark, sf):
    """The daily snapshot built by the Structured Streaming loader over the event files."""
    from ..streaming import incremental
    from ..session import ensure_checkpoint_dir
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/events-{uuid.uuid4().hex}"
    q_ = incremental.run(spark, f"{sf.rstrip('/')}/events*.parquet", f"{base}/raw", f"{base}/snapshot",
                         f"{base}/checkpoint")
    q_.awaitTermination()
    return spark.read.parquet(f"{base}/snapshot").select("user_id", "record_date", "n_events", "n_error",
                                                         "first_type")
