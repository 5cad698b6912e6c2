"""Staging filters, CRM marts and semantic metrics (G1-G5, C1-C10, Q1-Q6) with their oracle SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import crm, metrics
from ..operators.select import latest
from ..sources import adapters as A
from ..sources.tables import Tables
from . import usage as U
from .oracle_base import with_ctes

AS_OF = A.AS_OF
SPLIT_DAY = dt.datetime(2024, 1, 20)          # target table of the incremental load ends here
OWNERS = ["NATION_1", "NATION_7", "NATION_13"]  # allow-list parameter (C3)
BANDS = [(0.0, "Negative"), (2500.0, "Small"), (7500.0, "Mid")]
_D = f"DATE '{AS_OF.isoformat()}'"
QUERIES: dict = {}
SQL: dict = {}


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _t(spark, sf):
    return Tables(spark, sf)


# --- staging (G1-G5) ---------------------------------------------------------

@q("stage_copy", "SELECT * FROM part")
def stage_copy(spark, sf):
    return _t(spark, sf).part


@q("incremental_new_rows", f"""
    SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{SPLIT_DAY.isoformat(' ')}')""")
def incremental_new_rows(spark, sf):
    ev = _t(spark, sf).events
    split = F.to_timestamp_ntz(F.lit(SPLIT_DAY.isoformat(" ")))
    return crm.newer_than_target(ev, ev.filter(F.col("ts") < split), "ts")


@q("latest_load_filter", f"SELECT * FROM events WHERE CAST(ts AS DATE) = {_D}")
def latest_load_filter(spark, sf):
    return _t(spark, sf).events.filter(F.to_date("ts") == F.lit(AS_OF))


@q("snapshot_filter", with_ctes(["price_list"], f"SELECT * FROM price_list WHERE snapshot_date = {_D}"))
def snapshot_filter(spark, sf):
    from .catalog import domain
    return domain(spark, sf).price_list.filter(F.col("snapshot_date") == F.lit(AS_OF))


@q("project_cast", with_ctes(["exceptions"], """
    SELECT tenant_id, item, sku, CAST(partner_pricing AS BOOLEAN) AS partner_pricing,
           CAST(tier_min AS BIGINT) AS tier_min, CAST(tier_max AS BIGINT) AS tier_max,
           CAST(tier_rate AS DOUBLE) AS tier_rate, CAST(start_date AS DATE) AS start_date,
           CAST(end_date AS DATE) AS end_date FROM exceptions"""))
def project_cast(spark, sf):
    from .catalog import domain
    e = domain(spark, sf).exceptions
    return e.select("tenant_id", "item", "sku", F.col("partner_pricing").cast("boolean"),
                    F.col("tier_min").cast("bigint"), F.col("tier_max").cast("bigint"),
                    F.col("tier_rate").cast("double"), F.col("start_date").cast("date"),
                    F.col("end_date").cast("date"))


# --- checks and metrics (Q1-Q6) ----------------------------------------------
# The columns every source table must fill (checked by one aggregate per table).
NOT_NULL = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    "part": ["p_partkey", "p_brand", "p_type"],
    "events": ["event_id", "ts", "user_id", "event_type"],
}


@q("not_null_check", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, '{c}' AS column_name, count(*) - count({c}) AS null_count "
    f"FROM {t}" for t, cols in NOT_NULL.items() for c in cols))
def not_null_check(spark, sf):
    t = _t(spark, sf)
    return crm.null_counts({name: (getattr(t, name), cols) for name, cols in NOT_NULL.items()}) \
        .select("table_name", "n_rows", "column_name", "null_count")


@q("time_spine", """
    SELECT CAST(unnest(generate_series(lo, CAST(hi + INTERVAL 2 YEAR - INTERVAL 1 DAY AS DATE), INTERVAL 1 DAY))
                AS DATE) AS date_day
    FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders)""")
def time_spine(spark, sf):
    b = _t(spark, sf).orders.agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    return metrics.spine(b.withColumn("hi", F.date_sub(F.add_months("hi", 24), 1)), "lo", "hi")


@q("snapshot_spine", with_ctes(["history"], """
    SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_day
    FROM (SELECT date_trunc('month', min(record_date)) AS lo, last_day(max(record_date)) AS hi FROM history)"""))
def snapshot_spine(spark, sf):
    """The days of the months that snapshots lie in (Q5 with bounds of its own)."""
    from .catalog import domain
    b = domain(spark, sf).history.agg(F.to_date(F.date_trunc("month", F.min("record_date"))).alias("start"), F.last_day(F.max("record_date")).alias("end"))
    return metrics.spine(b, "start", "end")


@q("metric_counts", with_ctes(["history"], """
    SELECT record_date, count(DISTINCT tenant_global_id) AS tenants,
           count(DISTINCT CASE WHEN billing_status IN ('Active', 'Active-POC') THEN tenant_global_id END) AS billable,
           count(DISTINCT CASE WHEN billing_status = 'Active-POC' THEN tenant_global_id END) AS poc,
           count(DISTINCT CASE WHEN billing_status = 'Inactive' THEN tenant_global_id END) AS inactive,
           count(DISTINCT CASE WHEN dmarc_management THEN tenant_global_id END) AS dmarc
    FROM history GROUP BY record_date"""))
def metric_counts(spark, sf):
    from .catalog import domain
    h = domain(spark, sf).history
    st = F.col("billing_status")
    # distinct tenants per condition: one (day, tenant) row with flags, then plain counts. Several
    # conditional count-distincts would make Spark copy every row once per distinct aggregate.
    per = h.groupBy("record_date", "tenant_global_id").agg(
        F.bool_or(st.isin("Active", "Active-POC")).alias("b"), F.bool_or(st == "Active-POC").alias("p"),
        F.bool_or(st == "Inactive").alias("i"), F.bool_or(F.col("dmarc_management")).alias("d"))
    return per.groupBy("record_date").agg(
        F.count(F.lit(1)).alias("tenants"), F.count_if("b").alias("billable"), F.count_if("p").alias("poc"),
        F.count_if("i").alias("inactive"), F.count_if("d").alias("dmarc"))


def _metric_sql(dims: list[str]) -> str:
    d = "".join(f", {x}" for x in dims)
    return with_ctes(["history"], f"""
    SELECT record_date{d}, count(DISTINCT tenant_global_id) AS tenant_count,
           count(DISTINCT tenant_global_id) FILTER (WHERE approved AND billing_status IN ('Active', 'Active-POC')) AS billable_tenant_count,
           count(DISTINCT tenant_global_id) FILTER (WHERE billing_status = 'Active-POC') AS poc_tenant_count,
           count(DISTINCT tenant_global_id) FILTER (WHERE billing_status = 'Inactive') AS inactive_tenant_count,
           count(DISTINCT tenant_global_id) FILTER (WHERE dmarc_management) AS dmarc_enabled_count,
           CAST(sum(active_profiles) AS BIGINT) AS total_active_profiles, CAST(sum(shared_profiles) AS BIGINT) AS total_shared_profiles,
           CAST(sum(coalesce(active_profiles, 0) - coalesce(shared_profiles, 0))
                FILTER (WHERE approved AND billing_status IN ('Active', 'Active-POC')) AS BIGINT) AS net_billable_seats
    FROM history GROUP BY ALL""")


def _metric(spark, sf, dims):
    from .catalog import domain
    return metrics.metric(metrics.tenant_days(domain(spark, sf).history), [*metrics.COUNTS, *metrics.SUMS], dims)


@q("metric_by_plan", _metric_sql(["plan_name", "partner_pricing"]))
def metric_by_plan(spark, sf):
    """All tenant metrics by day, plan and partner flag (Q1)."""
    return _metric(spark, sf, ["plan_name", "partner_pricing"])


@q("metric_by_root", _metric_sql(["root", "billing_status"]))
def metric_by_root(spark, sf):
    """All tenant metrics by day, partner and status (Q1)."""
    return _metric(spark, sf, ["root", "billing_status"])


@q("metric_seats", with_ctes(["history"], """
    SELECT record_date, CAST(sum(active_profiles) AS BIGINT) AS active_seats,
           CAST(sum(shared_profiles) AS BIGINT) AS shared_seats,
           CAST(sum(active_profiles - coalesce(shared_profiles, 0)) AS BIGINT) AS net_billable_seats
    FROM history GROUP BY record_date"""))
def metric_seats(spark, sf):
    from .catalog import domain
    h = domain(spark, sf).history
    return h.groupBy("record_date").agg(
        F.sum("active_profiles").alias("active_seats"), F.sum("shared_profiles").alias("shared_seats"),
        F.sum(F.col("active_profiles") - F.coalesce("shared_profiles", F.lit(0))).alias("net_billable_seats"))


@q("metric_billing", with_ctes(["usage"], """
    SELECT billing_date, CAST(sum(revenue) AS DOUBLE) AS amount,
           CAST(coalesce(sum(CASE WHEN is_nfr = false OR is_nfr IS NULL THEN revenue END), 0) AS DOUBLE)
             AS commercial_amount,
           CAST(sum(quantity) AS BIGINT) AS seats, count(DISTINCT ltp) AS active_partners
    FROM usage GROUP BY billing_date"""))
def metric_billing(spark, sf):
    u = U.usage(spark, sf)
    commercial = (F.col("is_nfr") == F.lit(False)) | F.col("is_nfr").isNull()
    return u.groupBy("billing_date").agg(
        F.sum("revenue").cast("double").alias("amount"),
        F.coalesce(F.sum(F.when(commercial, F.col("revenue"))), F.lit(0)).cast("double").alias("commercial_amount"),
        F.sum("quantity").alias("seats"), F.countDistinct("ltp").alias("active_partners"))


@q("current_mrr", with_ctes(["b_fact"], """
    SELECT first_layer_id, billing_date, CAST(sum(tenant_mrr) AS DOUBLE) AS mrr FROM b_fact
    WHERE billing_date = (SELECT max(billing_date) FROM b_fact) GROUP BY ALL"""))
def current_mrr(spark, sf):
    from ..operators import bridge as S
    f = U.stored_fact(spark, sf)
    cur = S.as_of_snapshot(f, "billing_date", dt.date(9999, 12, 31))
    return cur.groupBy("first_layer_id", "billing_date").agg(F.sum("tenant_mrr").cast("double").alias("mrr"))


@q("settled_months", with_ctes(["b_fact"], """
    SELECT billing_date, CAST(sum(tenant_mrr) AS DOUBLE) AS mrr, count(DISTINCT global_tenant_id) AS tenants
    FROM b_fact WHERE day(billing_date) = 1 GROUP BY ALL"""))
def settled_months(spark, sf):
    f = U.stored_fact(spark, sf)
    return f.filter(F.dayofmonth("billing_date") == 1).groupBy("billing_date").agg(
        F.sum("tenant_mrr").cast("double").alias("mrr"), F.countDistinct("global_tenant_id").alias("tenants"))


# --- CRM and activity (C1-C10) -------------------------------------------------
_BAND_SQL = "CASE " + " ".join(f"WHEN c.c_acctbal < {hi} THEN '{lab}'" for hi, lab in BANDS) + " ELSE 'Large' END"


@q("churn_bands", f"""
    SELECT o.o_orderkey, c.c_name AS account_name, n.n_name AS owner_name, pa.c_name AS parent_name,
           CAST(o.o_orderdate AS DATE) AS close_date, -o.o_totalprice AS arr_change, {_BAND_SQL} AS size_band
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN customer pa ON c.c_custkey // 10 = pa.c_custkey AND c.c_custkey >= 10
    WHERE year(o.o_orderdate) >= 1998 AND o.o_orderstatus = 'F' AND -o.o_totalprice < 0""")
def churn_bands(spark, sf):
    t = _t(spark, sf)
    o = t.orders.filter((F.col("o_orderdate") >= F.lit(dt.date(1998, 1, 1))) & (F.col("o_orderstatus") == "F")
                        & (-F.col("o_totalprice") < 0))
    c = t.customer.select("c_custkey", F.col("c_name").alias("account_name"), "c_nationkey", "c_acctbal")
    n = t.nation.select("n_nationkey", F.col("n_name").alias("owner_name"))
    pa = t.customer.select(F.col("c_custkey").alias("parent_key"), F.col("c_name").alias("parent_name"))
    j = (o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left")
         .join(pa, (F.expr("c_custkey div 10") == F.col("parent_key")) & (F.col("c_custkey") >= 10), "left"))
    return j.select("o_orderkey", "account_name", "owner_name", "parent_name",
                    F.to_date("o_orderdate").alias("close_date"), (-F.col("o_totalprice")).alias("arr_change"),
                    crm.size_band(F.col("c_acctbal"), BANDS, "Large").alias("size_band"))


@q("explode_reasons", """
    SELECT DISTINCT p_partkey, reason FROM (
      SELECT p_partkey, trim(unnest(string_split(p_name, ' '))) AS reason FROM part) WHERE reason <> ''
    UNION
    SELECT p_partkey, NULL FROM part WHERE p_partkey NOT IN (
      SELECT p_partkey FROM (SELECT p_partkey, trim(unnest(string_split(p_name, ' '))) AS r FROM part) WHERE r <> '')""")
def explode_reasons(spark, sf):
    return crm.explode_values(_t(spark, sf).part, "p_partkey", "p_name", " ").orderBy("p_partkey", "reason")


@q("owner_filter", """
    SELECT o.o_orderkey, c.c_name, n.n_name, o.o_totalprice FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE n.n_name IN (""" + ", ".join(f"'{x}'" for x in OWNERS) + ")")
def owner_filter(spark, sf):
    t = _t(spark, sf)
    n = t.nation.filter(F.col("n_name").isin(*OWNERS)).select("n_nationkey", "n_name")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return t.orders.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "n_name",
                                                                             "o_totalprice")


@q("latest_opportunity", """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderstatus FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def latest_opportunity(spark, sf):
    o = _t(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    return latest(o, ["o_custkey"], "o_orderdate", "o_orderkey")


@q("json_array_csv", """
    WITH f AS (SELECT user_id, CAST(ts AS DATE) AS record_date,
                      CASE WHEN user_id % 5 = 0 THEN '{"types": ' || to_json(list_sort(list(DISTINCT event_type))) || '}'
                           ELSE CAST(to_json(list_sort(list(DISTINCT event_type))) AS VARCHAR) END AS raw
               FROM events GROUP BY 1, 2)
    SELECT user_id, record_date, raw,
           CASE WHEN json_type(raw) = 'ARRAY' THEN array_to_string(from_json(raw, '["VARCHAR"]'), ',') END AS csv
    FROM f""")
def json_array_csv(spark, sf):
    ev = _t(spark, sf).events
    types = F.to_json(F.sort_array(F.collect_set("event_type")))
    f = ev.groupBy("user_id", F.to_date("ts").alias("record_date")).agg(types.alias("_arr"))
    raw = F.when(F.col("user_id") % 5 == 0, F.concat(F.lit('{"types": '), F.col("_arr"), F.lit("}"))) \
        .otherwise(F.col("_arr"))
    f = f.select("user_id", "record_date", raw.alias("raw"))
    return f.select("*", crm.json_array_csv(F.col("raw")).alias("csv"))


@q("json_scalar_field", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, epoch_us(ts) // 1000 AS event_ms FROM events""")
def json_scalar_field(spark, sf):
    ev = _t(spark, sf).events
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))     # wall-clock epoch: zone-free
    return ev.select("event_id", crm.json_field(F.col("props"), "$.k", "bigint").alias("k"),
                     F.timestamp_diff("MILLISECOND", epoch, F.col("ts")).alias("event_ms"))


_SNAKE = {member: name for name, member, _ in crm.ACTIVITY_FIELDS}


@q("json_flatten", f"""
    WITH d AS (
      SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n_all, min(event_type) AS first_type,
             {', '.join(f"count(*) FILTER (WHERE event_type = '{x}') AS n_{x}" for x in ('view', 'signup', 'purchase', 'click', 'error'))}
      FROM events WHERE user_id % 7 NOT IN (3, 4, 6) GROUP BY 1, 2),
    w AS (SELECT *, CAST(date_trunc('week', day) AS DATE) AS week FROM d)
    SELECT epoch_ms(week) AS start_date_raw, epoch_ms(week + INTERVAL 7 DAY) - 1 AS end_date_raw,
           CAST(week AS TIMESTAMP) AS start_date, CAST(week AS TIMESTAMP) + INTERVAL 7 DAY - INTERVAL 1 MILLISECOND AS end_date, day,
           'u' || user_id || '@example.com' AS email, CAST(user_id AS VARCHAR) AS user_id, n_purchase > 0 AS is_active,
           '1.' || user_id % 10 AS client_version, first_type AS most_used_model,
           CASE WHEN user_id % 2 = 0 THEN '.py' END AS apply_most_used_extension,
           CASE WHEN user_id % 3 = 0 THEN '.sql' END AS tab_most_used_extension,
           {', '.join(f"CAST({e} AS BIGINT) AS {_SNAKE[n]}" for n, e in A.ACTIVITY_COUNTERS.items())}
    FROM w""")
def json_flatten(spark, sf):
    """Activity documents flattened: a row per daily object of an array or of an object's members."""
    return crm.flatten_activity(A.activity_docs(_t(spark, sf)))


@q("incremental_loads", "SELECT * FROM events")
def incremental_loads(spark, sf):
    """A stored target after two loads and a repeated one (G2): every source row once."""
    import uuid
    from ..operators.loads import Target
    from ..session import ensure_checkpoint_dir
    ev = _t(spark, sf).events
    target = Target(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/loads/events-{uuid.uuid4().hex}", "ts")
    target.load(ev.filter(F.col("ts") < F.to_timestamp_ntz(F.lit(SPLIT_DAY.isoformat(" ")))))
    target.load(ev)
    target.load(ev)
    return target.read()


CHURN_SINCE = dt.date(1997, 1, 1)
HISTORY_UNTIL = dt.date(2024, 1, 18)
_OPPS = """
    opps AS (
      SELECT o_orderkey AS opp_id, o_custkey AS account_id, c_nationkey AS owner_id,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'Renewal' WHEN '2-HIGH' THEN 'Renewal/Upsell' WHEN '3-MEDIUM' THEN 'Terminated' ELSE 'New' END AS type,
             CASE o_orderstatus WHEN 'F' THEN 'Closed Won' WHEN 'P' THEN 'Closed Lost' ELSE 'Open' END AS stage,
             CAST(o_orderdate AS DATE) AS churn_date, if(o_orderkey % 13 = 0, 1, -1) * o_totalprice AS change_in_arr, o_totalprice AS arr,
             CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey % 4000 END AS users,
             CASE WHEN o_orderkey % 5 <> 0 THEN 'reason ' || o_orderkey % 5 END AS loss_reason
      FROM orders JOIN customer ON o_custkey = c_custkey)"""
_TIER = "CASE WHEN users < 1000 THEN '< 1000' WHEN users <= 2500 THEN '1000 - 2500' WHEN users > 2500 THEN '> 2500' END AS license_tier"


@q("churn_report", f"""
    WITH {_OPPS}
    SELECT opp_id, churn_date, n_name AS owner_name, c_name AS account_name, type, stage, c_acctbal AS total_arr, change_in_arr, loss_reason,
           users, {_TIER}
    FROM opps LEFT JOIN customer ON c_custkey = account_id LEFT JOIN nation ON n_nationkey = owner_id
    WHERE churn_date >= DATE '{CHURN_SINCE.isoformat()}' AND change_in_arr < 0
      AND (type IN ('Renewal', 'Renewal/Upsell') OR (type = 'Terminated' AND stage = 'Closed Won'))""")
def churn_report(spark, sf):
    """Lost revenue with the type, stage and licence rules."""
    t = _t(spark, sf)
    return crm.churn_report(A.opportunities(t), A.accounts(t), A.owners(t), CHURN_SINCE)


@q("poc_report", f"""
    WITH {_OPPS}
    SELECT opp_id, l_orderkey || '-' || l_linenumber AS poc_id, 'POC ' || l_linenumber AS poc_name, CAST(l_shipdate AS DATE) AS end_date,
           n_name AS owner_name, stage, arr, users, {_TIER}
    FROM opps JOIN lineitem ON l_orderkey = opp_id JOIN nation ON n_nationkey = owner_id
    WHERE l_orderkey % 3 = 0 AND l_linenumber IN (1, 2) AND CAST(l_shipdate AS DATE) >= DATE '{CHURN_SINCE.isoformat()}'
      AND n_name IN ({", ".join(f"'{x}'" for x in OWNERS)}) AND stage <> 'Open'""")
def poc_report(spark, sf):
    """Trials of closed opportunities by owner, date and stage."""
    t = _t(spark, sf)
    return crm.poc_report(A.opportunities(t), A.pocs(t), A.owners(t), OWNERS, CHURN_SINCE)


@q("json_path_csv", """
    WITH f AS (SELECT user_id, CAST(ts AS DATE) AS record_date, list_sort(list(DISTINCT event_type)) AS types FROM events GROUP BY 1, 2)
    SELECT user_id, record_date,
           CASE WHEN user_id % 6 NOT IN (3, 4, 5) THEN array_to_string(types, ',') END AS request_by
    FROM f""")
def json_path_csv(spark, sf):
    """The array at a path inside a ticket's custom fields as a list; an object, a scalar or nothing there gives NULL."""
    ev, u = _t(spark, sf).events, F.col("user_id")
    f = ev.groupBy("user_id", F.to_date("ts").alias("record_date")).agg(F.to_json(F.sort_array(F.collect_set("event_type"))).alias("_arr"))
    value = F.when(u % 6 == 3, F.concat(F.lit('{"list": '), "_arr", F.lit("}"))).when(u % 6 == 4, F.lit('"one"')).otherwise(F.col("_arr"))
    raw = F.when(u % 6 == 5, F.lit('{"customfield_2": []}')).otherwise(F.concat(F.lit('{"customfield_1": '), value, F.lit(', "customfield_2": 5}')))
    return f.select("user_id", "record_date", crm.json_array_csv(raw, "$.customfield_1").alias("request_by"))


@q("activity_history", f"""
    WITH d AS (
      SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS p,
             count(*) FILTER (WHERE event_type = 'error') AS e, count(*) FILTER (WHERE event_type = 'click') AS c FROM events GROUP BY 1, 2)
    SELECT DISTINCT CASE WHEN dayofweek(day) BETWEEN 1 AND 5 THEN day END AS date,
           CASE WHEN dayofweek(day) BETWEEN 1 AND 5 THEN 'Sprint ' || dayofyear(day) // 10 END AS sprint,
           CASE WHEN user_id % 4 <> 0 THEN 'u' || user_id || '@example.com' END AS email,
           CASE WHEN user_id % 4 <> 0 THEN ['backend', 'frontend', 'data'][user_id % 3 + 1] END AS skill_set,
           CASE WHEN user_id % 4 <> 0 THEN 'team ' || user_id % 5 END AS team,
           n * 5 + e * 2 AS total_chat_suggested, p * 3 + e AS total_chat_accepted, c AS agent_requests
    FROM d WHERE day <= DATE '{HISTORY_UNTIL.isoformat()}' OR user_id % 7 NOT IN (3, 4, 6)""")
def activity_history(spark, sf):
    """Stored activity and the flattened documents as one set, with teams and sprints."""
    t = _t(spark, sf)
    return crm.activity_history(A.past_activity(t, HISTORY_UNTIL), crm.flatten_activity(A.activity_docs(t)), A.people(t), A.sprints(t))


@q("name_match", with_ctes(["tree"], """
    WITH tickets AS (SELECT e.event_id, upper(c.c_name) AS title FROM events e
                     JOIN customer c ON e.user_id = c.c_custkey WHERE e.event_type = 'error')
    SELECT t.tenant_global_id, count(*) AS tickets FROM tickets k
    JOIN tree t ON lower(k.title) = lower(t.tenant_name) GROUP BY 1"""))
def name_match(spark, sf):
    from .catalog import domain
    t = _t(spark, sf)
    tickets = t.events.filter(F.col("event_type") == "error").join(
        t.customer.select("c_custkey", "c_name"), F.col("user_id") == F.col("c_custkey")) \
        .select("event_id", F.upper("c_name").alias("title"))
    tree = domain(spark, sf).tree.select("tenant_global_id", "tenant_name")
    return tickets.join(tree, F.lower("title") == F.lower("tenant_name")).groupBy("tenant_global_id") \
        .agg(F.count(F.lit(1)).alias("tickets"))


@q("union_history_latest", """
    SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events
    WHERE CAST(ts AS DATE) <= DATE '2024-01-20' GROUP BY 1, 2
    UNION
    SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events
    WHERE CAST(ts AS DATE) >= DATE '2024-01-15' GROUP BY 1, 2""")
def union_history_latest(spark, sf):
    ev = _t(spark, sf).events.select("user_id", F.to_date("ts").alias("day"))
    daily = ev.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"))
    hist = daily.filter(F.col("day") <= F.lit(dt.date(2024, 1, 20)))
    new = daily.filter(F.col("day") >= F.lit(dt.date(2024, 1, 15)))
    return hist.unionByName(new).distinct()
