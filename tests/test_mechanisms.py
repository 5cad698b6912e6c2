"""Mechanisms with results worked out by hand: array flatten, nearest rates, loads, contracts, objects, wide prices, metrics."""

import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from seatmeter.operators import allowance, crm, loads, marts, metrics, pricing, select, sinks, subtenant
from seatmeter.operators import tree as tree_ops


def day(n, month=1):
    return dt.date(2024, month, n)


# --- C9 ------------------------------------------------------------------------

def test_documents_are_flattened(spark):
    period = json.dumps({"startDate": 1704067200000, "endDate": 1704153599999})
    one = {"day": "2024-01-01", "email": "a@b.c", "userId": "7", "isActive": True, "chatRequests": 3, "totalAccepts": "many"}
    rows = [(period, json.dumps([one, {"email": "x"}, None, 5])), (period, json.dumps({"k": one})), (period, "[]"), (period, '"text"'),
            (period, None), (period, "{no json"), (None, json.dumps([one])), (json.dumps({"startDate": 5}), json.dumps([{}]))]
    got = crm.flatten_activity(spark.createDataFrame(rows, "period string, data string")).collect()
    assert len(got[0]) == 29
    full = [r for r in got if r.email == "a@b.c"]
    assert len(got) == 4 + 1 + 1 + 1 and len(full) == 3
    r = [x for x in full if x.start_date_raw is not None][0]
    assert (r.day, r.user_id, r.is_active, r.chat_requests, r.total_accepts, r.agent_requests) == (day(1), "7", True, 3, None, None)
    assert r.start_date == dt.datetime(2024, 1, 1) and r.end_date == dt.datetime(2024, 1, 1, 23, 59, 59, 999000)
    assert [x for x in full if x.start_date_raw is None][0].start_date is None
    assert sum(all(x[c] is None for c in ("day", "email", "user_id", "chat_requests")) for x in got) == 3      # null, 5 and {}


# --- N5 ------------------------------------------------------------------------

def test_nearest_rate_of_every_row(spark):
    rates = [("USD", 1.0, day(3)), ("USD", 1.1, day(7)), ("USD", 1.2, day(20)), ("EUR", 2.0, day(10)), ("EUR", 2.5, day(10)), ("CAD", None, day(9))]
    fx = spark.createDataFrame(rates, "isocode string, conversionrate double, startdate date")
    rows = [(c, day(d)) for c in ("USD", "EUR", "CAD", "GBP", None) for d in (1, 3, 5, 6, 7, 13, 14, 31)] + [("USD", day(5))] * 3 + [("USD", None)]
    got = allowance.fx_nearest_join(spark.createDataFrame(rows, "currency string, record_date date"), fx).collect()
    assert len(got) == len(rows)
    best = {}
    for c, rate, at in rates:
        best.setdefault((c, at), []).append(rate)
    for r in got:
        mine = sorted(((abs((at - r.record_date).days), at) for c, at in best if c == r.currency)) if r.record_date else []
        assert r.startdate == (mine[0][1] if mine else None)
        assert r.conversionrate == (max((x for x in best[r.currency, mine[0][1]] if x is not None), default=None) if mine else None)
    empty = allowance.fx_nearest_join(spark.createDataFrame(rows, "currency string, record_date date"), fx.limit(0)).collect()
    assert len(empty) == len(rows) and all(r.startdate is None for r in empty)


def test_as_of_in_both_directions_by_several_keys(spark):
    left = spark.createDataFrame([("a", 1, day(5)), ("a", 2, day(5)), ("b", 1, day(5))], "k string, j int, d date")
    right = spark.createDataFrame([("a", 1, day(4), "p"), ("a", 1, day(6), "n"), ("a", 2, day(9), "q")], "k string, j int, e date, v string")
    got = {(r.k, r.j): (r.e, r.v) for r in select.nearest_as_of(left, right, ["k", "j"], "d", "e", ["v"]).collect()}
    assert got == {("a", 1): (day(4), "p"), ("a", 2): (day(9), "q"), ("b", 1): (None, None)}


# --- G2, M3 ----------------------------------------------------------------------

def events(spark, *rows):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, d)) for i, d in rows], "id long, ts timestamp_ntz")


def test_loads_add_only_what_is_new(spark):
    target = loads.Target(spark, tempfile.mkdtemp(prefix="seatmeter-load-") + "/t", "ts")
    assert target.load(events(spark, (1, 1), (2, 2))) == 2
    both = events(spark, (1, 1), (2, 2), (3, 3))
    assert target.load(both) == 1 and target.load(both) == 0 and len(target.commits()) == 2
    # a load that died before its commit: its folder is not read, and nothing is lost
    events(spark, (9, 9)).write.parquet(f"{target.path}/load-dead")
    assert sorted(r.id for r in target.read().collect()) == [1, 2, 3]
    assert target.load(events(spark, (3, 3), (4, 4))) == 1
    assert sorted(r.id for r in loads.Target(spark, target.path, "ts").read().collect()) == [1, 2, 3, 4]
    with pytest.raises(sinks.SchemaDrift):
        target.load(events(spark, (5, 5)).withColumn("more", F.lit(1)))
    assert target.read().count() == 4


def test_two_loads_at_once_commit_once(spark):
    target = loads.Target(spark, tempfile.mkdtemp(prefix="seatmeter-load-") + "/t", "ts")
    target.load(events(spark, (1, 1)))
    other = loads.Target(spark, target.path, "ts")
    seen = other.commits()
    other.commits = lambda: seen                              # it has read the commits before the next line
    target.load(events(spark, (2, 2)))
    with pytest.raises(RuntimeError):
        other.load(events(spark, (2, 2)))
    assert sorted(r.id for r in target.read().collect()) == [1, 2]


def test_a_changed_schema_is_refused(spark):
    path = tempfile.mkdtemp(prefix="seatmeter-day-") + "/t"
    df = spark.createDataFrame([(day(1), "a", 1), (day(2), "b", 2)], "billing_date date, ltp string, quantity int")
    sinks.write_day(df, path)
    for bad in (df.withColumn("more", F.lit(1)), df.drop("ltp"), df.withColumn("quantity", F.col("quantity").cast("long"))):
        with pytest.raises(sinks.SchemaDrift):
            sinks.write_day(bad, path, days=[day(1)])
    assert sorted(tuple(r) for r in sinks.read_days(spark, path).select(*df.columns).collect()) == sorted(tuple(r) for r in df.collect())
    sinks.write_day(df.select("quantity", "ltp", "billing_date"), path)          # another order is the same table
    assert sinks.read_days(spark, path).count() == 2


def test_a_day_and_its_divisions_are_replaced(spark):
    path = tempfile.mkdtemp(prefix="seatmeter-day-") + "/t"
    schema = "record_date date, region string, n int"
    write = lambda rows: sinks.write_day(spark.createDataFrame(rows, schema), path, "record_date", days=[day(2)], within="region")
    sinks.write_day(spark.createDataFrame([(day(1), "US", 1)], schema), path, "record_date", within="region")
    write([(day(2), "US", 2), (day(2), "EU", 3)])
    write([(day(2), "US", 4)])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("record_date", "region", "n").collect()) == [(day(1), "US", 1), (day(2), "US", 4)]
    write([])
    assert [r.n for r in spark.read.parquet(path).collect()] == [1]


def test_release_leaves_other_sessions_alone(spark):
    other = spark.newSession()
    mine, theirs = sinks.materialize(spark.range(3), "mine"), sinks.materialize(other.range(4), "theirs")
    sinks.release(other)
    assert mine.count() == 3
    with pytest.raises(Exception):
        theirs.count()


# --- M7 --------------------------------------------------------------------------

def test_objects_hold_what_is_on_and_the_first_of_equal_keys(spark):
    names = [n for n, _, _ in marts.MAILBOX_ITEMS]
    on = {"Premium_Content_NINJIO": 4, "Premium_Content_Cybermaniacs": 9, "Account_Takeover": 0, "DMARC_Pro_Management": 2, "DMARC_Premium_Management": 3}
    row = {n: n in on for n in names} | {f"{n}_of_Licenses": on.get(n, 0) for n in names}
    schema = ", ".join(f"{n} boolean, {n}_of_Licenses long" for n in names)
    df = spark.createDataFrame([tuple(row[c] for n in names for c in (n, f"{n}_of_Licenses")), (None,) * (2 * len(names))], schema)
    got = [json.loads(r.o) for r in df.select(marts.billable_items().alias("o")).collect()]
    assert got[0] == {"PREMIUM_SAT_PACK": True, "PREMIUM_SAT_PACK_QUANTITY": 4, "PREMIUM_SAT_PACK_NAME": "NINJIO", "ATO": True, "ATO_QUANTITY": 0,
                      "DMARC_MANAGEMENT": True, "DMARC_MANAGEMENT_QUANTITY": 2, "DMARC_MANAGEMENT_PLAN": "Pro"}
    assert list(got[0]) == sorted(got[0]) and got[1] == {}
    flags = [c for _, c in marts.ADD_ONS]
    snap = spark.createDataFrame([tuple('say "hi"\\' if c == "premium_name" else None if c == "ato" else c == "teams_protection" for c in flags)],
                                 ", ".join(f"{c} {'string' if c == 'premium_name' else 'boolean'}" for c in flags))
    shown = json.loads(snap.select(marts.active_add_ons().alias("o")).first().o)
    assert shown["SAT_CONTENT_PACK"] == 'say "hi"\\' and "ATO" not in shown and shown["TEAMS_PROTECTION"] and len(shown) == 12


# --- P24, P28 ----------------------------------------------------------------------

def test_wide_prices_follow_the_column_names(spark):
    wide = spark.createDataFrame([("a", 5.0, 4.0, 3.0, 2.0, None)], "t string, EP_1 double, EP_750 double, EP_100 double, EPNFR_1 double, CP_1 double")
    got = sorted((r.plan_name, r.is_nfr, r.tier_min, r.tier_max, float(r.price)) for r in pricing.unpivot_wide(wide, ["t"], {"EP": "Email", "CP": "Complete"}).collect())
    assert got == [("Email", False, 1, 100, 5.0), ("Email", False, 101, 750, 3.0), ("Email", False, 751, None, 4.0), ("Email", True, 1, None, 2.0)]
    with pytest.raises(ValueError):
        pricing.unpivot_wide(wide, ["t"], {"EP": "Email"})


def test_menu_conditions(spark):
    flags = sorted({a.flag for a in pricing.ADDON_MENU} | {x for a in pricing.ADDON_MENU for x in a.without})

    def skus(plan, partner=False, **on):
        row = {f: on.get(f, False) for f in flags}
        df = spark.createDataFrame([(plan, partner, *row.values())], "plan_name string, partner_pricing boolean, " + ", ".join(f"{f} boolean" for f in row))
        r = df.select(*[pricing.enabled(a).alias(a.sku) for a in pricing.ADDON_MENU]).first()
        return {a.sku for a in pricing.ADDON_MENU if r[a.sku]}

    assert skus("Starter", link_scanning=True, file_scanning=True) == {"IS-LTP-URL", "IS-LTP-AS"} and skus("Core", link_scanning=True) == set()
    assert skus("SAT Suite", security_awareness_training=True) == {"IS-LTP-PSTSAT"} and skus("Core", security_awareness_training=True) == {"IS-LTP-SAT"}
    assert skus("Core", security_awareness_training=True, simulation_and_training_bundle=True) == {"IS-LTP-STB"}
    assert skus("Core", security_awareness_training=True, simulation_and_training_bundle=None) == set()
    assert skus("Core", partner=True, ato=True, multi_tenancy=True, incident_management=True) == {"IS-LTP-IM"}
    assert skus("Core", themis_co_pilot=True, ai_empower_bundle=True) == {"IS-LTP-AIEB"} and skus("Core", themis_co_pilot=True) == {"IS-LTP-THEMIS"}
    assert skus("Complete Protect", **{f: True for f in flags}) == {"IS-LTP-IM"}


# --- T13: any depth ------------------------------------------------------------------

def test_a_tenant_of_level_seven_keeps_its_own_bill(spark):
    path = "1/2/3/4/5/6/7"
    rows = [(day(30), "US-1", path[: 2 * n - 1], f"US-{n}", "Email Protect", None, n, False) for n in (5, 6, 7)]
    df = spark.createDataFrame(rows, "date_recorded date, root string, id_path string, tenant_global_id string, plan_name string, premium_name string, "
                                     "active_profiles long, partner_pricing boolean")
    df = df.withColumns({c: F.lit(False) for c in ("incident_management", "simulation_and_training_bundle_plus", "ato", "not_nfr_partner")})
    df = df.withColumns({"approved": F.lit(True), "billing_status": F.lit("Active"), "licensed_profiles": F.lit(0), "shared_profiles": F.lit(0)})
    layered = tree_ops.with_layers(df)
    assert {r.leaf for r in layered.select(tree_ops.leaf_id().alias("leaf")).collect()} == {"US-5", "US-6", "US-7"}
    meta = spark.createDataFrame([("US-1", "active")], "tenant_global_id string, profile_type string")
    bill = spark.createDataFrame([("US-1", "Email Protect", False, 18, 36.0, None)],
                                 "ltp string, item string, partner_pricing boolean, quantity long, amount double, price_type string")
    lines = subtenant.blended(subtenant.base_rows(layered, meta), bill)
    item = marts.itemize(lines, None, day(30), keys=["tenant_global_id", *subtenant.LAYERS], qty_col="billable_quantity")
    assert {(r.tenant_global_id, r.fifth_layer_id, r.quantity, r.amount) for r in item.collect()} == {
        ("US-5", "US-5", 5, 10.0), ("US-6", "US-5", 6, 12.0), ("US-7", "US-5", 7, 14.0)}
    flags = {r.tenant_global_id: r.Email_Protect_of_Licenses for r in marts.item_flags(item).collect()}
    assert flags == {"US-5": 5, "US-6": 6, "US-7": 7}


# --- Q1 ------------------------------------------------------------------------------

def test_a_tenant_counts_once_in_each_group(spark):
    rows = [(day(1), "a", "r", "P", "Active", False, True, True, 10, 2), (day(1), "a", "r", "Q", "Active", False, True, True, 10, None),
            (day(1), "b", "r", "P", "Inactive", True, False, True, 5, 1), (day(1), "c", "s", "P", "Active-POC", False, None, False, None, 1)]
    df = spark.createDataFrame(rows, "record_date date, tenant_global_id string, root string, plan_name string, billing_status string, partner_pricing boolean, "
                                     "dmarc_management boolean, approved boolean, active_profiles long, shared_profiles long")
    days = metrics.tenant_days(df)
    names = ["tenant_count", "billable_tenant_count", "poc_tenant_count", "dmarc_enabled_count", "total_active_profiles", "net_billable_seats"]
    assert tuple(metrics.metric(days, names).first())[1:] == (3, 1, 1, 1, 25, 18)
    by = {r.plan_name: tuple(r)[2:] for r in metrics.metric(days, names, ["plan_name"]).collect()}
    assert by == {"P": (3, 1, 1, 1, 15, 8), "Q": (1, 1, 0, 1, 10, 10)}
    plan = metrics.metric(days, names, ["root"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    with pytest.raises(ValueError):
        metrics.metric(days, ["no_such_metric"])
