"""Edge rows from FIXTURES.md on hand-built snapshots (peak rules, JSON, multi-value text)."""

import datetime as dt

from pyspark.sql import functions as F

from seatmeter.operators import crm, hwm

D = dt.date
HIST = ("record_date date, root string, tenant_global_id string, plan_name string, active_profiles bigint, "
        "licensed_profiles bigint, shared_profiles bigint, approved boolean, billing_status string")
META = ("snapshot_date date, tenant_global_id string, profile_type string, is_highwatermark boolean, "
        "is_tracked boolean")


def _h(spark, rows):
    return spark.createDataFrame(rows, HIST)


def _meta(spark, as_of, hwm_flag=True, profile="shared"):
    return spark.createDataFrame([(as_of, "US-1", profile, hwm_flag, True), (as_of, "US-2", profile, hwm_flag, True)],
                                 META)


def test_peak_prefers_most_expensive_plan_then_max_seats_then_earliest(spark):
    as_of = D(2024, 1, 30)
    rows = [
        (D(2024, 1, 3), "US-1", "US-10", "Starter", 50, 50, None, True, "Active"),        # cheaper plan, more seats
        (D(2024, 1, 5), "US-1", "US-10", "Core", 20, 20, None, True, "Active"),
        (D(2024, 1, 9), "US-1", "US-10", "Core", 30, 30, 10, True, "Active"),             # shared 10 -> 20 seats
        (D(2024, 1, 12), "US-1", "US-10", "Core", 20, 20, 0, True, "Active"),             # tie with the 5th: 20
    ]
    picks = hwm.month_picks(_h(spark, rows), _meta(spark, as_of), as_of).collect()
    assert [(r["tenant_global_id"], r["record_date"]) for r in picks] == [("US-10", D(2024, 1, 5))]


def test_reparented_tenant_is_billed_under_its_newest_root(spark):
    as_of = D(2024, 1, 30)
    rows = [(D(2024, 1, 3), "US-1", "US-10", "Core", 90, 90, None, True, "Active"),
            (D(2024, 1, 20), "US-2", "US-10", "Core", 10, 10, None, True, "Active")]
    pm = hwm.profile_metrics(_h(spark, rows), _meta(spark, as_of), as_of)
    assert {r["root"] for r in pm.collect()} == {"US-2"}


def test_non_peak_tenant_absent_on_run_date_drops_at_rejoin(spark):
    as_of = D(2024, 1, 30)
    hist = _h(spark, [(D(2024, 1, 10), "US-1", "US-10", "Core", 5, 5, None, True, "Active"),
                      (D(2024, 1, 30), "US-1", "US-11", "Core", 7, 7, None, True, "Active")])
    meta = _meta(spark, as_of, hwm_flag=False)
    picks = hwm.month_picks(hist, meta, as_of)
    assert {r["record_date"] for r in picks.collect()} == {as_of}        # stamped with the run date
    assert [r["tenant_global_id"] for r in hwm.rejoin(hist, picks, as_of).collect()] == ["US-11"]


def test_day_one_run_settles_previous_month(spark):
    as_of = D(2024, 2, 1)
    hist = _h(spark, [(D(2024, 1, 1), "US-1", "US-10", "Core", 99, 99, None, True, "Active"),    # outside
                      (D(2024, 1, 2), "US-1", "US-10", "Core", 40, 40, None, True, "Active"),
                      (D(2024, 2, 1), "US-1", "US-10", "Core", 30, 30, None, True, "Active")])
    picks = hwm.month_picks(hist, _meta(spark, as_of), as_of).collect()
    assert [r["record_date"] for r in picks] == [D(2024, 1, 2)]


def test_unapproved_inactive_and_no_plan_rows_are_not_billed(spark):
    as_of = D(2024, 1, 30)
    hist = _h(spark, [(D(2024, 1, 3), "US-1", "US-10", "Core", 9, 9, None, False, "Active"),
                      (D(2024, 1, 4), "US-1", "US-11", "Core", 9, 9, None, True, "Inactive"),
                      (D(2024, 1, 5), "US-1", "US-12", "No_Plan", 9, 9, None, True, "Active")])
    assert hwm.month_picks(hist, _meta(spark, as_of), as_of).count() == 0


def test_json_array_csv_edges(spark):
    df = spark.createDataFrame([(1, '["a","b"]'), (2, '{"k": 1}'), (3, "[]"), (4, None), (5, "not json")],
                               "k int, raw string")
    got = {r["k"]: r["csv"] for r in df.select("k", crm.json_array_csv(F.col("raw")).alias("csv")).collect()}
    assert got == {1: "a,b", 2: None, 3: "", 4: None, 5: None}


def test_multi_value_text_drops_blanks_and_keeps_empty_keys(spark):
    df = spark.createDataFrame([(1, "x; y ;;  ;x"), (2, " ; "), (3, None)], "k int, v string")
    got = sorted((r["k"], r["reason"]) for r in crm.explode_values(df, "k", "v", ";").collect())
    assert got == [(1, "x"), (1, "y"), (2, None), (3, None)]


def test_name_match_is_case_insensitive(spark):
    a = spark.createDataFrame([("ACME Ltd",), ("acme ltd",)], "title string")
    b = spark.createDataFrame([("Acme Ltd", "US-1")], "tenant_name string, tenant_global_id string")
    assert a.join(b, F.lower("title") == F.lower("tenant_name")).count() == 2


def test_sparse_json_parses_with_quotes_in_a_name(spark):
    import json

    from seatmeter.operators import marts
    df = spark.createDataFrame([('a "b" \\ c', True, None), (None, None, 4)], "name string, flag boolean, n int")
    got = [json.loads(r[0]) for r in df.select(marts.sparse_json([("name", F.col("name")), ("flag", F.col("flag")), ("n", F.col("n"))])).collect()]
    assert got == [{"name": 'a "b" \\ c', "flag": True}, {"n": 4}]


def test_exploded_reasons_keep_keys_without_values(spark):
    df = spark.createDataFrame([(1, "a; b;a"), (2, " ; "), (3, None), (1, "b"), (4, "")], "k int, t string")
    got = sorted(((r[0], r[1]) for r in crm.explode_values(df, "k", "t", ";").collect()), key=str)
    assert got == [(1, "a"), (1, "b"), (2, None), (3, None), (4, None)]


def test_any_day_is_billed_and_a_day_without_snapshots_is_refused(spark, sf_small):
    import tempfile

    import pytest

    from seatmeter.plans import daily_bill, daily_job
    d = daily_bill.Domain(spark, sf_small)
    out = tempfile.mkdtemp(prefix="seatmeter-days-")
    rows = {}
    for day in (D(2024, 1, 20), D(2024, 1, 30)):
        paths = daily_job.run_day(d, out, day)
        bill = spark.read.parquet(paths["root_itemized"]).filter(F.col("billing_date") == F.lit(day))
        rows[day] = bill.filter("sku <> 'IS-LTP-MIN'").count()
    assert min(rows.values()) > 10
    before = spark.read.parquet(paths["root_itemized"]).count()
    with pytest.raises(ValueError):
        daily_job.run_day(d, out, D(2031, 5, 5))
    assert spark.read.parquet(paths["root_itemized"]).count() == before
