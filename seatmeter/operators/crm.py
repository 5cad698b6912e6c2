"""CRM, ticket and activity marts (C1-C10) and staging filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_values(df: DataFrame, key: str, text: str, sep: str, out: str = "reason") -> DataFrame:
    """Multi-value text -> one row per trimmed, non-blank value; keys without any value keep one
    NULL row; set semantics (C2, C4)."""
    parts = F.filter(F.transform(F.split(F.col(text), sep), lambda v: F.trim(v)), lambda v: v != "")
    # an empty list explodes to one NULL row; repeated keys are folded by the last distinct
    return df.select(key, F.explode_outer(F.array_distinct(parts)).alias(out)).distinct()


def json_array_csv(raw: Column, path: str = "$") -> Column:
    """JSON text -> comma list when there is an array at the path, else NULL (C7); NULL elements are left out."""
    v = F.try_variant_get(F.try_parse_json(raw), path, "variant")
    is_array = F.schema_of_variant(v).startswith("ARRAY")
    return F.when(is_array, F.array_join(F.variant_get(v, "$", "array<string>"), ","))


# Bands of the licences of an account (C1, C3), upper bound (inclusive from the second on) and label.
LICENSE_BANDS = ((1000, "< 1000"), (2500, "1000 - 2500"))


def license_band(users: Column) -> Column:
    """Band of a number of licences; NULL stays NULL."""
    (low, small), (high, mid) = LICENSE_BANDS
    return F.when(users < low, small).when(users <= high, mid).when(users > high, f"> {high}")


def churn_report(opps: DataFrame, accounts: DataFrame, owners: DataFrame, since) -> DataFrame:
    """Lost recurring revenue since a date (C1): renewals, and terminations that were closed as won, with a negative change.

    opps: opp_id, account_id, owner_id, type, stage, churn_date, change_in_arr, users, loss_reason;
    accounts: account_id, account_name, total_arr; owners: owner_id, owner_name.
    """
    lost = opps.filter((F.col("churn_date") >= F.lit(since)) & (F.col("change_in_arr") < 0)
                       & (F.col("type").isin("Renewal", "Renewal/Upsell") | ((F.col("type") == "Terminated") & (F.col("stage") == "Closed Won"))))
    j = lost.join(accounts, "account_id", "left").join(owners, "owner_id", "left")
    return j.select("opp_id", "churn_date", "owner_name", "account_name", "type", "stage", "total_arr", "change_in_arr", "loss_reason",
                    "users", license_band(F.col("users")).alias("license_tier"))


def poc_report(opps: DataFrame, pocs: DataFrame, owners: DataFrame, names: Sequence[str], since) -> DataFrame:
    """Closed opportunities of the listed owners with trials that ended since a date (C3); a row per trial.

    pocs: poc_id, opp_id, poc_name, end_date.
    """
    ended = pocs.filter(F.col("end_date") >= F.lit(since))
    mine = owners.filter(F.col("owner_name").isin(*names))
    closed = opps.filter(F.col("stage").isin("Closed Lost", "Closed Won"))
    # both conditions look at the right sides, so the outer joins of the report are inner ones
    j = closed.join(mine, "owner_id").join(ended, "opp_id")
    return j.select("opp_id", "poc_id", "poc_name", "end_date", "owner_name", "stage", "arr", "users",
                    license_band(F.col("users")).alias("license_tier"))


def activity_history(past: DataFrame, activity: DataFrame, people: DataFrame, sprints: DataFrame) -> DataFrame:
    """Stored history and the newest activity as one set of rows (C10), with the person's team and the day's sprint.

    past: email, date, suggested, accepted, agent_requests; activity: ``flatten_activity`` rows; people: email, skill_set, team;
    sprints: datestamp, sprint. People and days that are not known give NULLs, as the outer joins say; equal rows count once.
    """
    new = activity.select("email", F.col("day").alias("date"), (F.col("total_lines_added") + F.col("total_lines_deleted")).alias("suggested"),
                          (F.col("accepted_lines_added") + F.col("accepted_lines_deleted")).alias("accepted"), "agent_requests")
    rows = past.select(*new.columns).unionByName(new)
    known = people.select(F.col("email").alias("_email"), F.col("email").alias("known_email"), "skill_set", "team")
    j = (rows.join(known, F.col("email") == F.col("_email"), "left")
         .join(sprints, F.col("date") == F.col("datestamp"), "left"))
    return j.select(F.col("datestamp").alias("date"), "sprint", F.col("known_email").alias("email"), "skill_set", "team",
                    F.col("suggested").alias("total_chat_suggested"), F.col("accepted").alias("total_chat_accepted"), "agent_requests").distinct()


def json_field(raw: Column, path: str, type_: str) -> Column:
    """Typed field of a JSON text column via the variant type."""
    return F.try_variant_get(F.try_parse_json(raw), path, type_)


# Typed columns of a daily activity object (column, member, type).
ACTIVITY_FIELDS = [
    ("day", "day", "date"), ("email", "email", "string"), ("user_id", "userId", "string"), ("is_active", "isActive", "boolean"),
    ("client_version", "clientVersion", "string"), ("most_used_model", "mostUsedModel", "string"),
    ("apply_most_used_extension", "applyMostUsedExtension", "string"), ("tab_most_used_extension", "tabMostUsedExtension", "string"),
    ("accepted_lines_added", "acceptedLinesAdded", "bigint"), ("accepted_lines_deleted", "acceptedLinesDeleted", "bigint"),
    ("agent_requests", "agentRequests", "bigint"), ("api_key_reqs", "apiKeyReqs", "bigint"), ("bugbot_usages", "bugbotUsages", "bigint"),
    ("chat_requests", "chatRequests", "bigint"), ("cmdk_usages", "cmdkUsages", "bigint"), ("composer_requests", "composerRequests", "bigint"),
    ("subscription_included_reqs", "subscriptionIncludedReqs", "bigint"), ("total_accepts", "totalAccepts", "bigint"),
    ("total_applies", "totalApplies", "bigint"), ("total_lines_added", "totalLinesAdded", "bigint"),
    ("total_lines_deleted", "totalLinesDeleted", "bigint"), ("total_rejects", "totalRejects", "bigint"),
    ("total_tabs_accepted", "totalTabsAccepted", "bigint"), ("total_tabs_shown", "totalTabsShown", "bigint"),
    ("usage_based_reqs", "usageBasedReqs", "bigint"),
]


def epoch_ms(ms: Column) -> Column:
    """Milliseconds since 1970 as a zone-free timestamp."""
    return F.timestamp_add("MILLISECOND", ms, F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")))


def flatten_activity(docs: DataFrame, period: str = "period", data: str = "data") -> DataFrame:
    """One row per daily object inside the documents (C9): period bounds, raw and as timestamps, and the typed members.

    ``data`` is JSON text: an array gives a row per element, an object a row per member; NULL, a scalar, an empty
    array and text that is no JSON give none. A member that is absent or of another type is NULL, as is a whole
    element that is no object.
    """
    parsed = docs.select(F.try_parse_json(F.col(period)).alias("_p"), F.try_parse_json(F.col(data)).alias("_d"))
    rows = parsed.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("_d").outer()))
    bound = lambda name: F.try_variant_get("_p", f"$.{name}", "bigint")
    return rows.select(
        bound("startDate").alias("start_date_raw"), bound("endDate").alias("end_date_raw"),
        epoch_ms(bound("startDate")).alias("start_date"), epoch_ms(bound("endDate")).alias("end_date"),
        *[F.try_variant_get("value", f"$.{member}", kind).alias(name) for name, member, kind in ACTIVITY_FIELDS])


def newer_than_target(src: DataFrame, target: DataFrame, ts: str) -> DataFrame:
    """Incremental filter (G2): source rows newer than the target's max(ts); all rows when the
    target is empty (full refresh)."""
    mx = target.agg(F.max(ts)).scalar()          # a scalar subquery, evaluated once
    return src.filter(mx.isNull() | (F.col(ts) > mx))


def size_band(amount: Column, bounds: Sequence[tuple[float, str]], top: str) -> Column:
    """Banding by ordered upper bounds."""
    expr = None
    for hi, label in bounds:
        expr = F.when(amount < hi, label) if expr is None else expr.when(amount < hi, label)
    return expr.otherwise(top)


def null_counts(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Not-null checks (Q6): one aggregate per table (a single scan each, partial aggregation),
    unpivoted to one row per (table, column) with the table's row count and the column's NULLs."""
    parts = []
    for name, (df, cols) in tables.items():
        agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                     *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
        parts.append(agg.select(F.lit(name).alias("table_name"), "n_rows",
                                F.expr(f"stack({len(cols)}, {pairs}) AS (column_name, null_count)")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
