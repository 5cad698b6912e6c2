"""DuckDB SQL of the recurring-revenue bridge, for any fact table and pair of days.

Reached another way than the operator: both days side by side by filtered
aggregates, everything per tenant by windows, the bucket from a table of rules.
"""

from __future__ import annotations

GRAIN = ("global_tenant_id", "first_layer_id", "second_layer_id", "third_layer_id", "fourth_layer_id",
         "fifth_layer_id", "item", "sku", "is_nfr")
G = ", ".join(GRAIN)
CARRIED = ("ltp_type", "registration_date", "account_master_id", "max_price")

# Bucket rules in order; NULL matches anything. Signs are of: the tenant's quantity on the first and
# second day, the line's quantity on either day, and its change. ``counts``: the change is volume.
RULES = """(VALUES
    (1, 'New',                 0,    NULL, NULL, 1,    NULL, NULL,  NULL,  NULL, 1),
    (2, 'Churn',               1,    0,    NULL, NULL, NULL, NULL,  NULL,  NULL, 1),
    (3, 'Change of Channel',   NULL, NULL, 1,    0,    NULL, true,  NULL,  NULL, 1),
    (4, 'Change of Channel',   NULL, NULL, 0,    1,    NULL, true,  NULL,  NULL, 1),
    (5, 'Upsell',              1,    NULL, NULL, NULL, 1,    NULL,  NULL,  NULL, 1),
    (6, 'Downsell',            1,    NULL, NULL, NULL, -1,   NULL,  NULL,  NULL, 1),
    (7, 'FX Impact',           NULL, NULL, NULL, NULL, 0,    NULL,  true,  true, 0),
    (8, 'No Change',           NULL, NULL, NULL, NULL, 0,    NULL,  true,  NULL, 0),
    (9, 'Billing Rate Change', NULL, NULL, NULL, NULL, NULL, NULL,  NULL,  NULL, 0)
  ) r(ord, bucket, tenant_was, tenant_is, was, is_now, change, moved, same_money, abroad, counts)"""


def pivot(fact: str, prior: str, current: str) -> str:
    """One row per grain with the measures of both days."""
    cols = []
    for source, name, factor, kind in (("billed_qty", "billed_qty", "", "BIGINT"), ("tenant_mrr", "tenant_mrr", "", "DOUBLE"),
                                       ("tenant_mrr", "tenant_arr", " * 12", "DOUBLE"),
                                       ("total_ltp_billed_qty", "total_ltp_qty", "", "BIGINT")):
        for day, when in (("prior", prior), ("current", current)):
            cols.append(f"CAST(coalesce(sum({source}) FILTER (WHERE billing_date = {when}){factor}, 0) AS {kind}) AS {name}_{day}")
    return f"SELECT {G}, {', '.join(cols)} FROM {fact} WHERE billing_date IN ({prior}, {current}) GROUP BY {G}"


def moved(fact: str, prior: str, current: str) -> str:
    """Tenant lines billed on both days whose partners are not one and the same."""
    return f"""
    SELECT global_tenant_id, item, sku, true AS channel_changed FROM {fact}
    WHERE billing_date IN ({prior}, {current}) AND global_tenant_id IS NOT NULL AND item IS NOT NULL AND sku IS NOT NULL
    GROUP BY global_tenant_id, item, sku
    HAVING bool_or(billing_date = {prior} AND first_layer_id IS NOT NULL)
       AND bool_or(billing_date = {current} AND first_layer_id IS NOT NULL) AND count(DISTINCT first_layer_id) > 1"""


def latest(table: str, date_col: str, day: str) -> str:
    return f"(SELECT * FROM {table} WHERE {date_col} <= {day} QUALIFY {date_col} = max({date_col}) OVER ())"


def _r(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), 4) AS DOUBLE)"


def bridge(fact: str, pivoted: str, flags: str, rates: str, fx: str, currency: str, prior: str, current: str) -> str:
    """The bridge rows. ``currency``: a query of (first_layer_id, currency)."""
    carried = ", ".join(f"max({c}) FILTER (WHERE billing_date = {current}) AS {c}_is, max({c}) FILTER (WHERE billing_date = {prior}) AS {c}_was"
                        for c in CARRIED)
    both = [("net_mrr_change", "tenant_mrr_current - tenant_mrr_prior"), ("net_arr_change", "tenant_arr_current - tenant_arr_prior")]
    usd = [(f"tenant_{m}_usd_{d}", f"tenant_{m}_{d} * {d}_fx_rate") for m in ("mrr", "arr") for d in ("prior", "current")]
    volume, rest = "volume", "(tenant_mrr_current - tenant_mrr_prior - volume)"
    impacts = [("volume_impact_mrr", volume), ("volume_impact_arr", f"{volume} * 12"), ("billing_rate_change_mrr", rest),
               ("billing_rate_change_arr", f"{rest} * 12"), ("volume_impact_mrr_usd", f"{volume} * prior_fx_rate"),
               ("volume_impact_arr_usd", f"{volume} * 12 * prior_fx_rate"), ("billing_rate_change_mrr_usd", f"{rest} * current_fx_rate"),
               ("billing_rate_change_arr_usd", f"{rest} * 12 * current_fx_rate"),
               ("net_mrr_change_usd", "tenant_mrr_current * current_fx_rate - tenant_mrr_prior * prior_fx_rate"),
               ("net_arr_change_usd", "tenant_arr_current * current_fx_rate - tenant_arr_prior * prior_fx_rate")]
    show = lambda pairs: ", ".join(f"{_r(x)} AS {n}" for n, x in pairs)
    plain = lambda *names: show([(n, n) for n in names])
    return f"""
    WITH about AS (
      SELECT global_tenant_id, item, sku, is_nfr, {carried} FROM {fact}
      WHERE billing_date IN ({prior}, {current}) GROUP BY ALL),
    rate AS (
      SELECT tenant_global_id AS first_layer_id, sku AS item, CAST(min(price) AS DOUBLE) AS actual_effective_rate
      FROM {latest(rates, 'snapshot_date', current)} GROUP BY ALL),
    money AS (SELECT first_layer_id, currency FROM ({currency})),
    fx_day AS (
      SELECT isocode, max(CAST(conversionrate AS DOUBLE)) FILTER (WHERE side = 0) AS was,
             max(CAST(conversionrate AS DOUBLE)) FILTER (WHERE side = 1) AS now
      FROM (SELECT 0 AS side, * FROM {latest(fx, 'startdate', prior)} UNION ALL BY NAME
            SELECT 1 AS side, * FROM {latest(fx, 'startdate', current)}) GROUP BY isocode),
    wide AS (
      SELECT v.*, sum(billed_qty_prior) OVER tenant AS tenant_qty_prior_total, sum(billed_qty_current) OVER tenant AS tenant_qty_curr_total,
             actual_effective_rate, coalesce(currency, 'USD') AS billing_currency, coalesce(channel_changed, false) AS channel_changed,
             coalesce(tenant_mrr_current / nullif(billed_qty_current, 0), tenant_mrr_prior / nullif(billed_qty_prior, 0)) AS implied_effective_rate
      FROM {pivoted} v LEFT JOIN rate USING (first_layer_id, item) LEFT JOIN money USING (first_layer_id)
      LEFT JOIN {flags} USING (global_tenant_id, item, sku) WINDOW tenant AS (PARTITION BY v.global_tenant_id)),
    ruled AS (
      SELECT w.*, coalesce(was, 1.0::DOUBLE) AS prior_fx_rate, coalesce(now, 1.0::DOUBLE) AS current_fx_rate,
             coalesce(nullif(actual_effective_rate, 0), implied_effective_rate, 0.0::DOUBLE) AS effective_rate,
             (SELECT arg_min({{'bucket': bucket, 'counts': counts}}, ord) FROM {RULES}
              WHERE coalesce(tenant_was = sign(w.tenant_qty_prior_total), true) AND coalesce(tenant_is = sign(w.tenant_qty_curr_total), true)
                AND coalesce(was = sign(w.billed_qty_prior), true) AND coalesce(is_now = sign(w.billed_qty_current), true)
                AND coalesce(change = sign(w.billed_qty_current - w.billed_qty_prior), true) AND coalesce(moved = w.channel_changed, true)
                AND coalesce(same_money = (w.tenant_mrr_current = w.tenant_mrr_prior), true)
                AND coalesce(abroad = (w.billing_currency <> 'USD'), true)) AS rule
      FROM wide w LEFT JOIN fx_day ON isocode = billing_currency),
    valued AS (
      SELECT *, rule.counts * (billed_qty_current - billed_qty_prior) * effective_rate AS volume FROM ruled
      WHERE billed_qty_prior <> 0 OR billed_qty_current <> 0 OR tenant_mrr_prior <> 0 OR tenant_mrr_current <> 0)
    SELECT {current} AS snapshot_date, {prior} AS prior_dt, {current} AS current_dt, {', '.join('v.' + c for c in GRAIN)},
           {', '.join(f'coalesce({c}_is, {c}_was) AS {c}' for c in CARRIED[:-1])},
           {_r('coalesce(max_price_is, max_price_was)')} AS max_price, billed_qty_prior, billed_qty_current,
           CAST(tenant_qty_prior_total AS BIGINT) AS tenant_qty_prior_total, CAST(tenant_qty_curr_total AS BIGINT) AS tenant_qty_curr_total,
           {plain('tenant_mrr_prior', 'tenant_mrr_current', 'tenant_arr_prior', 'tenant_arr_current')},
           total_ltp_qty_prior, total_ltp_qty_current, {plain('actual_effective_rate')}, billing_currency,
           {plain('prior_fx_rate', 'current_fx_rate')}, channel_changed,
           billed_qty_current - billed_qty_prior AS net_qty_change, {show(both)}, {show(usd)},
           {_r('(tenant_mrr_prior * current_fx_rate - tenant_mrr_prior * prior_fx_rate) * 12')} AS fx_impact_arr_usd,
           {plain('implied_effective_rate')}, rule.bucket AS arr_bucket, {plain('effective_rate')}, {show(impacts)}
    FROM valued v LEFT JOIN about a
      ON v.global_tenant_id = a.global_tenant_id AND v.item = a.item
     AND v.sku IS NOT DISTINCT FROM a.sku AND v.is_nfr IS NOT DISTINCT FROM a.is_nfr"""
