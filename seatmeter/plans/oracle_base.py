"""DuckDB SQL for the domain adapters (the oracle side of ``seatmeter.sources.adapters``).

Each entry is (dependencies, body); ``with_ctes`` emits them in dependency
order in front of a final SELECT. The recipes repeat the adapter rules in SQL;
the fixed values are the same as in ``adapters``.
"""

from __future__ import annotations

from ..sources import adapters as A

_REG = "[" + ", ".join(f"'{c}'" for c in A.REGION_CODES) + "]"
_CUR = "[" + ", ".join(f"'{c}'" for c in A.CURRENCIES) + "]"
_PT = "[" + ", ".join(f"'{c}'" for c in A.PROFILE_TYPES) + "]"
_PLAN_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in A.PLAN_BY_EVENT.items())
_SKU_VALUES = ", ".join(f"('{s}', {A.BASE_PRICE[s]}::DOUBLE)" for s in A.PLAN_SKUS + A.ADDON_SKUS)
_TIER_VALUES = ", ".join(f"({a}, {b}, {m}::DOUBLE)" for a, b, m in A.TIERS)
_PLAN_SKU_LIST = ", ".join(f"'{s}'" for s in A.PLAN_SKUS)
_FX_VALUES = ", ".join(f"({i}, '{c}')" for i, c in enumerate(A.CURRENCIES))
AS_OF = f"DATE '{A.AS_OF.isoformat()}'"


def _num(col: str) -> str:
    return f"CAST(regexp_replace({col}, '[^0-9]', '', 'g') AS BIGINT)"


def _root(k: str) -> str:
    return f"({k} < {A.FIRST_ROOTS} OR ({k} % {A.ROOT_EVERY} = 0 AND {k} % 101 NOT BETWEEN 35 AND 40))"


_PARTNER = f"(d.user_id % 4 = 1 OR d.user_id % {A.ROOT_EVERY} = 0)"
_FLAGS = ", ".join((f"CASE WHEN d.user_id % 7 <> 1 THEN d.user_id % {d} = {r} END" if c == "link_scanning" else f"d.user_id % {d} = {r}")
                   + f" AS {c}" for c, (d, r) in A.FLAGS.items())


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "company": ((), f"""
        SELECT c.c_custkey AS id, CASE WHEN NOT {_root('c.c_custkey')} THEN c.c_custkey END AS brand_id,
               c.c_name AS name, ({_REG})[n.n_regionkey + 1] AS region
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    "brand": ((), f"""
        SELECT c_custkey AS id, up AS owner_id, 'Brand ' || up AS name
        FROM customer, LATERAL (SELECT if(c_custkey % 101 BETWEEN 35 AND 40, c_custkey - 1, c_custkey // 10) AS up)
        WHERE NOT {_root('c_custkey')}"""),
    "tree_raw": (("company", "brand"), """
        SELECT id AS tenant_id, NULL::BIGINT AS parent_id, NULL::VARCHAR AS parent_name, name AS tenant_name,
               region, substr('XXXXXXX' || CAST(id AS VARCHAR), -7) || ' ' AS tree_key, CAST(id AS VARCHAR) AS id_path, '' AS indent
        FROM company WHERE brand_id IS NULL
        UNION ALL
        SELECT c.id, b.owner_id, b.name, c.name, t.region,
               t.tree_key || substr('XXXXXXX' || CAST(c.id AS VARCHAR), -7) || ' ', t.id_path || '/' || c.id, t.indent || '-> '
        FROM brand b JOIN company c ON b.id = c.brand_id JOIN tree_raw t ON b.owner_id = t.tenant_id"""),
    "tree": (("tree_raw",), """
        SELECT *, region || '-' || split_part(split_part(tree_key, ' ', 1), 'X', -1) AS root,
               CAST(length(tree_key) - length(replace(tree_key, ' ', '')) - 1 AS INTEGER) AS depth,
               CASE WHEN length(tree_key) - length(replace(tree_key, ' ', '')) - 1 > 0
                    THEN region || '-' || split_part(split_part(tree_key, ' ', -3), 'X', -1) END AS parent_global_id,
               region || '-' || split_part(split_part(tree_key, ' ', -2), 'X', -1) AS tenant_global_id,
               indent || tenant_name AS indented_name
        FROM tree_raw"""),
    "ev_daily": ((), """
        SELECT user_id, CAST(ts AS DATE) AS record_date, count(*) AS n_events,
               count(*) FILTER (WHERE event_type = 'error') AS n_error,
               count(*) FILTER (WHERE event_type = 'view') AS n_view,
               min(event_type) AS first_type,
               bool_or(event_type = 'purchase') AS incident_management,
               bool_or(event_type = 'click') AS simulation_and_training_bundle_plus,
               bool_or(event_type = 'signup') AS ato
        FROM events GROUP BY 1, 2"""),
    "history": (("ev_daily", "tree"), f"""
        SELECT d.record_date, t.root, t.parent_global_id, t.parent_name, t.tenant_global_id, t.tenant_name,
               t.tree_key, t.id_path, t.depth,
               CASE WHEN d.user_id % 19 = 3 THEN 'SAT Suite' WHEN d.user_id % 19 = 7 THEN 'Phishing Simulation and Training'
                    WHEN d.user_id % 4 = 0 THEN '{A.FIXED_PLAN}' ELSE CASE d.first_type {_PLAN_CASE} END END AS plan_name,
               CASE d.user_id % 5 WHEN 0 THEN 'NINJIO' WHEN 3 THEN 'Habitu8' END AS premium_name,
               CAST(d.n_events * 40 + if({_PARTNER}, {A.PARTNER_SEATS}, 0) AS BIGINT) AS active_profiles,
               CAST(d.n_events * 40 + 5 + if({_PARTNER}, {A.PARTNER_SEATS}, 0) AS BIGINT) AS licensed_profiles,
               CAST(CASE WHEN d.n_error > 0 THEN d.n_error END AS BIGINT) AS shared_profiles,
               d.user_id % 13 <> 5 AS approved,
               CASE WHEN d.user_id % 11 = 4 THEN 'Inactive' WHEN d.user_id % 7 = 2 THEN 'Active-POC'
                    ELSE 'Active' END AS billing_status,
               {_PARTNER} AS partner_pricing, d.user_id % 12 = 5 AS not_nfr_partner,
               d.incident_management, d.simulation_and_training_bundle_plus, d.ato,
               d.user_id % 4 <> 0 AS dmarc_management, CAST(d.n_view AS INTEGER) AS dmarc_domains_number,
               CAST(CASE WHEN d.user_id % 4 <> 0 THEN d.user_id % 4 END AS INTEGER) AS dmarc_plan,
               DATE '2023-09-01' + CAST(d.user_id % 150 AS INTEGER) AS registration_date, {_FLAGS},
               CAST(if(d.user_id % 4 = 0, 3, list_position(['click', 'error', 'purchase', 'signup', 'view'], d.first_type)) AS INTEGER) AS plan_id,
               CASE WHEN d.user_id % 17 <> 0 THEN DATE '2024-06-01' + CAST(d.user_id % 90 AS INTEGER) END AS plan_expiry_date,
               CASE WHEN d.user_id % 9 = 0 THEN DATE '2024-02-01' + CAST(d.user_id % 30 AS INTEGER) END AS trial_plan_expiry_date
        FROM ev_daily d JOIN tree t ON d.user_id = t.tenant_id"""),
    "meta_all": ((), f"""
        SELECT s.snapshot_date,
               ({_REG})[n.n_regionkey + 1] || '-' || CAST(c.c_custkey AS VARCHAR) AS tenant_global_id,
               c.c_name AS tenant_name, DATE '2023-06-01' + CAST(c.c_custkey * 7 % 200 AS INTEGER) AS registration_date,
               'AM-' || CAST(c.c_nationkey AS VARCHAR) AS account_master_id,
               c.c_custkey <> 9 AS is_tracked, c.c_custkey % 5 <> 0 AS is_highwatermark,
               ({_CUR})[n.n_regionkey + 1] AS currency, ({_PT})[c.c_custkey % 3 + 1] AS profile_type,
               CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'disti' WHEN c.c_mktsegment = 'MACHINERY' THEN 'oem'
                    ELSE 'msp' END AS ltp_type
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
        CROSS JOIN (VALUES (DATE '2024-01-01'), ({AS_OF})) s(snapshot_date)
        WHERE {_root('c.c_custkey')}"""),
    "meta_run": (("meta_all",), f"SELECT * FROM meta_all WHERE snapshot_date = {AS_OF}"),
    "meta": (("meta_all",), f"SELECT * FROM meta_all WHERE snapshot_date = {AS_OF} AND is_tracked"),
    "pools": (("meta_run",), f"""
        SELECT m.tenant_global_id AS global_tenant_id, m.tenant_name, x.tenant_global_id AS master_tenant_id
        FROM meta_run m JOIN meta_run x ON {_num('x.tenant_global_id')} + if({_num('x.tenant_global_id')} < 10, 1, {A.ROOT_EVERY}) = {_num('m.tenant_global_id')}
        WHERE {_num('m.tenant_global_id')} % 4 = 3"""),
    "price_list": (("meta_run",), f"""
        SELECT s.snapshot_date, m.tenant_global_id, k.sku, f.is_nfr,
               CAST(t.tier_min AS INTEGER) AS tier_min, CAST(t.tier_max AS INTEGER) AS tier_max,
               CAST(ROUND(CAST(k.base * t.mult * (1.0::DOUBLE + m.n % 100 / 100.0::DOUBLE)
                    * (CASE WHEN NOT f.is_nfr THEN 1.0::DOUBLE WHEN m.n % 5 BETWEEN 1 AND 4 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END)
                    * (CASE WHEN s.snapshot_date = DATE '2024-01-01' THEN 0.95::DOUBLE ELSE 1.0::DOUBLE END)
                    * (CASE WHEN g.kind = 'promo' THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END)
                    AS DECIMAL(38,10)), 4) AS DECIMAL(18,4)) AS price,
               CASE WHEN g.kind = 'promo' AND m.n % 3 = 1 THEN DATE '2024-01-15'
                    WHEN g.kind = 'promo' THEN DATE '2023-12-01' ELSE DATE '2020-01-01' END AS start_date,
               CASE WHEN g.kind = 'promo' AND m.n % 3 = 1 THEN DATE '2024-02-15'
                    WHEN g.kind = 'promo' THEN DATE '2024-01-20' ELSE DATE '2099-12-31' END AS end_date,
               CASE WHEN g.kind = 'promo' THEN 'Promo Price' ELSE 'Standard Price' END AS price_type
        FROM (SELECT tenant_global_id, {_num('tenant_global_id')} AS n FROM meta_run) m
        CROSS JOIN (VALUES {_SKU_VALUES}) k(sku, base)
        CROSS JOIN (VALUES {_TIER_VALUES}) t(tier_min, tier_max, mult)
        CROSS JOIN (VALUES (false), (true)) f(is_nfr)
        CROSS JOIN (VALUES (DATE '2024-01-01'), ({AS_OF})) s(snapshot_date)
        CROSS JOIN (VALUES ('std'), ('promo')) g(kind)
        WHERE (g.kind = 'std' OR (k.sku = 'Email Protect' AND m.n % 3 <> 0))
          AND (NOT f.is_nfr OR k.sku IN ({_PLAN_SKU_LIST}))"""),
    "exceptions": (("tree",), f"""
        SELECT t.tenant_global_id AS tenant_id, t.tenant_name, 'USD' AS currency, 'active' AS profile_type,
               '{A.FIXED_PLAN}' AS item, 'IS-LTP-EP' AS sku, false AS partner_pricing,
               CAST(r.tier_min AS INTEGER) AS tier_min, CAST(r.rate AS DECIMAL(18,4)) AS tier_rate,
               CAST(r.tier_max AS INTEGER) AS tier_max, DATE '2024-01-01' AS start_date,
               DATE '2024-12-31' AS end_date, 'Tenant' AS tenant_msp, t.root AS parent_id
        FROM tree t CROSS JOIN (VALUES (1, 20, 0.5), (21, 999999, 0.4)) r(tier_min, tier_max, rate)
        WHERE NOT {_root('t.tenant_id')} AND t.tenant_id % 20 = 8"""),
    "commitments": (("meta_run",), f"""
        SELECT tenant_global_id, tenant_name,
               CAST(1500 + {_num('tenant_global_id')} % 10 * 1000 AS DECIMAL(18,4)) AS monthly_commitment_amount,
               DATE '2024-01-01' AS start_date, DATE '2024-12-31' AS end_date
        FROM meta_run WHERE {_num('tenant_global_id')} % 4 = 1"""),
    "fx": ((), f"""
        SELECT c.isocode,
               CAST(ROUND(CAST(1.0::DOUBLE + c.r * 0.1::DOUBLE + day(d.startdate) / 1000.0::DOUBLE
                    AS DECIMAL(38,10)), 4) AS DECIMAL(18,4)) AS conversionrate,
               d.startdate
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS startdate FROM events) d
        CROSS JOIN (VALUES {_FX_VALUES}) c(r, isocode)"""),
}


def register(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


def with_ctes(names, final: str) -> str:
    """``WITH RECURSIVE`` + the named CTEs (and their dependencies) + ``final``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in order]
    body = final.lstrip()
    if body[:5].upper() == "WITH ":  # the final query has CTEs of its own: chain them
        body = ",\n" + body[5:]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body
