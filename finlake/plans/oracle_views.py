"""The fixture inputs as SQL views for the DuckDB oracle.

Same rows as ``finlake.sources.fixtures`` (FIXTURES.md), written in SQL that
DuckDB runs over the driver's pre-registered tables. ``with_views`` prefixes a
query with the views it names, as common table expressions.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "usage_events_raw": """
WITH e AS (SELECT event_id AS eid, ts, user_id, event_type, value AS v,
                  CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events),
b AS (SELECT *, CASE event_type WHEN 'click' THEN 'networking' WHEN 'view' THEN 'storage'
                 WHEN 'purchase' THEN 'genai' WHEN 'signup' THEN 'database' ELSE 'compute' END AS service,
             CASE k % 4 WHEN 0 THEN 'requests' WHEN 1 THEN 'cpu_hours' WHEN 2 THEN 'storage_gb_hours' ELSE 'other' END AS metric,
             CASE WHEN k = 29 THEN NULL WHEN k = 31 THEN 3 ELSE k % 2 + 1 END AS schema_version FROM e),
r AS (SELECT CASE WHEN eid % 97 = 5 THEN NULL ELSE CAST(eid AS STRING) END AS event_id,
       CASE WHEN k = 13 THEN NULL ELSE ts END AS timestamp,
       CAST(user_id AS STRING) AS org_id,
       concat('res-', CAST(user_id AS STRING), '-', service) AS resource_id,
       service,
       concat('region-', CAST(CASE WHEN k % 7 = 0 THEN (user_id + 1) % 5 ELSE user_id % 5 END AS STRING)) AS region,
       metric,
       CASE WHEN k IN (20, 18) AND eid % 2 = 0 THEN NULL WHEN eid % 4999 = 11 THEN v * 1e12 ELSE v END AS value,
       CASE WHEN k = 18 THEN NULL WHEN k = 17 THEN 'bad' WHEN metric = 'requests' THEN 'count'
            WHEN metric = 'cpu_hours' THEN 'hours' WHEN metric = 'storage_gb_hours' THEN 'gb_hours' ELSE 'unit' END AS unit,
       round(v * 0.05, 4) + CAST(eid % 100 AS DOUBLE) / 1e8 AS cost_usd_increment,
       CAST(schema_version AS INT) AS schema_version,
       round(v * 0.001, 6) AS carbon_kg,
       CAST(CASE WHEN k <> 33 THEN k * 10 END AS INT) AS genai_tokens, eid
      FROM b)
SELECT event_id, timestamp, org_id, resource_id, service, region, metric, value, unit,
       cost_usd_increment, schema_version, carbon_kg, genai_tokens FROM r
UNION ALL
SELECT event_id, timestamp, org_id, resource_id, service, region, metric, value, unit,
       cost_usd_increment, schema_version, carbon_kg, genai_tokens FROM r WHERE eid % 50 = 0
""",
    "usage_events_replayed": """
SELECT * FROM usage_events_raw
UNION ALL
SELECT event_id, timestamp + INTERVAL 1 DAY, org_id, resource_id, service, region, metric, value, unit,
       cost_usd_increment + 1, schema_version, carbon_kg, genai_tokens
FROM usage_events_raw WHERE CAST(event_id AS BIGINT) % 70 = 0
""",
    "customers_orgs": """
WITH c AS (SELECT CAST(c_custkey AS STRING) AS org_id,
                  CASE WHEN c_custkey % 41 = 7 THEN NULL ELSE c_name END AS org_name,
                  c_mktsegment AS industry, n_name AS hq_country, c_custkey
           FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT org_id, org_name, industry, hq_country FROM c
UNION ALL
SELECT org_id, org_name, concat('~', industry), hq_country FROM c WHERE c_custkey % 100 = 0
""",
    "resources": """
WITH s AS (SELECT 'networking' AS service UNION ALL SELECT 'storage'
           UNION ALL SELECT 'genai' UNION ALL SELECT 'database'),
c AS (SELECT * FROM customer WHERE c_custkey % 3 <> 0),
o AS (
SELECT c_custkey, CASE WHEN c_custkey % 29 = 11 THEN NULL
            ELSE concat('res-', CAST(c_custkey AS STRING), '-', s.service) END AS resource_id,
       CAST(c_custkey AS STRING) AS org_id,
       concat('region-', CAST(c_custkey % 5 AS STRING)) AS region,
       s.service AS service, c_acctbal AS quota
FROM c JOIN s ON TRUE)
SELECT resource_id, org_id, region, service, quota FROM o
UNION ALL
SELECT resource_id, org_id, region, service, quota + 1 FROM o WHERE c_custkey % 50 = 0
""",
    "billing_monthly": """
WITH t AS (SELECT l_orderkey,
                  CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))) AS DOUBLE) AS taxes,
                  CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) AS credits
           FROM lineitem GROUP BY l_orderkey),
o AS (SELECT CAST(o_orderkey AS STRING) AS invoice_id, CAST(o_custkey AS STRING) AS org_id,
             CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
             o_totalprice AS subtotal,
             CASE WHEN o_orderstatus = 'P' THEN NULL ELSE credits END AS credits, taxes,
             CAST(0.5 AS DOUBLE) + CAST(o_custkey % 7919 AS DOUBLE) / CAST(10000 AS DOUBLE) AS exchange_rate_to_usd, o_orderkey
      FROM orders LEFT JOIN t ON o_orderkey = l_orderkey)
SELECT invoice_id, org_id, month, subtotal, credits, taxes, exchange_rate_to_usd FROM o
UNION ALL
SELECT invoice_id, org_id, month, subtotal, credits, taxes, exchange_rate_to_usd FROM o
WHERE o_orderkey % 40 = 0
""",
    "support_tickets": """
WITH s AS (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY l_orderkey),
o AS (SELECT CASE WHEN o_orderkey % 89 = 3 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS ticket_id,
             CAST(o_custkey AS STRING) AS org_id,
             CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'high'
                  WHEN '3-MEDIUM' THEN 'medium' ELSE 'low' END AS severity,
             o_orderdate AS created_at, CASE WHEN o_orderstatus = 'F' THEN shipped END AS resolved_at,
             (o_totalprice > 250000) AS sla_breached, o_orderkey
      FROM orders LEFT JOIN s ON o_orderkey = l_orderkey)
SELECT ticket_id, org_id, severity, created_at, resolved_at, sla_breached FROM o
UNION ALL
SELECT ticket_id, org_id, severity, created_at, NULL, NOT sla_breached FROM o
WHERE o_orderkey % 60 = 0
""",
}

# Derived views the catalogue's SQL builds on, in dependency order. Each is
# written once here and referenced by name in the queries.
DERIVED: dict[str, str] = {}


def derived(name: str, sql: str) -> None:
    DERIVED[name] = sql


def _names_in(sql: str) -> set[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql))
    return {n for n in list(VIEWS) + list(DERIVED) if n in words}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of every view it (transitively) uses."""
    needed: set[str] = set()
    todo = list(_names_in(sql))
    while todo:
        n = todo.pop()
        if n in needed:
            continue
        needed.add(n)
        body = VIEWS.get(n) or DERIVED[n]
        todo.extend(_names_in(body) - needed)
    order = [n for n in list(VIEWS) + list(DERIVED) if n in needed]
    if not order:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({(VIEWS.get(n) or DERIVED[n]).strip()})" for n in order)
    return f"WITH {ctes}\n{sql.strip()}"
