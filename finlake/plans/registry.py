"""Every catalogue entry and its DuckDB SQL, in one place."""

from __future__ import annotations

from finlake.plans import catalog, jobs, oracle
from finlake.plans.oracle_views import with_views

def _gold_sql(tables: list[str]) -> str:
    """These marts in one shape (``jobs.GOLD_TABLES``)."""
    views = {**{name: view for name, (view, _) in oracle.MART_VIEWS.items()}, "genai_tokens_cost_daily_by_org": "mart_genai_by_org"}
    parts = []
    for name in tables:
        keys, measures = jobs.GOLD_TABLES[name]
        texts = [f"CAST({k} AS VARCHAR)" for k in keys] + ["CAST(NULL AS VARCHAR)"] * (3 - len(keys))
        nums = [f"CAST({m} AS DOUBLE)" for m in measures] + ["CAST(NULL AS DOUBLE)"] * (6 - len(measures))
        cols = [f"{x} AS key_{i}" for i, x in enumerate(texts, 1)] + [f"{x} AS measure_{i}" for i, x in enumerate(nums, 1)]
        parts.append(f"SELECT '{name}' AS table_name, {', '.join(cols)} FROM {views[name]}")
    return " UNION ALL ".join(parts)


# Events whose copies carry a time three days earlier (an id divisible by seven) count on that day.
_MOVED = "CASE WHEN CAST(event_id AS BIGINT) % 7 = 0 THEN timestamp - INTERVAL 3 DAY ELSE timestamp END"

JOB_SQL: dict[str, str] = {
    "lake_failed_and_redone": f"""
SELECT * EXCLUDE (event_count) FROM (
  SELECT org_id, service, CAST({_MOVED} AS DATE) AS usage_date,
         {oracle._xsum("cost_usd_increment")} AS daily_cost_usd, {oracle._xsum("requests")} AS total_requests,
         {oracle._xsum("cpu_hours")} AS total_cpu_hours, {oracle._xsum("storage_gb_hours")} AS total_storage_gb_hours,
         CAST(sum(genai_tokens) AS BIGINT) AS total_genai_tokens, {oracle._xsum("carbon_kg")} AS total_carbon_kg,
         count(*) AS event_count
  FROM events_clean GROUP BY ALL)
WHERE total_requests IS NOT NULL AND total_cpu_hours IS NOT NULL AND total_storage_gb_hours IS NOT NULL
""",
    "lake_compacted_bronze": """
SELECT 'usage' AS kind, org_id, service, CAST(usage_date AS VARCHAR) AS usage_date,
       CAST(daily_cost_usd AS DOUBLE) AS daily_cost_usd
FROM daily_usage
UNION ALL
SELECT 'quarantine', org_id, service, CAST(NULL AS VARCHAR), cost_usd_increment FROM events_flagged WHERE is_quarantine
""",
    "lake_full_refresh": f"SELECT *, TIMESTAMP '{jobs.RUN_TS}' AS last_updated FROM mart_org_daily",
    "lake_gold_tables": _gold_sql(list(jobs.GOLD_TABLES)),
    "lake_corrected_billing": _gold_sql(jobs.REVENUE_TABLES),
    "lake_silver_copies": """
SELECT 'customers_orgs.csv' AS source_file, org_name AS key, org_id FROM customers_orgs
UNION ALL SELECT 'resources.csv', resource_id, org_id FROM resources
UNION ALL SELECT 'billing_monthly.csv', invoice_id, org_id FROM billing_monthly
UNION ALL SELECT 'support_tickets.csv', ticket_id, org_id FROM support_tickets
UNION ALL SELECT 'users.csv', 'user-' || CAST(c_custkey AS VARCHAR), CAST(c_custkey AS VARCHAR) FROM customer
""",
    "stream_old_replays": f"""
SELECT {", ".join(catalog.EVENT_COLUMNS + catalog.FLAG_COLUMNS)} FROM events_flagged
""",
    "stream_late_aside": f"""
SELECT {", ".join(catalog.EVENT_COLUMNS)},
       CASE WHEN event_id IS NOT NULL AND timestamp < TIMESTAMP '{jobs.LATE_BEFORE}'
                 AND timestamp < (SELECT max(timestamp) FROM usage_events_raw) - INTERVAL 10 MINUTE THEN 'late'
            WHEN is_quarantine THEN 'quarantine' ELSE 'good' END AS landed
FROM events_flagged
""",
    "stream_refused": """
SELECT event_id, CAST(NULL AS VARCHAR) AS raw_line, FALSE AS is_measure_summable, TRUE AS is_quarantine
FROM usage_events_raw WHERE CAST(event_id AS BIGINT) % 50 IN (7, 9, 11) GROUP BY event_id
UNION ALL
SELECT CAST(NULL AS VARCHAR), '{"event_id": "' || event_id || '", "value": ', TRUE, TRUE
FROM usage_events_raw WHERE CAST(event_id AS BIGINT) % 50 = 13 GROUP BY event_id
""",
    "ordered_sla_evolution": "SELECT CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS place, date FROM mart_critical",
    "ordered_genai_tokens": f"""
SELECT CAST(row_number() OVER (ORDER BY usage_date) AS INTEGER) AS place, usage_date, org_id
FROM mart_genai_by_org WHERE org_id = '{catalog.LOOKUP_ORG}'
""",
    "stream_events_good": f"""
SELECT {", ".join(catalog.EVENT_COLUMNS + catalog.FLAG_COLUMNS)} FROM events_flagged
WHERE NOT is_quarantine
""",
    "stream_events_quarantine": f"""
SELECT {", ".join(catalog.EVENT_COLUMNS + catalog.FLAG_COLUMNS)} FROM events_flagged
WHERE is_quarantine
""",
    "stream_rerun_idempotent": """
SELECT is_quarantine, count(*) AS n_rows, count(DISTINCT event_id) AS n_event_ids
FROM events_flagged GROUP BY is_quarantine
""",
    "src_csv_roundtrip": "SELECT *, 'support_tickets.csv' AS source_file FROM support_tickets",
    "src_partition_scan": "SELECT *, 'billing_monthly.csv' AS source_file FROM billing_monthly",
    "serve_publish_roundtrip": "SELECT * FROM mart_org_daily",
    "stream_stamps": """
SELECT count(*) AS n_rows, count(*) AS n_day_matches, count(*) AS n_file_matches FROM events_flagged
""",
    "stream_bounded_late": f"""
SELECT {", ".join(catalog.EVENT_COLUMNS + catalog.FLAG_COLUMNS)} FROM events_flagged
WHERE event_id IS NULL OR timestamp IS NULL OR timestamp >= TIMESTAMP '{jobs.LATE_BEFORE}'
""",
    "silver_billing_written": "SELECT * FROM billing_usd",
    "silver_tickets_written": "SELECT * FROM tickets_clean",
    "lake_incremental_marts": "SELECT * FROM mart_org_daily",
    "lake_replay_and_rename": """
SELECT event_id, timestamp, usage_date, org_id,
       CASE WHEN CAST(org_id AS BIGINT) % 10 = 3 THEN org_name || ' Ltd' ELSE org_name END AS org_name, quota
FROM events_clean
""",
    "published_services_by_cum_cost_by_org": "SELECT * FROM mart_revenue_label",
    "published_critical_tickets_evolution_sla_rate_daily": "SELECT * FROM mart_critical",
    "published_revenue_by_org_month_usd": "SELECT * FROM mart_revenue_month",
    "published_genai_tokens_cost_daily": "SELECT * FROM mart_genai",
    "published_genai_tokens_cost_daily_by_org": "SELECT * FROM mart_genai_by_org",
    "published_lookup_monthly_revenue": f"""
SELECT * FROM mart_revenue_month
WHERE org_id = '{catalog.LOOKUP_ORG}' AND month(month) = {catalog.MONTHLY_MONTH}
""",
}



def queries():
    return {**catalog.queries(), **jobs.JOB_QUERIES}


#: The same lookups, on published tables: the same results.
_SAME = ("costs_daily", "top_revenue_months", "sla_evolution", "genai_tokens")


def oracle_sql() -> dict[str, str]:
    batch = oracle.oracle_sql()
    published = {f"published_lookup_{k}": batch[f"lookup_{k}"] for k in _SAME}
    return {**batch, **{k: with_views(v) for k, v in JOB_SQL.items()}, **published}
