"""Fixed values.

These must equal the values the original pipeline uses, or results differ.
They are stated here once, in their natural order, and used everywhere else.
"""

# --- Fixed values (must match the original pipeline) -----------------------

# Expected unit for each known metric; a metric not listed passes the rule.
METRIC_UNITS: dict[str, str] = {
    "requests": "count",
    "cpu_hours": "hours",
    "storage_gb_hours": "gb_hours",
}

# Metrics that become one column each in the clean events (same order).
METRIC_COLUMNS: tuple[str, ...] = ("requests", "cpu_hours", "storage_gb_hours")

# Accepted values of the schema_version column.
ACCEPTED_SCHEMA_VERSIONS: tuple[int, ...] = (1, 2)

# Version that carries carbon_kg and genai_tokens.
EXTENDED_SCHEMA_VERSION: int = 2

# Service whose events carry AI tokens.
GENAI_SERVICE: str = "genai"

# Ticket severity tracked by the SLA mart.
CRITICAL_SEVERITY: str = "critical"

# Event-time watermark of the event stream.
EVENT_WATERMARK: str = "10 minutes"

# Date formats: ingest-date partition key, and the month label of the revenue mart.
INGEST_DATE_FORMAT: str = "yyyyMMdd"
MONTH_LABEL_FORMAT: str = "yyyy-MM"

# Window of the top-services report, in days, ending on the reference date.
TOP_SERVICES_DAYS: int = 14

# ---------------------------------------------------------------------------

# Decimal type used to add money and usage measures exactly (ours, not the
# original's: it summed doubles, whose last digits depend on the order rows
# arrive in, so totals changed with the partitioning). 18 digits after the
# point hold every digit of a per-request cost and of a product of money and
# rate; a total of 1e20 or more fails the job (ANSI overflow), it is never cut.
EXACT_SUM_TYPE: str = "decimal(38,18)"

# The event columns that are summed. A value that is not finite, or of MEASURE_LIMIT or more, cannot be
# part of an exact sum; such an event goes to quarantine (a sixth rule, ours). The limit leaves
# room for 100,000 of the largest values in one sum of EXACT_SUM_TYPE.
SUMMED_MEASURES: tuple[str, ...] = ("value", "cost_usd_increment", "carbon_kg")
MEASURE_LIMIT: float = 1e15

# --- Fixed values: names of the published gold tables -----------------------
MART_ORG_DAILY_USAGE = "org_daily_usage_by_service"
MART_REVENUE_MONTH_LABEL = "services_by_cum_cost_by_org"
MART_CRITICAL_TICKETS = "critical_tickets_evolution_sla_rate_daily"
MART_REVENUE_MONTH = "revenue_by_org_month_usd"
MART_GENAI_DAILY = "genai_tokens_cost_daily"
# ---------------------------------------------------------------------------

# Ours: the GenAI mart per organisation, so the GenAI lookup can filter by org.
MART_GENAI_DAILY_BY_ORG = "genai_tokens_cost_daily_by_org"
