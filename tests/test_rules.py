"""Quality rules, derived columns and NULL handling on hand-written rows."""

import datetime as dt

from pyspark.sql import functions as F

from finlake import schemas
from finlake.functions import rules
from finlake.operators import dedup, marts, quality, silver

T = dt.datetime(2024, 1, 2, 3, 4, 5)


def _events(spark, rows):
    base = dict(
        event_id="e", timestamp=T, org_id="o", resource_id="r", service="compute",
        region="x", metric="requests", value=1.0, unit="count", cost_usd_increment=0.5,
        schema_version=2, carbon_kg=0.1, genai_tokens=7,
    )
    data = [tuple({**base, **r}[f.name] for f in schemas.USAGE_EVENT.fields) for r in rows]
    return spark.createDataFrame(data, schemas.USAGE_EVENT)


def _flags(spark, **row):
    return quality.with_quality_flags(_events(spark, [row])).first().asDict()


def test_valid_row_passes(spark):
    f = _flags(spark)
    assert all(f[n] for n in rules.RULE_NAMES) and f["is_quarantine"] is False


def test_each_rule_fails_alone(spark):
    assert _flags(spark, event_id=None)["is_event_id_valid"] is False
    assert _flags(spark, timestamp=None)["is_valid_timestamp"] is False
    assert _flags(spark, unit=None)["is_unit_valid"] is False
    assert _flags(spark, schema_version=3)["is_schema_version_valid"] is False
    assert _flags(spark, unit="hours")["is_correct_unit"] is False


def test_undecidable_rules_quarantine(spark):
    # NULL version and NULL unit on a known metric would give a NULL verdict;
    # it must be TRUE, so the row lands in quarantine and is not lost.
    f = _flags(spark, schema_version=None)
    assert f["is_schema_version_valid"] is False and f["is_quarantine"] is True
    f = _flags(spark, value=None, unit=None)
    assert f["is_unit_valid"] is True
    assert f["is_correct_unit"] is False and f["is_quarantine"] is True


def test_unknown_metric_and_null_value(spark):
    assert _flags(spark, metric="other", unit="whatever")["is_quarantine"] is False
    assert _flags(spark, value=None)["is_quarantine"] is False


def test_good_plus_quarantine_is_input(spark):
    df = _events(spark, [dict(event_id=str(i), schema_version=i % 4) for i in range(40)]
                 + [dict(event_id=None)] * 3 + [dict(event_id="1")])
    good, bad = quality.ingest_events_split(df)
    assert good.count() + bad.count() == quality.dedup_arrivals(df).count() == 43
    assert good.join(bad, "event_id").count() == 0


def test_derived_columns(spark):
    df = _events(spark, [
        dict(event_id="a", service="genai", schema_version=2, genai_tokens=5, carbon_kg=1.5),
        dict(event_id="b", service="genai", schema_version=1, genai_tokens=5, carbon_kg=1.5),
        dict(event_id="c", service="storage", schema_version=2, genai_tokens=5),
        dict(event_id="d", service="genai", schema_version=2, genai_tokens=None),
        dict(event_id="e", metric="cpu_hours", value=None),
    ])
    rows = {r.event_id: r for r in silver.derive_event_columns(df).collect()}
    assert (rows["a"].genai_tokens, rows["a"].carbon_kg) == (5, 1.5)
    assert (rows["b"].genai_tokens, rows["b"].carbon_kg) == (0, 0.0)
    assert rows["c"].genai_tokens == 0
    assert rows["d"].genai_tokens is None
    assert rows["e"].cpu_hours is None and rows["e"].requests == 0.0
    assert rows["a"].requests == 1.0 and rows["a"].cpu_hours == 0.0
    assert rows["a"].usage_date == T.date()


def test_null_totals_and_mart_filter(spark):
    df = _events(spark, [dict(event_id="a", metric="cpu_hours", value=None),
                         dict(event_id="b", org_id="p", metric="cpu_hours", value=2.0)])
    clean = silver.derive_event_columns(df)
    daily = silver.daily_usage(clean)
    got = {r.org_id: r.total_cpu_hours for r in daily.collect()}
    assert got == {"o": None, "p": 2.0}
    assert [r.org_id for r in marts.org_daily_usage_by_service(daily).collect()] == ["p"]


def test_exact_sums_do_not_depend_on_partitioning(spark):
    vals = [0.1, 0.2, 0.3, 1e6 + 0.01, -0.7, 0.05] * 50
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    from finlake.functions.measures import exact_sum
    a = df.repartition(1).agg(exact_sum("x").alias("s")).first().s
    b = df.repartition(7).agg(exact_sum("x").alias("s")).first().s
    assert a == b == float(sum(__import__("decimal").Decimal(str(v)) for v in vals))


def test_revenue_coalesces_credits(spark):
    bill = spark.createDataFrame(
        [("1", "o", dt.date(2024, 1, 1), 10.0, None, None, 1.25),
         ("2", "o", dt.date(2024, 1, 1), 20.0, 4.0, 1.0, 1.25)],
        schemas.BILLING_MONTHLY,
    )
    usd = silver.billing_usd(bill)
    r = marts.revenue_by_org_month(usd).first()
    assert (r.revenue_usd, r.credits_usd, r.tax_usd, r.fx_applied) == (37.5, 5.0, 1.25, 1.25)
    lbl = marts.revenue_by_org_month_label(usd).first()
    assert lbl.month_and_year == "2024-01"


def test_critical_tickets(spark):
    t = spark.createDataFrame(
        [("1", "o", "critical", T, T, True), ("2", "o", "critical", T, None, False),
         ("3", "o", "low", T, None, True), ("1", "o", "critical", T, T, True),
         (None, "o", "critical", T, None, True)],
        schemas.SUPPORT_TICKETS,
    )
    r = marts.critical_tickets_sla_daily(silver.tickets_clean(t)).first()
    assert (r.breach_count, r.solved_count, r.critical_ticket_count, r.breach_rate) == (1, 1, 2, 0.5)


def test_tickets_bad_date_text_is_null(spark):
    t = spark.createDataFrame([("1", "o", "critical", "2024-13-45", None, True)],
                              "ticket_id string, org_id string, severity string, created_at string, "
                              "resolved_at timestamp, sla_breached boolean")
    assert silver.tickets_clean(t).first().created_at is None
    assert F is not None


def test_few_copies_of_tickets_are_merged_alone(spark, monkeypatch):
    rows = [(str(i % 90), "o", "critical", T, T if i % 3 else None, i % 2 == 0) for i in range(100)]
    t = spark.createDataFrame([*rows, (None, "o", "low", T, None, True)], schemas.SUPPORT_TICKETS)
    merged = []

    def seen(df, *args, **kwargs):
        merged.append(df)
        return dedup.dedup_by_key(df, *args, **kwargs)

    monkeypatch.setattr(silver, "dedup_by_key", seen)
    got, want = silver.tickets_clean(t, few=True), silver.tickets_clean(t)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert [df.count() for df in merged] == [20, 100]
