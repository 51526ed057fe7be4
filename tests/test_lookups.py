"""Lookups: parameters filter, None means no filter, ties are broken by key."""

import datetime as dt

from finlake.operators import lookups

D = dt.date


def _usage(spark):
    rows = [("8", "genai", D(2024, 1, 5), 1.0), ("8", "storage", D(2024, 1, 6), 2.0),
            ("8", "compute", D(2024, 1, 7), 3.0), ("9", "genai", D(2024, 1, 5), 4.0),
            ("8", "genai", D(2024, 1, 26), 5.0)]
    return spark.createDataFrame(rows, "org_id string, service string, usage_date date, daily_cost_usd double")


def test_costs_daily_filters_and_orders(spark):
    df = lookups.lookup_costs_daily(_usage(spark), "8", ["genai", "storage"], "2024-01-05", "2024-01-25")
    assert [(r.service, r.usage_date) for r in df.collect()] == [("genai", D(2024, 1, 5)), ("storage", D(2024, 1, 6))]
    assert lookups.lookup_costs_daily(_usage(spark), None, None, None, None).count() == 5


def test_top_months_ties_go_to_earlier_month(spark):
    rev = spark.createDataFrame(
        [("8", "2024-03", 10.0), ("8", "2024-01", 10.0), ("8", "2024-02", 30.0), ("9", "2024-01", 99.0)],
        "org_id string, month_and_year string, revenue_usd double")
    got = [r.month_and_year for r in lookups.lookup_top_revenue_months(rev, "8", 2).collect()]
    assert got == ["2024-02", "2024-01"]


def test_monthly_revenue_and_genai_none_means_everything(spark):
    rev = spark.createDataFrame(
        [("8", D(1995, 2, 1), 1.0), ("8", D(1995, 3, 1), 2.0), ("9", D(1995, 2, 1), 3.0)],
        "org_id string, month date, revenue_usd double")
    assert lookups.lookup_monthly_revenue(rev).count() == 3
    assert lookups.lookup_monthly_revenue(rev, "8", 1995, 2).count() == 1
    assert lookups.lookup_monthly_revenue(rev, "8", 1995).count() == 2
    g = _usage(spark).withColumnRenamed("daily_cost_usd", "total_genai_cost_usd")
    assert lookups.lookup_genai_tokens(g).count() == 5
    assert lookups.lookup_genai_tokens(g, "8", "2024-01-05", "2024-01-25").count() == 3


def test_top_services_window_and_ties(spark):
    df = _usage(spark).union(spark.createDataFrame(
        [("8", "database", D(2024, 1, 8), 3.0)],
        "org_id string, service string, usage_date date, daily_cost_usd double"))
    top = lookups.top_services(df, "2024-01-20", n=2, days=14)
    got = sorted((r.org_id, r.rank, r.service) for r in top.collect())
    # window 2024-01-07..2024-01-20: org 8 has compute 3.0 and database 3.0 (a tie,
    # broken by name); the Jan 5-6 rows of both orgs fall before the window
    assert got == [("8", 1, "compute"), ("8", 2, "database")]
    only8 = lookups.top_services(df, "2024-01-20", n=5, org="8")
    assert {r.org_id for r in only8.collect()} == {"8"}


def test_month_without_year_is_a_filter(spark):
    rev = spark.createDataFrame(
        [("8", D(1995, 2, 1), 1.0), ("8", D(1996, 2, 1), 2.0), ("8", D(1996, 3, 1), 3.0)],
        "org_id string, month date, revenue_usd double")
    assert [r.month.year for r in lookups.lookup_monthly_revenue(rev, "8", month=2).collect()] == [1995, 1996]


def test_lookups_return_rows_in_order(spark, sf_dir):
    """The order of the SLA and GenAI outputs, as a reader gets them."""
    from finlake.plans import catalog as C

    sla = [r.date for r in C.q_lookup_sla_evolution(spark, sf_dir).collect()]
    assert len(sla) > 1 and sla == sorted(sla)
    usage = C.daily(spark, sf_dir).repartition(7)
    from finlake.operators import marts

    rows = lookups.lookup_genai_tokens(marts.genai_tokens_cost_daily_by_org(usage)).collect()
    keys = [(r.usage_date, r.org_id) for r in rows]
    assert len(keys) > 1 and keys == sorted(keys)
