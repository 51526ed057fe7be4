"""Physical plans: pushdown, pruning, partial aggregation, group limits, no Python."""

import datetime as dt

from conftest import plan_text

import __spark_entry__ as entry
from finlake.operators import lookups
from finlake.sources import serving
from finlake.session import run_dir


def test_no_python_in_any_plan(spark, sf_dir):
    qs = entry.queries()
    for name in ("silver_usage_events_clean", "mart_revenue_by_org_month", "top_services_14d",
                 "audit_null_columns", "quality_flags"):
        p = plan_text(qs[name](spark, sf_dir))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEval" not in p, name


def test_aggregations_are_partial_before_shuffle(spark, sf_dir):
    p = plan_text(entry.queries()["silver_daily_usage"](spark, sf_dir), "simple")
    assert "partial_sum" in p and "partial_min" in p
    # the rollup and the two de-duplications need only two shuffles
    assert p.count("Exchange hashpartitioning") == 2


def test_top_k_per_group_limits_before_shuffle(spark, sf_dir):
    p = plan_text(entry.queries()["top_services_14d"](spark, sf_dir), "simple")
    assert "WindowGroupLimit" in p


def test_lookup_pushes_filters_and_prunes_partitions(spark, sf_dir):
    root = run_dir(spark, "t-serving")
    mart = entry.queries()["mart_org_daily_usage_by_service"](spark, sf_dir)
    serving.publish(mart, root, "org_daily_usage_by_service")
    pub = serving.read_published(spark, root, "org_daily_usage_by_service")
    q = lookups.lookup_costs_daily(pub, "8", ["genai", "storage"], dt.date(2024, 1, 5),
                                   dt.date(2024, 1, 25))
    p = plan_text(q)
    assert "PartitionFilters: [isnotnull(usage_date" in p
    assert "PushedFilters: [IsNotNull(org_id), EqualTo(org_id,8)" in p
    full = lookups.lookup_costs_daily(mart, "8", ["genai", "storage"], dt.date(2024, 1, 5),
                                      dt.date(2024, 1, 25))
    key = ["org_id", "service", "usage_date", "daily_cost_usd", "total_genai_tokens"]
    assert sorted(map(tuple, q.select(*key).collect())) == sorted(
        map(tuple, full.select(*key).collect()))


def test_fixture_scan_reads_only_needed_columns(spark, sf_dir):
    p = plan_text(entry.queries()["mart_revenue_by_org_month"](spark, sf_dir))
    li = [line for line in p.splitlines() if "ReadSchema" in line and "l_" in line]
    assert li and all("l_shipdate" not in line and "l_partkey" not in line for line in li)
