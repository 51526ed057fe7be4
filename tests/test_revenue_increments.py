"""Revenue marts after corrected billing: what is rewritten, and what a stopped run leaves."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from finlake.operators import changes, marts
from finlake.plans import jobs
from finlake.plans import pipeline as P
from finlake.session import run_dir
from finlake.sources import fixtures, landing

RUN = dt.datetime(2024, 2, 1)


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}


def _assert_equals_rebuild(spark, paths):
    bill = spark.read.parquet(paths.silver("billing_monthly_clean"))
    for name, mart in ((P.MART_REVENUE_MONTH, marts.revenue_by_org_month), (P.MART_REVENUE_MONTH_LABEL, marts.revenue_by_org_month_label)):
        assert _rows(spark.read.parquet(paths.gold(name)).drop(changes.PERIOD)) == _rows(mart(bill))


def _take(spark, paths, bill):
    landing.write_csv_table(bill, paths.landing, "billing_monthly.csv")
    P.ingest_batch(spark, paths, RUN)
    P.build_silver(spark, paths, RUN)


def test_digests_tell_new_gone_and_changed_groups(spark):
    cols = "org_id string, month date, subtotal_usd double, credits_usd double, taxes_usd double, exchange_rate_to_usd double"
    rows = [(o, dt.date(2024, m, 1), 1.0, None, 2.0, 1.0) for o in ("a", "b", None) for m in (1, 2, 3)] + [("a", None, 1.0, None, 2.0, 1.0)]
    periods = lambda a, b: sorted(
        r.period for r in changes.changed_periods(*(changes.group_digests(spark.createDataFrame(x, cols)) for x in (a, b))).collect()
    )
    assert periods(rows, rows[::-1]) == []
    assert periods(rows, rows[1:]) == ["2024-01"] and periods(rows[1:], rows) == ["2024-01"]
    assert periods(rows, rows + rows[1:2]) == ["2024-02"]
    assert periods(rows, [*rows[:-1], ("a", None, 1.5, None, 2.0, 1.0)]) == ["none"]
    assert periods(rows, [(o, dt.date(2024, 3, 1) if m == dt.date(2024, 1, 1) and o is None else m, *r) for o, m, *r in rows]) == ["2024-01", "2024-03"]


@pytest.fixture(scope="module")
def paths(spark, sf_dir):
    paths = P.LakePaths(run_dir(spark, "t-revenue"))
    P.stage_batch_landing(spark, sf_dir, paths)
    _take(spark, paths, jobs.other_billing(spark, sf_dir))
    P.build_marts(spark, paths)
    return paths


def test_only_changed_months_are_rewritten(spark, sf_dir, paths):
    _assert_equals_rebuild(spark, paths)
    before = _files(paths.gold(P.MART_REVENUE_MONTH))
    _take(spark, paths, jobs.other_billing(spark, sf_dir))  # the same rows again, in new files
    P.build_marts(spark, paths)
    assert _files(paths.gold(P.MART_REVENUE_MONTH)) == before
    _take(spark, paths, fixtures.billing_monthly(spark, sf_dir))
    P.build_marts(spark, paths)
    after = _files(paths.gold(P.MART_REVENUE_MONTH))
    touched = {os.path.basename(os.path.dirname(f)) for f, _ in set(before.items()) ^ set(after.items())}
    assert touched == {f"period={m}" for m in ("1998-07", "1995-01", "1995-02", "2031-01")}
    _assert_equals_rebuild(spark, paths)


def test_a_stopped_run_is_finished_whatever_billing_holds_then(spark, sf_dir, paths):
    bill = fixtures.billing_monthly(spark, sf_dir)
    for writes in range(1, 6):
        wrong = F.when(F.col("month") == dt.date(1997, writes, 1), 0.0).otherwise(F.col("taxes"))
        _take(spark, paths, bill.withColumn("taxes", wrong))
        with pytest.raises(jobs.Stopped), jobs.stopped_after(writes):
            P.build_marts(spark, paths)
        _take(spark, paths, bill)  # as before the stopped run: the digests alone would find nothing to do
        P.build_marts(spark, paths)
        _assert_equals_rebuild(spark, paths)


def test_digests_have_one_row_per_month(spark, paths):
    bill = spark.read.parquet(paths.silver("billing_monthly_clean"))
    assert changes.group_digests(bill).count() == bill.select("month").distinct().count()


def test_both_marts_come_from_one_rollup(spark, monkeypatch):
    """Rolled up once where a month has one date in every group, each on its own otherwise; the same rows either way."""
    cols = "org_id string, month date, subtotal_usd double, credits_usd double, taxes_usd double, exchange_rate_to_usd double"
    rows = [(o, dt.date(2024, m, 1), 1.1 * i, None, 2.0, 1.0) for i, o in enumerate(("a", "b", None, "a")) for m in (1, 2, 3)]
    rows += [("a", None, 1.0, None, 2.0, 1.0)]
    calls = []
    by_label = marts.revenue_by_org_month_label
    monkeypatch.setattr(marts, "revenue_by_org_month_label", lambda bill, totals=None: calls.append(totals) or by_label(bill, totals))
    for n, more in enumerate(([], [("b", dt.date(2024, 3, 9), 5.0, 1.0, None, None)])):
        paths = P.LakePaths(run_dir(spark, f"t-rollup{n}"))
        bill = spark.createDataFrame(rows + more, cols)
        bill.write.parquet(paths.silver("billing_monthly_clean"))
        tickets = "severity string, created_at date, sla_breached boolean, resolved_at timestamp"
        spark.createDataFrame([], tickets).write.parquet(paths.silver("support_tickets_clean"))
        totals = marts.revenue_totals(bill)
        assert marts.one_date_a_label(totals) is (not more)
        if not more:
            assert _rows(marts.revenue_by_org_month(bill, totals)) == _rows(marts.revenue_by_org_month(bill))
        assert _rows(by_label(bill, totals)) == _rows(by_label(bill))
        P.build_marts(spark, paths)
        assert calls[n] is not None
        for name, mart in ((P.MART_REVENUE_MONTH, marts.revenue_by_org_month), (P.MART_REVENUE_MONTH_LABEL, by_label)):
            assert _rows(spark.read.parquet(paths.gold(name)).drop(changes.PERIOD)) == _rows(mart(bill))
