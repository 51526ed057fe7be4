"""Sums keep every digit, in any order, and never cut a value."""

import random

import pytest
from pyspark.sql import functions as F

from finlake.functions.measures import as_double, exact_avg, exact_sum, exact_total


def test_small_and_large_values(spark):
    tiny = spark.range(100_000).select(F.lit(4e-7).alias("v"))
    assert tiny.agg(exact_sum("v")).first()[0] == 0.04
    assert spark.createDataFrame([(1.2e-6,)], "v double").agg(exact_sum("v")).first()[0] == 1.2e-6
    large = spark.createDataFrame([(2e12,), (1e-8,), (None,)], "v double")
    assert str(large.agg(exact_total("v")).first()[0]).rstrip("0") == "2000000000000.00000001"


def test_order_does_not_matter(spark):
    values = [1e12, 0.1, -1e12, 3e-8, 0.2] * 50
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.repartition(7).agg(exact_sum("v")).first()[0] == df.coalesce(1).agg(exact_sum("v")).first()[0] == 15.0000015


def test_a_value_out_of_range_fails(spark):
    with pytest.raises(Exception, match="(?i)overflow|out.of.range"):
        spark.createDataFrame([(1e21,)], "v double").agg(exact_sum("v")).collect()


def test_mean_and_doubles(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (None,)], "v double")
    assert df.agg(exact_avg("v")).first()[0] == 1.0
    assert as_double(df.agg(exact_total("v").alias("t"))).dtypes == [("t", "double")]


def test_hundredths_equal_decimals_and_take_none_for_whole_ones(spark):
    from conftest import plan_text
    from finlake.sources.fixtures import _hundredths, _of_ten_thousandths

    random.seed(5)
    odd = [0.285, 1.005, 2.675, -0.005, -0.0, 0.1 + 0.2, 0.07, 99.995, 99.99, 1e-9, None]
    # for l_extendedprice also near the limit of its decimal
    large = [9_999_999_999.99, -9_999_999_999.99, 12345678.285, 3.3e9 + 0.005]
    for digits, values in ((4, odd[:7] + odd[8:] + [random.uniform(-99, 99) for _ in range(300)]),
                           (12, odd + large + [random.uniform(-1e9, 1e9) for _ in range(300)]),
                           (12, [random.randrange(10**11) / 100 for _ in range(300)])):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        plain = (F.col("v").cast(f"decimal({digits},2)") * F.lit(100)).cast("long")
        got = df.select(_hundredths("v", digits).alias("got"), plain.alias("want")).collect()
        assert [r.got for r in got] == [r.want for r in got]
    whole = spark.createDataFrame([(random.randrange(10**11) / 100,) for _ in range(300)], "v double")
    plan = plan_text(whole.select(_hundredths("v", 12)), "extended")
    assert "CASE WHEN" in plan and "rint" in plan.lower()
    n = [0, 1, -7, 10**15 + 3, (1 << 52) + 1, -(1 << 53) - 1, 9 * 10**18, None] + [random.randrange(-(10**16), 10**16) for _ in range(300)]
    sums = spark.createDataFrame([(v,) for v in n], "n long")
    want = (F.col("n").cast("decimal(19,0)") * F.lit(__import__("decimal").Decimal("0.0001"))).cast("double")
    got = sums.select(_of_ten_thousandths("n").alias("got"), want.alias("want")).collect()
    assert [r.got for r in got] == [r.want for r in got]
