"""NULL audit: one pass over the table, the columns holding NULLs, the rows."""

from conftest import plan_text
from finlake.operators import audit


def test_columns_with_nulls_and_rows(spark):
    df = spark.createDataFrame(
        [(1, None, "x"), (2, 2.0, None), (3, 3.0, "z")], "a int, b double, c string")
    assert audit.columns_with_nulls(df) == ["b", "c"]
    counts = {r.column_name: r.null_count for r in audit.null_counts(df).collect()}
    assert counts == {"a": 0, "b": 1, "c": 1}
    assert sorted(r.a for r in audit.null_rows(df, ["b", "c"]).collect()) == [1, 2]


def test_audit_is_one_pass(spark):
    df = spark.range(100).selectExpr("id", "IF(id % 7 = 0, NULL, id) AS x", "CAST(NULL AS INT) AS y")
    p = plan_text(audit.null_counts(df), "simple")
    assert p.count("Exchange") == 1  # one global aggregation for every column
