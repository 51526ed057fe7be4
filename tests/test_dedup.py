"""De-duplication: deterministic survivor, NULL keys, a key holding a third of rows."""

from conftest import plan_text
from finlake.operators.dedup import dedup_by_key


def test_survivor_is_smallest_in_order(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "z"), ("k", 1, "a"), ("j", 5, None)],
                               "key string, t int, v string")
    got = sorted(tuple(r) for r in dedup_by_key(df, ["key"], order_by=["t"]).collect())
    assert got == [("j", 5, None), ("k", 1, "a")]


def test_null_keys_kept_or_dropped(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("a", 2)], "key string, t int")
    assert dedup_by_key(df, ["key"]).count() == 3
    assert dedup_by_key(df, ["key"], keep_null_keys=False).count() == 1


def test_hot_key_combines_before_shuffle(spark):
    n = 30000
    df = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS key", "id AS t")
    out = dedup_by_key(df, ["key"], order_by=["t"])
    assert out.count() == 1 + (n - n // 3)
    assert out.where("key = 'hot'").first().t == 0
    plan = plan_text(out)
    assert "partial_min" in plan  # map-side combine: a hot key leaves each task as one row


def test_few_copies_equals_the_plain_form_and_shuffles_only_copies(spark, monkeypatch):
    from finlake.operators import dedup

    rows = [(str(i % 90), i % 7, None if i % 3 else 1.5) for i in range(100)] + [(None, 1, 2.0), (None, 1, 2.0), ("x", None, -0.0), ("x", None, 0.0)]
    df = spark.createDataFrame(rows, "k string, a int, b double")
    seen = []

    def one_a_key(part):
        seen.append(part)
        return dedup.dedup_by_key(part, ["k"])

    for keys, unique in ((["k"], one_a_key), (df.columns, dedup.distinct_rows)):
        for most in (dedup.MOST_REPEATED, 0):
            monkeypatch.setattr(dedup, "MOST_REPEATED", most)
            got = dedup.few_copies(df, keys, unique)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, unique(df).collect()))
        monkeypatch.undo()
    assert seen[0].count() == 24 and seen[2].count() == len(rows)  # the rows with a copy; all of them
