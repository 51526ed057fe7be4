"""Landing discovery, CSV reading with and without a schema, bronze partitions."""

import datetime as dt

from finlake.plans.pipeline import LakePaths, ingest_batch, stage_batch_landing, stage_event_landing
from finlake.session import run_dir
from finlake.sources import fixtures, lake, landing

RUN = dt.datetime(2024, 2, 1)


def test_discovery_and_partition_scan(spark, sf_dir):
    paths = LakePaths(run_dir(spark, "t-landing"))
    stage_batch_landing(spark, sf_dir, paths)
    # a backup file is not a table (suffix match, not substring)
    with open(paths.landing + "/notes.csv.bak", "w") as fh:  # test folders are local
        fh.write("a,b\n1,2\n")
    found = landing.discover_batch_files(spark, paths.landing)
    assert found == ["billing_monthly.csv", "customers_orgs.csv", "resources.csv",
                     "support_tickets.csv", "users.csv"]
    ingest_batch(spark, paths, RUN)
    orgs = lake.read_source_partition(spark, paths.bronze_batch, "customers_orgs.csv")
    assert set(orgs.columns) >= {"org_id", "org_name", "ingest_ts", "source_file"}
    assert orgs.select("source_file").distinct().collect()[0][0] == "customers_orgs.csv"
    assert orgs.select("ingest_ts").distinct().collect()[0][0] == RUN
    # re-running replaces the partition instead of appending to it
    n = orgs.count()
    ingest_batch(spark, paths, RUN)
    assert lake.read_source_partition(spark, paths.bronze_batch, "customers_orgs.csv").count() == n


def test_unknown_table_is_inferred(spark):
    root = run_dir(spark, "t-infer")
    spark.createDataFrame([(1, "a", 2.5)], "n int, s string, x double").write.option(
        "header", "true").csv(root + "/extra.csv")
    df = landing.read_batch_table(spark, root, "extra.csv", run_ts=RUN)
    assert dict(df.dtypes)["n"] == "int" and dict(df.dtypes)["x"] == "double"
    assert df.first().source_file == "extra.csv"


def test_columns_matched_by_name_and_bad_values_null(spark):
    root = run_dir(spark, "t-order")
    # columns in another order than the schema, one malformed date, one extra column
    rows = [("1.25", "o1", "2024-01-01", "i1", "10.5", "x", "", "2.0"),
            ("0.5", "o2", "not-a-date", "i2", "20.0", "y", "1.0", "")]
    cols = "exchange_rate_to_usd string, org_id string, month string, invoice_id string, " \
           "subtotal string, note string, credits string, taxes string"
    spark.createDataFrame(rows, cols).coalesce(1).write.option("header", "true").csv(
        root + "/billing_monthly.csv")
    df = landing.read_batch_table(spark, root, "billing_monthly.csv", run_ts=RUN)
    got = {r.invoice_id: r for r in df.collect()}
    assert got["i1"].org_id == "o1" and got["i1"].subtotal == 10.5
    assert got["i1"].exchange_rate_to_usd == 1.25 and got["i1"].month == dt.date(2024, 1, 1)
    assert got["i1"].credits is None and got["i1"].taxes == 2.0
    assert got["i2"].month is None  # malformed: NULL, the job does not fail
    assert got["i2"].note == "y"  # a column the schema does not name is kept
    assert dict(df.dtypes)["subtotal"] == "double"


def test_discovery_on_empty_landing(spark):
    root = run_dir(spark, "t-empty")
    spark.range(3).write.json(root + "/usage_events_stream")  # only stream files
    assert landing.discover_batch_files(spark, root) == []


def test_read_partitions_names_only_those_folders(spark):
    from finlake.sources import lake

    root = run_dir(spark, "t-parts") + "/t"
    df = spark.range(50).selectExpr("id", "date_add(date'2024-01-01', cast(id % 5 as int)) AS usage_date")
    lake.write_table(df, root, ["usage_date"])
    two = lake.read_partitions(spark, root, "usage_date", [dt.date(2024, 1, 2), dt.date(2024, 1, 4),
                                                           dt.date(2030, 1, 1)])
    assert {r.usage_date for r in two.select("usage_date").distinct().collect()} == {
        dt.date(2024, 1, 2), dt.date(2024, 1, 4)}
    assert all("usage_date=2024-01-02" in f or "usage_date=2024-01-04" in f for f in two.inputFiles())
    assert two.count() == 20
    assert lake.read_partitions(spark, root, "usage_date", [dt.date(2030, 1, 1)]) is None
    assert lake.read_partitions(spark, root, "usage_date", []) is None


def test_part_files_with_other_headers_are_refused(spark):
    import pytest

    root = run_dir(spark, "t-headers")
    row = [("i1", "o1", "2024-01-01", 10.0, 1.0, 2.0, 1.25)]
    cols = ["invoice_id", "org_id", "month", "subtotal", "credits", "taxes", "exchange_rate_to_usd"]
    df = spark.createDataFrame(row, cols).coalesce(1)
    df.write.option("header", "true").csv(root + "/billing_monthly.csv")
    assert landing.read_batch_table(spark, root, "billing_monthly.csv", run_ts=RUN).first().org_id == "o1"
    swapped = df.select("org_id", "invoice_id", *cols[2:])
    swapped.write.mode("append").option("header", "true").csv(root + "/billing_monthly.csv")
    with pytest.raises(Exception, match="(?i)header|schema"):
        landing.read_batch_table(spark, root, "billing_monthly.csv", run_ts=RUN).collect()


def test_range_globs_name_exactly_the_range():
    import fnmatch

    for low, high in ((0, 0), (0, 25), (7, 123), (999, 1001), (3, 2), (0, 1234)):
        globs = lake.range_globs(low, high)
        named = [i for i in range(1500) if any(fnmatch.fnmatchcase(str(i), g) for g in globs)]
        assert named == list(range(low, high + 1)) and len(globs) < 60


def test_replace_days_empties_days_that_lost_their_rows(spark):
    path = run_dir(spark, "t-days") + "/t"
    df = spark.range(10).selectExpr("id", "date_add(date'2024-01-01', cast(id % 3 as int)) AS usage_date")
    lake.replace_days(df, path, None)
    days = spark.sql("SELECT date'2024-01-01' AS usage_date UNION SELECT date'2024-01-02'")
    lake.replace_days(df.where("id = 3"), path, days)
    left = spark.read.schema(df.schema).parquet(path)
    assert sorted(r.id for r in left.collect()) == [2, 3, 5, 8]


def test_orders_are_staged_compressed_with_exact_sums_of_their_lines(spark, sf_dir):
    import glob

    from pyspark.sql import functions as F

    from finlake.plans.pipeline import LakePaths, stage_batch_landing
    from finlake.sources import fixtures

    paths = LakePaths(run_dir(spark, "t-orders"))
    stage_batch_landing(spark, sf_dir, paths)
    for name in ("billing_monthly", "support_tickets"):
        assert glob.glob(f"{paths.landing}/{name}.csv/*.csv.gz") and not glob.glob(f"{paths.landing}/{name}.csv/*.csv")
        staged = landing.read_batch_table(spark, paths.landing, f"{name}.csv", run_ts=RUN).drop("ingest_ts", "source_file")
        alone = fixtures.BUILDERS[name](spark, sf_dir).select(*staged.columns)
        assert staged.exceptAll(alone).isEmpty() and alone.exceptAll(staged).isEmpty()
    assert f"{len(glob.glob(paths.landing + '/users.csv/*.csv.gz'))}-" == landing.manifest(spark, paths.landing)["users.csv"].split("-")[0] + "-"
    cents = lambda c, t: F.col(c).cast(t)
    want = spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_orderkey").agg(
        F.sum(cents("l_extendedprice", "decimal(12,2)") * cents("l_tax", "decimal(4,2)")).cast("double").alias("taxes"))
    got = fixtures.orders_with_lines(spark, sf_dir).where("taxes IS NOT NULL").select(F.col("o_orderkey").alias("l_orderkey"), "taxes")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_staged_events_are_compressed_and_read_by_several_tasks(spark, sf_dir, monkeypatch):
    import glob

    monkeypatch.setattr(landing, "JSONL_ROWS", 400)
    paths = LakePaths(run_dir(spark, "t-jsonl"))
    stage_event_landing(spark, sf_dir, paths)
    files = glob.glob(paths.landing_stream + "/part-*")
    assert len(files) > 1 and all(f.endswith(".json.gz") for f in files)
    assert spark.read.json(paths.landing_stream).count() == fixtures.usage_events_raw(spark, sf_dir).count()
