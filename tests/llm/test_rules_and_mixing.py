"""Operators 7, 8, 9 and 10, the registered queries with SQL, and the pipeline."""

import datetime as dt
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from finlake.llm import op7_mixing as mixing
from finlake.llm import op8_quality_classifier as quality
from finlake.llm import op9_quality_rules as rules
from finlake.llm import op10_url_filter as urls
from finlake.llm import queries
from finlake.plans.verify import compare, duckdb_connection
from llm import brute
from llm.brute import ODD_ROWS, rows


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    found = compare(spark, name, queries.queries()[name], queries.oracle_sql()[name], sf_dir, duckdb_connection(sf_dir))
    assert found.ok, found.detail


# --- mixing -------------------------------------------------------------------


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            return target | {s: 3 * sizes[s] for s in capped}
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 50, None: 700}, {"x": 5}, {"a": 0, "b": 9}, {"é": 4, "z": 9, "Z": 30}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(df).collect()}
    want = brute_targets(sizes)
    assert found == {s: pytest.approx(t) for s, t in want.items()}


def check_mix(df, found):
    docs = df.collect()
    sizes = defaultdict(int)
    for r in docs:
        sizes[r.source] += len(brute.WORD.findall(r.text or ""))
    want = sorted((r.doc_id, len(brute.WORD.findall(r.text or "")), sizes[r.source]) for r in docs if r.doc_id is not None)
    assert sorted((r.doc_id, r.size, r.source_size) for r in found if r.doc_id is not None) == want
    assert len(found) == len(docs)
    goals = brute_targets(sizes)
    source = {r.doc_id: r.source for r in docs}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in found:
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        assert r.target == pytest.approx(goals[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
        largest[source[r.doc_id]] = max(largest[source[r.doc_id]], 2 * r.size)
    for s, t in goals.items():
        assert abs(taken[s] - t) <= largest[s] + 1


def test_mix_reaches_targets_and_reruns_agree(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet")
    found = mixing.mix_rows(docs).collect()
    check_mix(docs, found)
    again = mixing.mix_rows(docs.repartition(5)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_mix_of_a_hot_source_in_levels(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.expr("repeat('w ', int(1 + id % 37))").alias("text"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"),
    )
    check_mix(docs, mixing.mix_rows(docs).collect())


def test_mix_odd_rows(odd, none, clashing):
    assert mixing.mix_rows(none).count() == 0
    named = odd.where("doc_id is not null")
    check_mix(named, mixing.mix_rows(named).collect())
    assert rows(mixing.mix_rows(clashing)) == rows(mixing.mix_rows(odd))
    assert mixing.mix_documents(clashing).columns == clashing.columns
    times = defaultdict(int)
    for r in mixing.mix_documents(odd).collect():
        times[r.doc_id, r.text] += 1
    words = lambda text: len(brute.WORD.findall(text or ""))
    taken = defaultdict(int)
    for r in mixing.mix_rows(odd).collect():
        taken[r.doc_id, r.size] += r.copies
    found = defaultdict(int)
    for (doc_id, text), n in times.items():
        found[doc_id, words(text)] += n
    worded = lambda d: {k: n for k, n in d.items() if n and k[1]}
    assert worded(found) == worded(taken) and worded(found)


def test_mix_is_native(docs, capsys):
    mixing.mix_rows(docs).explain()
    plan = capsys.readouterr().out
    assert "Scan parquet" in plan and "Python" not in plan and "Arrow" not in plan


# --- quality --------------------------------------------------------------------


def test_quality_on_held_out_rows(spark, sf_dir):
    base = sf_dir.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.quality_scores(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    assert all(r.predicted == int(r.score >= 0.3) for r in scored)
    out = sorted((r.score, r.quality) for r in scored if r.held_out)
    ranks = [i for i, (_, q) in enumerate(out) if q == 1]
    good, bad = len(ranks), len(out) - len(ranks)
    assert (sum(ranks) - good * (good - 1) / 2) / (good * bad) > 0.96
    assert sum(r.predicted == r.quality for r in scored if r.held_out) / len(out) > 0.95


def test_quality_ignores_held_out_labels_and_other_columns(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.fold() == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    want = rows(quality.quality_scores(docs, labels))
    assert rows(quality.quality_scores(docs.withColumn("lang", F.lit("x")).withColumn("score", F.lit(1)), turned)) == want


def test_quality_odd_rows(spark, odd, none, clashing, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    empty = labels.limit(0)
    assert {r.score for r in quality.quality_scores(odd, empty).collect()} == {0.5}
    found = rows(quality.quality_scores(clashing, labels))
    assert len(found) == len(ODD_ROWS) and all(0 <= r[2] <= 1 for r in found)
    assert quality.quality_scores(none, labels).count() == 0
    assert quality.keep_good(clashing, empty).columns == clashing.columns
    assert quality.keep_good(odd, empty).count() == len(ODD_ROWS)


# --- rules ----------------------------------------------------------------------


def test_rule_counts_equal_brute_force(docs):
    for r in docs.collect():
        assert rules.text_counts(r.text) == brute.rule_counts(r.text)
    repeated = "a b c d e f g h i " * 3 + "\n\n x \n x \nx"
    assert rules.text_counts(repeated) == brute.rule_counts(repeated)


def test_rules_odd_rows(odd, none, clashing):
    found = rows(rules.quality_rules(odd).select("doc_id", *rules.COUNTS))
    assert found == sorted(((r[0], *brute.rule_counts(r[1])) for r in ODD_ROWS), key=str)
    assert rows(rules.quality_rules(clashing)) == rows(rules.quality_rules(odd))
    assert rules.quality_rules(none).count() == 0


def test_bad_hosts_take_their_documents(spark):
    good = " ".join(f"word{i}" for i in range(30))
    data = [(i, good, f"host{i % 20}") for i in range(400)] + [(1000 + i, "too short", "bad") for i in range(50)]
    data += [(2000, good, "bad"), (2001, good, None), (2002, "too short", "new")]
    found = {r.doc_id: r for r in rules.quality_rules(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()}
    assert not found[2000].base_failed and not found[2000].kept
    assert found[2001].kept and found[2001].host_rate is None
    assert found[2002].host_rate < 1 and found[0].kept


def test_host_verdicts_need_a_large_and_sure_difference(spark):
    """Rates near the pooled one, however sure, and high ones of a few documents, take no host."""
    good, bad = " ".join(f"word{i}" for i in range(30)), "too short"
    rates = {"usual": (4000, 10), "little_more": (4000, 8), "few": (3, 2), "worse": (300, 2.5)}
    data = [(i, bad if i % every < 1 else good, h) for h, (n, every) in rates.items() for i in range(n)]
    found = rules.quality_rules(spark.createDataFrame(data, "doc_id long, text string, source string"))
    hosts = {r.h for r in found.where("host_failed").select(F.round("host_rate", 6).alias("h")).distinct().collect()}
    assert len(hosts) == 1 and 0.35 < hosts.pop() < 0.45
    rejected = found.where("host_failed")
    assert rejected.count() == 300 and rejected.where("kept").count() == 0
    assert found.where("NOT host_failed AND NOT base_failed AND NOT kept").count() == 0


# --- urls -------------------------------------------------------------------------


def test_list_entries_hold_from_their_day(spark):
    day = dt.date
    entries = [("x.com", day(2024, 1, 10), True), ("x.com", day(2024, 3, 1), False), ("a.x.com", day(2024, 2, 1), False),
               ("a.x.com", day(2024, 2, 1), True), ("com", day(2024, 6, 1), True)]
    asked = [
        (1, "http://x.com/", day(2024, 1, 9), False), (2, "http://x.com/", day(2024, 1, 10), True),
        (3, "http://b.x.com/p?q", day(2024, 2, 29), True), (4, "http://x.com./", day(2024, 3, 1), False),
        (5, "https://u:p@A.X.com:80/", day(2024, 5, 5), True), (6, "http://y.com", day(2024, 6, 1), True),
        (7, "http://x.com/", day(2025, 6, 1), False), (8, None, day(2024, 6, 1), False), (9, "nothing", day(2024, 6, 1), False),
        (10, "http://x.com/", None, False), (2, "http://x.com/", day(2024, 1, 10), True), (None, "http://x.com/", day(2024, 2, 1), True),
    ]
    found = urls.filter_urls(
        spark.createDataFrame([a[:3] for a in asked], "page_id long, url string, fetch_date date"),
        spark.createDataFrame(entries, "key string, from_date date, blocked boolean"),
    )
    assert rows(found.select("page_id", "blocked")) == sorted(((a[0], a[3]) for a in asked), key=str)


def test_far_dates_and_no_captures_add_no_rows(spark):
    day = dt.date
    entries = [(f"h{i}.com", day(2024, 1, 1 + k), k % 2 == 0) for i in range(30) for k in range(5)]
    listed = spark.createDataFrame([*entries, ("z.com", day(1, 1, 1), True)], "key string, from_date date, blocked boolean")
    asked = [(1, "http://h1.com", day(9998, 12, 31)), (2, "http://h2.com", day(2, 1, 1)), (3, "http://z.com", day(9998, 1, 1))]
    captured = spark.createDataFrame(asked, "page_id long, url string, fetch_date date")
    assert {r.page_id: r.blocked for r in urls.filter_urls(captured, listed).collect()} == {1: True, 2: False, 3: True}
    assert urls.filter_urls(captured.limit(0), listed).count() == 0
    keyed = captured.select(urls.host_of(F.col("url")).alias("key"), "fetch_date")
    assert urls.as_of(keyed, urls.intervals(listed)).count() == 2
    assert urls.as_of(keyed.limit(0), urls.intervals(listed)).count() == 0


def test_urls_odd_rows(spark):
    pages = [(1, None, None), (None, "http://x.com/?a", "h"), (2, "", ""), (3, "http://x.com/#b", "h"), (3, "http://x.com/#b", "h")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({c: F.lit(c) for c in ("host", "key", "month")})
    assert urls.filter_pages(df).count() == len(pages)
    assert urls.filter_pages(df.limit(0)).count() == 0


# --- the pipeline -------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert made.columns == docs.columns
        kept[name] = (docs.collect(), made.collect())
        docs = spark.createDataFrame(made.collect(), made.schema)
    before, after = kept["exact dedup"]
    best = {r[1] for r in brute.exact([(r.doc_id, r.text) for r in before])}
    assert {r.doc_id for r in after} == best
    before, after = kept["n-gram Jaccard join"]
    found = brute.components([(r.doc_id, r.text) for r in before], 5, 80)
    assert {r.doc_id for r in after} == {c for _, _, c in found}
    before, after = kept["quality classifier"]
    assert len(after) > 0.8 * len(before)
    before, after = kept["best-fit packing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    run = corpus_pipeline.run(spark, sf_dir)
    assert rows(run) == sorted((tuple(r) for r in after), key=str)


def test_pipeline_of_odd_rows(spark, odd, none, sf_dir, tmp_path):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for name, df in (("odd", odd), ("none", none)):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert (found.count() > 0) == (name == "odd")


def test_equal_keys_are_decided_one_by_one(spark):
    """400 different texts without an id, of five words each, and a source beside them."""
    texts = [(None, f"{i} b c d e", None, "a", None) for i in range(400)]
    texts += [(i, "one two three " * 20, None, "b", None) for i in range(30)]
    found = mixing.mix_rows(spark.createDataFrame(texts, brute.SCHEMA).repartition(3)).collect()
    assert len(found) == len(texts)
    for size, most in ((5, 5), (60, 60)):
        of = [r for r in found if r["size"] == size]
        assert abs(sum(r.taken for r in of) - of[0].target) <= most


def test_long_labelled_texts_are_learnt_from_in_part(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_CHARS", 40)
    data = [(i, ("clean words here " if i % 2 else "$$$ ### ") * 30) for i in range(1, 60)] + [(3, "zz")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, quality int")
    sample = quality.training_rows(docs, labels)
    assert len(sample) == labels.where(quality.fold() != 0).count() and max(len(t) for _, _, t in sample) == 40
    assert sample == quality.training_rows(docs.repartition(7), labels)


def test_one_kind_of_label_rejects_nothing(spark, odd):
    labels = spark.createDataFrame([(i, 0) for i in range(1, 14)], "doc_id long, quality int")
    assert quality.keep_good(odd, labels).count() == odd.count()
    assert {r.score for r in quality.quality_scores(odd, labels).collect()} == {0.5}
