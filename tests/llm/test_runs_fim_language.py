"""Operators 11 to 13: periodic runs, fill-in-middle, language ID."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from finlake.llm import op11_periodic_runs as runs
from finlake.llm import op12_fill_in_middle as fim
from finlake.llm import op13_language_id as lang
from llm.brute import ODD_ROWS, SCHEMA, WORD, rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- periodic runs


def brute_runs(words, least):
    """Every maximal repetition, straight from the definition."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            inside = any(s <= start and start + length <= s + m and q % p == 0 for s, m, p in found)
            if length >= max(least, 2 * q) and not inside:
                found.append((start, length, q))
    return sorted((r for r in found if r[1] >= max(least, 2 * r[2])), key=lambda r: (r[0], r[2]))


def brute_digests(doc_id, text, least=12):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words, least)
    gone = {k for s, m, q in found for k in range(s + q, s + m)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_runs_equal_the_definition_on_random_words():
    random.seed(11)
    for _ in range(400):
        n, k = random.randint(0, 50), random.choice([1, 2, 2, 3, 5])
        words = [random.randrange(k) for _ in range(n)]
        least = random.choice([2, 3, 4, 7, 12])
        assert runs.runs_of(np.array(words, np.int64), least) == brute_runs(words, least)


def test_long_stretches_of_one_period_stay_fast():
    for period in (1, 3, 40_000):
        ids = np.arange(120_000) % period
        assert runs.runs_of(ids) == [(0, 120_000, period)]


def digests(df):
    return runs.run_digests(runs.periodic_runs(runs.with_planted_periods(df)))


PERIODIC = [
    (100, "a b c " * 9 + "x y", "en", "a", 1),
    (101, "alpha\tbeta\n" * 6 + "gamma " + "alpha beta " * 7, "en", "a", 1),
    (102, "no " * 11, "en", "a", 1),
    (103, "no " * 12, "en", "a", 1),
    (104, "x" * 70_000 + " " + "y " * 30, "en", "a", 1),
    (105, "a a b a a b a a b a a b a a b a a c", "en", "a", 1),
]


def test_digests_equal_the_definition(spark, clashing):
    planted = [(i, " ".join(f"w{k * i % 83}" for k in range(150)), "en", "a", 1) for i in range(200, 320)]
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in planted) >= 5
    small = [r for r in [*PERIODIC, *planted, *ODD_ROWS] if len(r[1] or "") < 80_000]
    want = sorted((brute_digests(r[0], r[1]) for r in small), key=str)
    assert rows(digests(spark.createDataFrame(small, SCHEMA).repartition(3))) == want
    assert {tuple(r)[1:] for r in digests(clashing).where("doc_id = 8").collect()} == {brute_digests(8, ODD_ROWS[10][1])[1:]}


def test_runs_of_no_rows(none):
    assert digests(none).count() == 0


def test_documents_do_not_meet_and_text_is_collapsed(spark):
    text = "one two three four five six seven"
    both = spark.createDataFrame([(1, text), (2, text), (3, f"{text} " * 2)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in runs.periodic_runs(both).collect()}
    assert not got[1].runs and not got[2].runs
    assert [tuple(r) for r in got[3].runs] == [(0, 14, 7)] and got[3].collapsed == text


# ---------------------------------------------------------------- fill in the middle


def brute_fim(doc_id, text):
    text = text or ""
    digest = sha(f"7:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    spm = h4 % 100 < 50
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, n, "spm" if spm else "psm", len(p), len(m), sha(out), sha(text))


MARKED = [
    (300, "a\n<P>b\nc", "en", "a", 1), (301, "tail <", "en", "a", 1), (302, "<S\n<\nP>", "en", "a", 1),
    (303, "\n\n\n", "en", "a", 1), (304, "é\n日本\n🙂\nß", "en", "a", 1), (305, "no end\nof line", "en", "a", 1),
    (306, "<M>", "en", "a", 1), (307, "\r\nx\r\n", "en", "a", 1), (308, "line\n" * 30_000, "en", "a", 1),
]


def test_fill_in_middle_equals_the_definition(spark, clashing):
    more = [(i, "\n".join(f"{'é' * (k % 4)}{k * i % 97}" for k in range(i % 23)), "en", "a", 1) for i in range(400, 520)]
    them = [*MARKED, *more, *ODD_ROWS]
    got = rows(fim.fim_digests(spark.createDataFrame(them, SCHEMA).repartition(3)))
    assert got == sorted((brute_fim(r[0], r[1]) for r in them), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert rows(fim.fim_digests(clashing)) == sorted((brute_fim(r[0], r[1]) for r in ODD_ROWS), key=str)


def test_fill_in_middle_of_no_rows(none):
    assert fim.fim_digests(none).count() == 0


def test_fill_in_middle_equals_its_sql(spark, sf_dir, docs):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    assert rows(fim.fim_digests(docs)) == sorted(db.execute(fim.SQL).fetchall(), key=str)


def test_whole_texts_come_back_by_code_points_and_shares(spark):
    them = [(i, "é日a🙂\n" * (i % 9) + "z" * (i % 7)) for i in range(300)]
    df = spark.createDataFrame(them, "doc_id long, text string")
    made = fim.fill_in_middle(df, seed=3, fim_percent=60, spm_percent=20, unit="char")
    got = {r.doc_id: r for r in made.withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()}
    assert all(got[i].again == t and got[i].n == len(t) for i, t in them)
    forms = [r.form for r in got.values()]
    assert forms.count("plain") > 90 and forms.count("psm") > forms.count("spm") > 10
    with pytest.raises(ValueError):
        fim.fill_in_middle(df, unit="word")


def test_rank_and_select_agree_with_bytes():
    random.seed(5)
    for _ in range(200):
        data = bytes(random.choice(b"\n\x0b\x8a ab\xff") for _ in range(random.randint(0, 70)))
        words = np.zeros(len(data) // 8 + 1, "<u8")
        words.view(np.uint8)[: len(data)] = np.frombuffer(data, np.uint8)
        marks = fim.Marks(fim.newlines(words))
        at = [i for i, x in enumerate(data) if x == 10]
        assert marks.select(np.arange(len(at))).tolist() == at
        assert marks.rank(np.arange(len(data) + 1)).tolist() == [data[:i].count(10) for i in range(len(data) + 1)]


# ---------------------------------------------------------------- language ID


def test_held_out_accuracy(docs):
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = lang.predicted_languages(docs).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert len(held) > 30 and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_held_out_labels_and_sources_change_nothing(spark, docs):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    other = docs.withColumn("lang", F.when(held_out, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    assert rows(lang.predicted_languages(docs)) == rows(lang.predicted_languages(other))


def test_odd_rows_and_undetermined_texts(spark, clashing, none):
    got = rows(lang.predicted_languages(clashing))
    assert len(got) == len(ODD_ROWS)
    by_id = {r[0]: r for r in got}
    assert by_id[1][2] == by_id[2][2] == by_id[3][2] == "und" and by_id[2][3] == 0
    assert {r[2] for r in got} <= {"en", "fr", "und"} and by_id[None][1] is False
    assert lang.predicted_languages(none).count() == 0
    unlabelled = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in lang.predicted_languages(unlabelled).collect()] == [("und", 0.0)]
    digits = spark.createDataFrame([(1, "ein Wort", "de"), (2, "12 + 3 = 15!", "en")], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in lang.predicted_languages(digits).collect()}[2] == "und"


def filters_of(sets, positions):
    table = np.zeros((-(-len(sets) // 64), positions), np.uint64)
    for i, grams in enumerate(sets):
        for at in lang.slots(np.array(sorted(grams), np.uint64), positions):
            np.bitwise_or.at(table[i // 64], at, np.uint64(1) << np.uint64(i % 64))
    return lang.Filters.of([f"l{i:03}" for i in range(len(sets))], table)


def test_filters_miss_nothing_and_hits_are_corrected():
    rng = np.random.default_rng(7)
    grams = rng.integers(0, 2**64, 9000, np.uint64)
    sets = [set(rng.choice(grams, 2000, replace=False).tolist()) for _ in range(70)]  # more than one word of bits
    filters = filters_of(sets, 1 << 13)  # small: many false positives
    asked = rng.choice(grams, 4000)
    exact = np.array([sum(g in s for g in asked.tolist()) for s in sets])
    hits = filters.hits(asked)
    assert (hits >= exact).all() and hits.mean() > 1.2 * exact.mean()
    own = (hits - len(asked) * filters.chance) / (1 - filters.chance)
    assert np.abs(own - exact).mean() < 0.1 * exact.mean()


def test_steps_of_a_long_text_count_each_gram_once(monkeypatch):
    text = "Ein langer Text, der in Schritten gelesen wird. " * 40
    filters = filters_of([set(lang.gram_hashes(lang.plain_codes("der Text wird gelesen")).tolist()), set()], 1 << 12)
    whole = filters.shares(text)
    monkeypatch.setattr(lang, "STEP", 17)
    again = filters.shares(text)
    assert whole[0] == again[0] and np.allclose(whole[1], again[1])


def test_more_than_64_languages_and_sampling(spark):
    rng = random.Random(3)
    syllables = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) for _ in range(2000)]
    data = []
    for k in range(70):
        own = rng.sample(syllables, 40)
        data += [(k * 100 + i, " ".join(rng.choice(own) + rng.choice(own) for _ in range(60)), f"l{k:02}") for i in range(30)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    truth = {d: x for d, _, x in data}
    got = [r for r in lang.predicted_languages(df, sample=15).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) > 0.95 * len(got)
