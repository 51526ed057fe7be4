"""Operators 1, 2, 5 and 6 against brute force."""

import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from finlake.llm import op1_suffix_dedup as suffix
from finlake.llm import op2_exact_dedup as exact
from finlake.llm import op5_ngram_join as ngram
from finlake.llm import op6_chunk_dedup as chunk
from finlake.llm.components import components
from finlake.llm.gsaca import suffix_array
from llm import brute
from llm.brute import ODD_ROWS, SCHEMA, rows

ODD = [(r[0], r[1]) for r in ODD_ROWS]


def frame(spark, pairs):
    return spark.createDataFrame([(d, t, None, None, None) for d, t in pairs], SCHEMA).repartition(4)


def passages(seed, shared=25):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(150)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage = text(60)
    out = [(i, text(rnd.randint(0, 120))) for i in range(40)]
    out += [(100 + i, f"{text(rnd.randint(1, 40))} {passage} {text(rnd.randint(1, 40))}") for i in range(shared)]
    for i in range(15):
        base = out[rnd.randrange(40)][1]
        k = rnd.randrange(max(1, len(base)))
        out.append((200 + i, base[:k] + "#" + base[k + 1 :]))
    return [*out, (300, "a" * 500), (301, "ab" * 300), (302, out[3][1]), (302, out[3][1]), (None, out[4][1])]


def test_suffix_array_of_small_alphabets():
    rnd = random.Random(1)
    for _ in range(600):
        k = rnd.choice([1, 2, 3, 9])
        text = [rnd.randrange(k) for _ in range(rnd.randint(0, 40))]
        assert suffix_array(np.array(text, int)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("size,many", [(48, 1000), (48, 4), (100, 2)])
def test_suffix_dedup_equals_brute_force(spark, size, many):
    pairs = passages(size + many)
    assert rows(suffix.suffix_dedup(frame(spark, pairs), size, many)) == brute.spans_removed(pairs, size)


def test_suffix_dedup_on_documents(docs):
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows(suffix.suffix_dedup(docs)) == brute.spans_removed(pairs, 400)


def test_suffix_dedup_odd_rows(odd, none, clashing):
    want = brute.spans_removed(ODD, 400)
    assert rows(suffix.suffix_dedup(odd)) == want
    assert rows(suffix.suffix_dedup(clashing)) == want
    assert suffix.suffix_dedup(none).count() == 0


def test_suffix_dedup_of_text_that_repeats_itself(spark):
    pairs = [(1, "ab" * 900), (2, "x" * 1300 + "unlike" + "x" * 700), (3, "abc " * 300 + "q" + "bab" * 200),
             (4, "x" * 399), (5, "0123456789" * 45 + "z" + "y" * 450), (6, "y" * 401)]
    assert rows(suffix.suffix_dedup(frame(spark, pairs))) == brute.spans_removed(pairs, 400)


def test_fragments_of_one_byte_are_few():
    body = b" " * (5 << 20) + bytes(range(65, 91)) * 40
    found = list(suffix.fragments(body, 400))
    assert len(found) < 100
    assert sum(f[3] * f[5] for f in found) == len(body) - 399  # every window, once


def test_trie_spills_and_merges():
    trie = exact.Trie()
    keys = [b"", b"a", b"ab", b"abc", b"abd", b"b", b"ab", b"", b"abc" * 500, b"abc" * 500 + b"x"]
    for i, k in enumerate(keys):
        trie.insert(k, exact.Owner(len(k), i, 1, 1))
    spilled = list(trie.spill())
    rest = list(trie.drain())
    found = {k: (o.doc_id, o.rows) for k, o in spilled + rest}
    assert {k for k, _ in spilled} == {k for k in keys if k[:1] == b"a"}
    assert len(found) == len(spilled) + len(rest) == len(set(keys))
    assert found[b"ab"] == (2, 2) and found[b""] == (0, 2)
    assert trie.bytes == 0


def test_exact_groups_with_tries_that_spill(spark):
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("ab ") for _ in range(rnd.randint(0, 9))) for _ in range(600)]
    texts += ["same beginning " * 30 + str(rnd.randrange(40)) for _ in range(200)]
    pairs = list(enumerate(texts))
    for trie_bytes in (1, 20_000, exact.TRIE_BYTES):
        assert rows(exact.exact_groups(frame(spark, pairs), trie_bytes)) == brute.exact(pairs)


def test_exact_groups_equal_brute_force(spark, odd, none, clashing):
    assert rows(exact.exact_groups(odd)) == brute.exact(ODD)
    assert rows(exact.exact_groups(clashing)) == brute.exact(ODD)
    assert exact.exact_groups(none).count() == 0
    kept = rows(exact.drop_copies(odd).select("doc_id", "text"))
    assert len(kept) == len({brute.re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in ODD})
    assert exact.drop_copies(clashing).columns == clashing.columns


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_ngram_join_equals_brute_force(spark, docs, n, percent):
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows(ngram.near_groups(docs, n, percent)) == brute.components(pairs, n, percent)


def chained(seed):
    """Near copies of one text at growing distances, and copies of copies."""
    rnd = random.Random(seed)
    words = [f"w{rnd.randrange(5000)}" for _ in range(120)]
    out = [(0, " ".join(words))]
    for i in range(1, 120):
        new = rnd.choice(out)[1].split()
        for _ in range(rnd.randint(1, 5)):
            new[rnd.randrange(len(new))] = f"v{rnd.randrange(5000)}"
        out.append((i, " ".join(new)))
    return out


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_ngram_join_in_blocks(spark, monkeypatch, n, percent):
    monkeypatch.setattr(ngram, "BLOCK_DOCS", 16)
    pairs = chained(n)
    assert rows(ngram.near_groups(frame(spark, pairs), n, percent)) == brute.components(pairs, n, percent)


def test_cells_of_linked_sets_meet():
    rnd = np.random.default_rng(5)
    for percent in (80, 90):
        for _ in range(400):
            size = int(rnd.integers(10, 400))
            a = np.unique(rnd.integers(0, 2**63, size).astype(np.uint64))
            differ = ngram.allowed(len(a), percent)
            drop = int(rnd.integers(0, differ + 1))
            b = np.r_[a[drop:], rnd.integers(0, 2**63, int(rnd.integers(0, differ - drop + 1))).astype(np.uint64)]
            b = np.unique(b)
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * (len(a) + len(b) - both):
                assert set(ngram.cells(a, percent).tolist()) & set(ngram.cells(b, percent).tolist())


def test_ngram_join_odd_rows(odd, none, clashing):
    want = brute.components(ODD, 3, 90)
    assert rows(ngram.near_groups(odd, 3, 90)) == want
    assert rows(ngram.near_groups(clashing, 3, 90)) == want
    assert ngram.near_groups(none).count() == 0
    kept = ngram.drop_near_copies(clashing)
    assert kept.columns == clashing.columns
    worded = {r[2] for r in brute.components([p for p in ODD if p[0] is not None], 5, 80) if r[1]}
    assert {r.doc_id for r in kept.where(F.col("text").rlike("[a-z]")).collect()} == worded


@pytest.mark.parametrize("percent", [50, 60, 69, 70])
def test_ngram_join_at_low_similarity(spark, percent):
    rnd = random.Random(percent)
    texts = [" ".join(rnd.choice("abcdef") for _ in range(rnd.randint(1, 12))) for _ in range(120)]
    data = list(enumerate(texts))
    found = ngram.near_groups(frame(spark, data), n=2, percent=percent)
    assert rows(found.select("doc_id", "n_shingles", "component_id")) == brute.components(data, 2, percent)


def test_components(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rnd.randrange(50), 100 + rnd.randrange(50)) for _ in range(60)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(61))
    assert all(found[a] == found[b] for a, b in edges if a != b)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_chunks_cover_and_resist_shifts():
    rnd = random.Random(2)
    body = bytes(rnd.randrange(97, 123) for _ in range(20_000))
    ends = chunk.cuts(body)
    assert ends[-1] == len(body) and np.diff(ends, prepend=0).min() > 0
    moved = chunk.cuts(b"inserted here" + body)
    pieces = lambda b, e: {b[i:j] for i, j in zip([0, *e[:-1]], e)}
    assert len(pieces(body, ends) - pieces(b"inserted here" + body, moved)) <= 2
    assert np.diff(chunk.cuts(b"a" * 5000), prepend=0).max() <= chunk.MOST
    assert len(chunk.cuts(b"")) == 0


def test_chunk_dedup_catches_passages_and_leaves_others(spark):
    rnd = random.Random(9)
    text = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    passage = text(80)
    clean = [(i, text(150)) for i in range(30)]
    holding = [(100 + i, f"{text(50)} {passage} {text(50)}") for i in range(10)]
    found = {r.doc_id: r for r in chunk.chunk_dedup(frame(spark, clean + holding)).collect()}
    assert all(found[i].n_repeated == 0 for i, _ in clean)
    assert all(found[i].n_repeated > 300 for i, _ in holding)
    assert found[100].n_removed == 0
    assert all(100 in found[i].owner_ids and found[i].n_removed > 300 for i, _ in holding[1:])
    kept = chunk.without_spans(frame(spark, holding), chunk.chunk_dedup(frame(spark, holding)))
    sizes = {r.doc_id: len(r.kept) for r in kept.collect()}
    assert all(sizes[i] == len(t.encode()) - found[i].n_removed for i, t in holding)


def test_chunk_dedup_finds_short_passages_whole(spark):
    rnd = random.Random(11)
    pairs, true = [], {}
    for k in range(40):  # 51 words each, the first 20 passages of the shortest words
        word = lambda most: "".join(rnd.choice(string.ascii_lowercase) for _ in range(rnd.randint(1, most)))
        passage = " ".join(word(1 if k < 20 else 9) for _ in range(51))
        for i in (2 * k, 2 * k + 1):
            before, after = (" ".join(word(9) for _ in range(rnd.randint(5, 60))) for _ in range(2))
            edge = "<>"[i % 2]  # the texts differ right beside the passage
            pairs.append((i, f"{before}{edge}{passage}{edge}{after}"))
            true[i] = (len(before) + 1, len(before) + 1 + len(passage))
    found = {r.doc_id: r for r in chunk.chunk_dedup(frame(spark, pairs)).collect()}
    for i, (start, end) in true.items():
        assert found[i].n_repeated == end - start
        assert [tuple(s) for s in found[i].spans] == ([(start, end)] if i % 2 else [])
        assert found[i].owner_ids == ([i - 1] if i % 2 else [])


def repeated_bytes(texts, least):
    """Per text, a mask of the bytes in strings of ``least`` bytes that also start elsewhere in ``texts``."""
    places = {}
    for i, text in enumerate(texts):
        for at in range(len(text) - least + 1):
            places.setdefault(text[at : at + least], []).append((i, at))
    masks = [np.zeros(len(t), bool) for t in texts]
    for met in places.values():
        for i, at in met if len(met) > 1 else ():
            masks[i][at : at + least] = True
    return masks


def test_chunk_dedup_against_all_repeated_strings(docs):
    """On the documents table: of the bytes in repeated strings, at least 99.5% are found, in every document that has
    any, and no document without one has more than a few bytes removed."""
    held = docs.select("doc_id", "text").orderBy("doc_id").collect()
    true = dict(zip((r.doc_id for r in held), repeated_bytes([(r.text or "").encode() for r in held], chunk.MIN_RUN)))
    found = {r.doc_id: r for r in chunk.chunk_dedup(docs).collect()}
    total = sum(int(m.sum()) for m in true.values())
    caught = sum(min(found[i].n_repeated, int(m.sum())) for i, m in true.items())
    assert total > 0 and caught >= 0.995 * total
    assert all(found[i].n_repeated > 0 for i, m in true.items() if m.any())
    gone = np.array([(found[i].n_removed, sum(int(m[s.start : s.end].sum()) for s in found[i].spans)) for i, m in true.items()])
    removed, rightly = gone.sum(axis=0)
    print(f"{total} bytes in repeats, {caught} found, {removed} removed, {removed - rightly} of them in no repeat")
    assert 0 < removed and removed - rightly <= 0.005 * removed


def test_digests_met_in_other_batches(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(0, 400))) for _ in range(60)]
    pairs = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t[5:]) for i, t in enumerate(texts[:20])]
    packs = chunk.chunked(frame(spark, pairs)).cache()
    assert packs.count() > 1
    covers = [t.encode()[e - chunk.COVER : e] for _, t in pairs for e in chunk.cuts(t.encode()) if e >= chunk.COVER]
    more = sorted(c for c in covers if covers.count(c) > 1)
    met = chunk.met_chunks(packs).collect()
    by_id = dict(pairs)
    assert sorted(by_id[r.doc_id].encode()[r.end - chunk.COVER : r.end] for r in met) == more


def test_chunk_dedup_odd_rows(odd, none, clashing):
    found = rows(chunk.chunk_dedup(odd).select("doc_id", "n_bytes", "n_chunks", "n_repeated", "n_removed"))
    assert len(found) == len(ODD)
    assert rows(chunk.chunk_dedup(clashing).select("doc_id", "n_bytes", "n_chunks", "n_repeated", "n_removed")) == found
    assert chunk.chunk_dedup(none).count() == 0
    by_id = {r[0]: r for r in found}
    assert by_id[1][1:] == (0, 0, 0, 0) and by_id[2][1:] == (0, 0, 0, 0)
    assert by_id[8][4] > by_id[7][4] and by_id[10][4] > 50_000
