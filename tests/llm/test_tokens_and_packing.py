"""Operators 3 and 4."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from finlake.llm import op3_token_counts as counts
from finlake.llm import op4_packing as packing
from finlake.llm.tokens import PrefixCounts, TokenIds, default_path
from llm.brute import ODD_ROWS, rows

TEXTS = [
    "it's 're x'llama don't've", "Ünïcödé éle é à", "İstanbul ΣΑΣ", "<|endoftext|>x <|startoftext|>", "日本語テキスト",
    "a1b22c", "🙂👍🏽!!", " x y", " ", "", "a\x1cb \x1d", "x\xa0yéz q", "'", "''re !!'s", "é" * 300, "a\x85c", "élan",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_path())


def test_ids_and_prefixes_equal_the_library(library, docs):
    ids, prefixes = TokenIds(default_path()), PrefixCounts(default_path())
    for text in [*TEXTS, *[r.text for r in docs.limit(25).collect()]]:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids.of_text(text), "<u4").tolist() == want
        found = np.cumsum(np.frombuffer(prefixes.of_text(text), "<i2")).tolist()
        assert len(found) == len(text) and (found[-1] if found else 0) == len(want)
        for i in range(0, len(text), 1 + len(text) // 40):
            assert found[i] == len(library.encode(text[: i + 1], add_special_tokens=False).ids)


def test_prefix_counts_beyond_16_bits(library):
    table = PrefixCounts(default_path())
    word = "".join(chr(97 + i * i * 7919 % 26) for i in range(100_000)) + "日本語文" * 15_000
    want = len(library.encode(word, add_special_tokens=False).ids)
    found = np.frombuffer(table.of_text(word), "<i2")
    assert want > 40_000 and len(found) == len(word) and found.sum(dtype=np.int64) == want

    piece = "e\u0301" * 50_000  # not NFC, one word
    found = np.frombuffer(table.of_text(piece), "<i2")
    assert len(found) == 100_000 and found.sum(dtype=np.int64) == len(library.encode(piece, add_special_tokens=False).ids)


def test_prefix_counts_of_text_that_changes_in_the_normal_form(library):
    rnd = random.Random(3)
    marks = ["e\u0301", "a\u0323\u0307", "\u0301", "\u1100\u1161\u11a8", "\u09c7\u09be", "\u0f73", "\u0915\u093c"]
    others = ["\u212b", "\u212a", "\u0130", "\u03a3", "\ufb00", "ß", "日", "🙂", "1", "!", "a", "the", "ing", "'s", " ", "<|endoftext|>"]
    table = PrefixCounts(default_path())
    for _ in range(300):
        text = "".join(rnd.choice(marks if rnd.random() < 0.5 else others) for _ in range(rnd.randint(1, 14)))
        want = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]
        assert np.cumsum(np.frombuffer(table.of_text(text), "<i2")).tolist() == want, ascii(text)


def test_token_counts(library, odd, none, clashing, docs):
    for df in (docs, odd):
        want = []
        for r in df.collect():
            n = len(library.encode(r.text or "", add_special_tokens=False).ids)
            want.append((r.doc_id, len((r.text or "").encode()), n, n > 2048))
        assert rows(counts.token_counts(df)) == sorted(want, key=str)
    assert rows(counts.token_counts(clashing)) == rows(counts.token_counts(odd))
    assert counts.token_counts(none).count() == 0


def test_longest_prefixes(library, docs):
    stored = counts.prefix_token_counts(docs.limit(20))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for doc_id, n in rows(counts.longest_prefixes(stored, 50)):
        size = lambda k: len(library.encode(texts[doc_id][:k], add_special_tokens=False).ids)  # noqa: E731, B023
        assert size(n) <= 50
        assert all(size(k) > 50 for k in range(n + 1, min(n + 30, len(texts[doc_id])) + 1))


def check_pieces(df, found, library, size=2048):
    """Every piece is there, and sequences are gapless."""
    want = []
    for r in df.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), size)):
            part = np.array(ids[at : at + size], "<u4")
            want.append((r.doc_id, k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r[:5]) for r in found), key=str) == sorted(want, key=str)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences), -(-sum(r.length for r in found) // size)


def test_packing(library, docs, odd, none, clashing):
    used, least = check_pieces(docs, packing.pack_documents(docs).collect(), library)
    assert used <= least + 2
    check_pieces(odd, packing.pack_documents(odd).collect(), library)
    check_pieces(odd, packing.pack_documents(clashing).collect(), library)
    assert packing.pack_documents(none).count() == 0


@pytest.mark.parametrize("kind", ["mixed", "equal", "large", "one"])
def test_plan_uses_every_piece_once(kind):
    rnd = np.random.default_rng(4)
    h = np.zeros(257, np.int64)
    if kind == "mixed":
        np.add.at(h, np.clip(rnd.lognormal(4, 1, 20_000).astype(int), 1, 256), 1)
    elif kind == "equal":
        h[100] = 10_001
    elif kind == "large":
        h[129:] = 50
    else:
        h[1] = 1
    planned = packing.plan(h, 256)
    used = np.zeros_like(h)
    for pattern, times in planned:
        assert times > 0 and sum(pattern) <= 256
        for x in pattern:
            used[x] += times
    assert (used == h).all()
    n, least = sum(t for _, t in planned), -(-int((h * np.arange(257)).sum()) // 256)
    assert n <= {"mixed": 1.01 * least + 2, "equal": 5001, "large": h.sum(), "one": 1}[kind]


def test_short_documents_have_patterns():
    rnd = np.random.default_rng(8)
    h = np.zeros(2049, np.int64)
    np.add.at(h, np.clip(rnd.lognormal(4.5, 0.6, 30_000).astype(int), 5, 340), 1)
    found = packing.enumerate_patterns(h, 2048)
    assert len(found) > 100 and all(2016 <= sum(p) <= 2048 and len(set(p)) <= packing.PARTS + 1 for p in found)
    assert packing.fit_repeats(found, h).sum() > 0
    planned = packing.plan(h, 2048)
    assert sum(t * sum(p) for p, t in planned) == int((h * np.arange(2049)).sum())
    assert sum(t for _, t in planned) <= -(-int((h * np.arange(2049)).sum()) // 2048) + 2


def test_no_rows_are_lost(odd):
    assert {r.doc_id for r in packing.pack_documents(odd).collect()} == {r[0] for r in ODD_ROWS}
