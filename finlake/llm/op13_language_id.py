"""Language ID with language bitmasks: bit-sliced Bloom filters over character n-grams.

Every language has a Bloom filter of its frequent n-grams; the filters of 64 languages
are stored as one table of 64-bit words, one bit per language, so that the AND
of the words at an n-gram's ``HASHES`` positions is the set of all languages that have the
n-gram, in one look. A text's masks are summed per language (bit counts). A filter
with a share f of its positions set answers yes for a foreign n-gram with probability
f ^ HASHES, so of N n-grams with c hits an expected (c - N * f^k) / (1 - f^k) are
the language's own; the language with most of them is the answer and their share of N
its score. Ties go to the smaller name.

N-grams are windows of ``SIZES`` code points of the lower-case text in which everything but
letters is one blank, also at either end; only a window's ends may be the blank.

The fit uses a bounded sample: for each language, about ``SAMPLE`` of its different texts (those
with the smallest hash), whole, from rows whose ``crc32(doc_id as text) mod 4`` is not 2. An n-gram
enters a filter if at least ``SUPPORT`` of the language's sampled texts have it, two at least.
What reaches the driver is the list of languages and the table: ``SLOTS`` words for 64 languages.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, and so is any
text where nothing was learnt; a NULL lang is not learnt from, an empty one is a language
like any other; a NULL ``doc_id`` is never learnt from and not held out; equal rows give
equal results; only ``doc_id``, ``text`` and, to learn, ``lang`` are read; an empty table
gives an empty one. Texts of any length are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import by_batch, stored

SIZES = (3, 4)
#: Positions of a filter (a power of two under 2^21), and positions an n-gram has.
SLOTS, HASHES = 1 << 18, 3
#: Different texts a language is learnt from, about.
SAMPLE = 2000
SUPPORT = 0.03
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: Code points handled at a time inside a task.
STEP = 1 << 20
_BLANK = 32
_MIX = np.uint64(0x9E3779B97F4A7C15)


@cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def plain_codes(text: str) -> np.ndarray:
    """The code points of the lower-case text, runs of anything but letters as one blank, and one at
    either end; empty where there is no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    known = letters()[codes]
    if not known.any():
        return np.zeros(0, np.uint32)
    framed = np.r_[np.uint32(_BLANK), np.where(known, codes, np.uint32(_BLANK)), np.uint32(_BLANK)]
    letter = np.r_[False, known, False]
    return framed[letter | np.r_[True, letter[:-1]]]


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each n-gram."""
    wide, found = codes.astype(np.uint64), []
    for size in SIZES:
        n = len(wide) - size + 1
        if n < 1:
            continue
        h = np.full(n, size, np.uint64)
        whole = np.ones(n, bool)
        for k in range(size):
            h = (h + wide[k : n + k]) * _MIX
            h ^= h >> np.uint64(29)
            if 0 < k < size - 1:
                whole &= codes[k : n + k] != _BLANK
        found.append(h[whole])
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def slots(hashes: np.ndarray, count: int) -> list[np.ndarray]:
    """The positions of each n-gram: fields of 21 bits of its hash."""
    return [((hashes >> np.uint64(21 * j)) & np.uint64(count - 1)).astype(np.int64) for j in range(HASHES)]


@dataclass(frozen=True)
class Filters:
    """The filters of ``langs`` (sorted): word ``i // 64`` and bit ``i % 64`` of ``table`` (words, positions) are
    language i's; ``chance`` is how often its filter answers yes for an n-gram that it does not hold."""

    langs: list[str]
    table: np.ndarray
    chance: np.ndarray

    @staticmethod
    def of(langs: list[str], table: np.ndarray) -> Filters:
        fill = [(table[i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(langs))]
        return Filters(langs, table, np.array(fill, float) ** HASHES)

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """(words, n-grams): the languages that have each n-gram, as bits."""
        found = self.table
        first, *others = slots(hashes, found.shape[1])
        out = found[:, first]
        for at in others:
            out &= found[:, at]
        return out

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Per language, the n-grams that its filter holds: the masks turned by 90 degrees, then bit counts."""
        masks = self.masks(hashes)
        bits = np.unpackbits(np.ascontiguousarray(masks.T).view(np.uint8).reshape(len(hashes), -1), axis=1, bitorder="little")
        rows = np.packbits(bits[:, : len(self.langs)], axis=0)
        return np.bitwise_count(rows).sum(0, dtype=np.int64)

    def shares(self, text: str | None) -> tuple[int, np.ndarray]:
        """The number of n-grams of a text, and per language the share of them that is its own."""
        codes = plain_codes(text or "")
        n, hits = 0, np.zeros(len(self.langs), np.int64)
        for at in range(0, len(codes), STEP):  # windows that begin in this step
            piece = codes[at : at + STEP + max(SIZES) - 1]
            hashes = gram_hashes(piece)
            if at + STEP < len(codes):  # less those that begin in the next one
                rest = gram_hashes(codes[at + STEP : at + STEP + max(SIZES) - 1])
                hits -= self.hits(rest) if len(rest) else 0
                n -= len(rest)
            if len(hashes):
                hits += self.hits(hashes)
                n += len(hashes)
        own = (hits - n * self.chance) / np.maximum(1e-12, 1 - self.chance) / max(1, n)
        return n, np.clip(own, 0.0, 1.0)


def fold() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))


def sample_rows(docs: DataFrame, sample: int) -> tuple[list[str], DataFrame]:
    """The languages, and no (a language's number), text of the sample."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold() != HELD_OUT))
    usable = usable.select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("h"))
    sizes = usable.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))  # one row per language
    found = sorted((r.lang, r.n) for r in sizes.collect())
    spark = docs.sparkSession
    rates = [(lang, no, min(1.0, sample / max(1, n))) for no, (lang, n) in enumerate(found)]
    rated = spark.createDataFrame(rates, "lang string, no int, rate double")
    part = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))
    picked = usable.join(F.broadcast(rated), "lang").where(part < F.col("rate"))  # one row per language
    return [lang for lang, _ in found], picked.groupBy("no", "h").agg(F.min("text").alias("text")).select("no", "text")


def gram_support(rows: DataFrame) -> DataFrame:
    """no, gram, n: how many of a language's texts have the n-gram."""

    def work(batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            met: dict[int, list[np.ndarray]] = {}
            for no, text in zip(part.column("no").to_pylist(), part.column("text").to_pylist()):
                met.setdefault(no, []).append(np.unique(gram_hashes(plain_codes(text))))
            for no, them in met.items():
                grams, n = np.unique(np.concatenate(them), return_counts=True)
                columns = [pa.array(np.full(len(grams), no, np.int32)), pa.array(grams.view(np.int64)), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["no", "gram", "n"])

    return by_batch(rows, work, "no int, gram long, n long").groupBy("no", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, sample: int = SAMPLE, support: float = SUPPORT, positions: int = SLOTS) -> Filters:
    langs, picked = sample_rows(docs, sample)
    words = max(1, -(-len(langs) // 64))
    table = np.zeros((words, positions), np.uint64)
    if langs:
        rows = stored(picked, "language-sample")
        texts = rows.groupBy("no").agg(F.count(F.lit(1)).alias("texts"))  # one row per language
        enough = F.greatest(F.least(F.lit(2), F.col("texts")), F.ceil(F.col("texts") * support))
        frequent = gram_support(rows).join(F.broadcast(texts), "no").where(F.col("n") >= enough)
        at = [F.shiftrightunsigned("gram", 21 * j).bitwiseAND(F.lit(positions - 1)) for j in range(HASHES)]
        bit = F.expr("shiftleft(1L, no % 64)")
        each = frequent.select(F.expr("no div 64").alias("word"), bit.alias("bit"), F.explode(F.array(*at)).alias("at"))
        set_bits = each.groupBy("word", "at").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most the table's words
        where = [set_bits.column(c).to_numpy() for c in ("word", "at", "bits")]
        table[where[0], where[1]] = where[2].astype(np.int64).view(np.uint64)
    return Filters.of(langs, table)


def language_shares(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, n_grams, lang_pred, score, shares (language -> share of the n-grams, of every text with a letter)."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch):
        n, pred, score, shares = [], [], [], []
        for text in batch.column("text").to_pylist():
            grams, own = filters.shares(text)
            known = grams and len(own)
            best = int(np.argmax(own)) if known else -1  # the first of equal ones: the smaller name
            n.append(grams)
            pred.append(filters.langs[best] if known else UNKNOWN)
            score.append(float(own[best]) if known else 0.0)
            shares.append(list(zip(filters.langs, own.tolist())) if known else [])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(pred, pa.string()),
                pa.array(score, pa.float64()), pa.array(shares, pa.map_(pa.string(), pa.float64())),
            ],
            ["doc_id", "n_grams", "lang_pred", "score", "shares"],
        )

    schema = f"doc_id {key}, n_grams long, lang_pred string, score double, shares map<string,double>"
    return by_batch(docs.select("doc_id", "text"), work, schema)


def predicted_languages(docs: DataFrame, sample: int = SAMPLE, support: float = SUPPORT) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_grams of every row, by filters learnt from the rows not held out."""
    found = language_shares(docs, train(docs, sample, support))
    held_out = F.coalesce(fold() == HELD_OUT, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "n_grams")
