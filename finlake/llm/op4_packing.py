"""Best-fit packing with length patterns fitted by non-negative least squares.

Documents become pieces of at most ``size`` tokens. The pieces' histogram of
lengths (at most ``size`` bins, whatever the corpus) goes to the driver, which
plans the packing on counts alone:

1. patterns of two to ``PARTS`` lengths that fill a sequence are enumerated
   from the lengths present;
2. non-negative least squares fits how often each pattern is used, so that
   together they come near the histogram;
3. the counts are rounded down and never use more pieces than there are;
4. what is left is packed by best fit, longest first, again in whole
   patterns at a time.

The plan says, for ranks of a length from..to, in which sequence and at which
offset a piece lies. Pieces get their rank within their length on Spark: rows
are numbered within (length, salt) and the salts' counts are summed, so that a
length that a third of all pieces has is numbered by many tasks.

Defined results: a NULL or empty text has no ids but the closing one, so one
piece of length 1; repeated rows are packed each; a NULL ``doc_id`` stays NULL;
only ``doc_id`` and ``text`` are read; an empty table gives an empty one.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finlake.llm.common import by_batch, partitions, stored
from finlake.llm.tokens import TokenIds, default_path, worker_table

#: Different lengths of a pattern, at most; a short one is repeated as often as it fits.
PARTS = 6
#: Partners tried per length when patterns are enumerated.
PARTNERS = 24
CLOSING = b"\0\0\0\0"


def pieces(docs: DataFrame, size: int = 2048, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    path = path or default_path()
    key = docs.schema["doc_id"].dataType

    def work(batch: pa.RecordBatch):
        table = worker_table(TokenIds, path)
        take, rows = [], []
        for i, text in enumerate(batch.column("text")):
            ids = memoryview(table.of_text(text.as_py() or "") + CLOSING)
            n = len(ids) // 4
            for k, at in enumerate(range(0, n, size)):
                part = ids[4 * at : 4 * (at + size)]
                take.append(i)
                rows.append((k, at, len(part) // 4, zlib.crc32(part)))
        piece, start, length, crc = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(take)),
                pa.array(piece, pa.int32()),
                *(pa.array(c, pa.int64()) for c in (start, length, crc)),
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )

    schema = f"doc_id {key.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return by_batch(docs.select("doc_id", "text"), work, schema)


# --- the plan, on the histogram ---------------------------------------------


def enumerate_patterns(counts: np.ndarray, size: int) -> list[tuple[int, ...]]:
    """Patterns of a few present lengths, longest first: each length with partners
    spread over what fits beside it, filled up with the longest that still fits, as often as it does."""
    present = np.flatnonzero(counts)
    found = set()
    for a in present[::-1]:
        fits = present[present <= min(a, size - a)]
        if not len(fits):
            found.add((int(a),))
            continue
        at = np.unique(np.r_[len(fits) - 1, np.linspace(0, len(fits) - 1, PARTNERS).astype(int)])
        for b in fits[at]:
            pattern, left = [int(a), int(b)], size - int(a) - int(b)
            while left and len(set(pattern)) < PARTS:
                k = int(np.searchsorted(present, left, "right")) - 1
                if k < 0:
                    break
                c = int(present[k])
                more = min(left // c, int(counts[c]) - pattern.count(c))
                if more < 1:
                    break
                pattern += [c] * more
                left -= more * c
            if size - sum(pattern) <= max(8, size // 64):
                found.add(tuple(sorted(pattern, reverse=True)))
    return sorted(found, reverse=True)


def fit_repeats(patterns: list[tuple[int, ...]], counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """x >= 0 that makes the patterns' lengths, each pattern x times, come near
    ``counts`` in the least-squares sense (accelerated projected gradient)."""
    column = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    row = np.fromiter((x for p in patterns for x in p), np.int64, len(column))
    weight = 1 / np.sqrt(np.maximum(counts, 1.0))  # a bin's error counts relative to its size
    value = weight[row]
    target = weight * counts

    def forward(x: np.ndarray) -> np.ndarray:
        return np.bincount(row, value * x[column], len(counts))

    def back(r: np.ndarray) -> np.ndarray:
        return np.bincount(column, value * r[row], len(patterns))

    v = np.ones(len(patterns))
    for _ in range(30):  # the largest eigenvalue bounds the step
        v = back(forward(v))
        bound = np.linalg.norm(v)
        v /= bound
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - back(forward(y) - target) / bound)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y = new + (before - 1) / t * (new - x)
        x = new
    return x


def best_fit(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each time the longest that still fits; a sequence found so is
    repeated as often as the counts allow. Uses up ``counts``."""
    out = []
    for a in range(size, 0, -1):
        while counts[a]:
            pattern, left = [a], size - a
            counts[a] -= 1
            used = {a: 1}
            top = min(a, left)
            while left and top:
                c = top
                while c and not counts[c]:
                    c -= 1
                if not c:
                    break
                counts[c] -= 1
                used[c] = used.get(c, 0) + 1
                pattern.append(c)
                left -= c
                top = min(c, left)
            more = min(int(counts[c]) // m for c, m in used.items())
            for c, m in used.items():
                counts[c] -= more * m
            out.append((tuple(pattern), 1 + more))
    return out


def plan(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, times) that use every piece of the histogram exactly once."""
    left = counts.astype(np.int64).copy()
    out = []
    if left[size]:
        out.append(((size,), int(left[size])))
        left[size] = 0
    patterns = enumerate_patterns(left, size)
    if patterns:
        repeats = np.floor(fit_repeats(patterns, left.astype(float)) + 1e-9).astype(np.int64)
        # most used first, so that rounding and clipping touch the small ones
        for k in np.argsort(-repeats, kind="stable"):
            if not repeats[k]:
                break
            need = np.unique(patterns[k], return_counts=True)
            times = int(min(repeats[k], (left[need[0]] // need[1]).min()))
            if times:
                left[need[0]] -= times * need[1]
                out.append((patterns[k], times))
    return out + best_fit(left, size)


def rules(planned: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first sequence, pieces per sequence, offset):
    in a sequence of the pattern, equal lengths lie side by side."""
    out, rank, sequence = [], {}, 0
    for pattern, times in planned:
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            n = pattern.count(length)
            lo = rank.get(length, 0)
            out.append((length, lo, lo + n * times, sequence, n, offset))
            rank[length] = lo + n * times
            offset += n * length
        sequence += times
    return out


# --- on Spark -----------------------------------------------------------------


def ranked(found: DataFrame, salts: int) -> DataFrame:
    """``rank``: number of a piece among those of its length, from 0."""
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    numbered = salted.withColumn("rn", F.row_number().over(inside))
    sizes = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")
    )
    return numbered.join(offsets, ["length", "salt"]).withColumn("rank", F.col("base") + F.col("rn") - 1)


def pack(found: DataFrame, size: int = 2048) -> DataFrame:
    """The pieces with sequence_id and offset."""
    spark: SparkSession = found.sparkSession
    counts = np.zeros(size + 1, np.int64)
    for r in found.groupBy("length").count().collect():  # at most ``size`` rows
        counts[r["length"]] = r["count"]
    schema = "at long, lo long, hi long, first long, n long, place long"
    # a few rules per length: bounded by the histogram's bins, not by the corpus
    table = F.broadcast(spark.createDataFrame(rules(plan(counts, size)), schema))
    placed = ranked(found, partitions(spark)).join(
        table, (F.col("length") == F.col("at")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    )
    t = F.col("rank") - F.col("lo")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.expr("(rank - lo) div n")).alias("sequence_id"),
        (F.col("place") + F.pmod(t, F.col("n")) * F.col("length")).alias("offset"),
    )


def pack_documents(docs: DataFrame, size: int = 2048, path: str | None = None) -> DataFrame:
    return pack(stored(pieces(docs, size, path), "pieces"), size)
