"""Repeated byte strings of a corpus, found in suffix arrays of aligned pieces.

Remove each byte that a string of ``size`` bytes covers which also starts
anywhere else. No machine holds the corpus, so the suffixes are dealt first:

1. Every window of ``size`` bytes has an anchor: the place of its smallest
   hash of ``GRAM`` bytes (the leftmost, if several). Equal windows have equal
   anchors, so windows are dealt by the content of their anchor. The windows
   of a text that share an anchor are neighbours and make one fragment.
2. Equal texts, then equal fragments, are counted before anything moves; a
   fragment that a third of all rows have is one row with a weight. Fragments
   whose anchor occurs once cannot repeat and are left out.
3. Tasks take the fragments of some anchors, cut them into 8-byte blocks
   aligned at the anchor, and sort the suffixes of the blocks by linear
   grouping (``gsaca``). Suffixes that agree in the blocks of a window are
   neighbours in that order; an exact comparison of the up to seven bytes
   before the first and after the last whole block decides which windows are equal.
   Windows of weight two or more repeat.
4. An anchor with more than ``MANY`` different fragments is split: its windows
   are dealt anew by how far their start lies before the anchor, in ranges of 64, 16, 4 and 1
   bytes, and by what all windows of such a range have in common, until
   groups are small. Parts that are equal meet in one.

What repeats goes back to the texts as intervals, and the union of a text's
intervals is cut out.

Defined results: a NULL text counts as empty; a text shorter than ``size`` loses
nothing; repeated rows repeat each other, so all their windows go; a NULL
``doc_id`` stays NULL; only ``doc_id`` and ``text`` are read; an empty table
gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import by_batch, stored, text_bytes
from finlake.llm.gsaca import suffix_array

#: Bytes that are hashed to choose an anchor.
GRAM = 32
#: Bytes of a block, the symbol of the suffix arrays.
BLOCK = 8
#: Bytes of fragments sorted at a time.
BATCH = 256 << 10
#: Different fragments of an anchor that are sorted together at most.
MANY = 1000
#: Windows of a text handled at a time; places fit into the low bits of a hash.
STEP = 4 << 20
_LOW = np.uint64((1 << 24) - 1)
_K = np.uint64(0x9E3779B97F4A7C15)
_BYTES = (np.arange(1, 257, dtype=np.uint64) * _K) ^ (np.arange(1, 257, dtype=np.uint64) << np.uint64(40))


def gram_hash(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on."""
    h = _BYTES[data]
    width = 1
    while width < GRAM:
        x = h[:-width] * _K
        x ^= x >> np.uint64(29)
        x += h[width:]
        h = x
        width *= 2
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``width`` values from each place on."""
    have = 1
    while 2 * have <= width:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    rest = width - have
    return np.minimum(v[:-rest], v[rest:]) if rest else v


def fragments(body: bytes, size: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(key, digest, start, count, at, times): ``count`` windows from ``start`` on share the anchor
    ``at`` bytes further, whose content the key stands for. Equal neighbours (text that repeats itself
    within a window) are one fragment with ``times``, each ``count`` bytes after the one before."""
    held = None
    for fragment in _single_fragments(body, size):
        if held is not None:
            key, digest, start, count, at, times = held
            if fragment[2] == start + count * times and (fragment[0], fragment[1], *fragment[3:]) == (key, digest, count, at):
                held = (key, digest, start, count, at, times + 1)
                continue
            yield held
        held = (*fragment, 1)
    if held is not None:
        yield held


def _single_fragments(body: bytes, size: int) -> Iterator[tuple[int, int, int, int, int]]:
    for low in range(0, len(body) - size + 1, STEP):
        data = np.frombuffer(body, np.uint8)[low : low + STEP + size - 1]
        h = gram_hash(data)
        v = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
        anchor = (sliding_min(v, size - GRAM + 1) & _LOW).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        counts = np.diff(np.r_[starts, len(anchor)])
        for first in range(0, len(starts), 1 << 16):  # a few at a time as Python values
            part = slice(first, first + (1 << 16))
            keys = h[anchor[starts[part]]].view(np.int64).tolist()
            ats = (anchor[starts[part]] - starts[part]).tolist()
            for key, start, count, at in zip(keys, (starts[part] + low).tolist(), counts[part].tolist(), ats):
                piece = body[start : start + count + size - 1]
                yield key, xxhash.xxh3_64_intdigest(piece, at) - 2**63, start, count, at


#: Ranges of windows that a group with too many fragments is split into, one after the other.
RANGES = (64, 16, 4, 1)

_ANCHOR = "struct<key:long,digest:long,start:long,count:int,at:int,times:long>"


def texts(docs: DataFrame, size: int) -> DataFrame:
    """text (number), weight (rows that have it), id and own (of one of them), anchors of every distinct text."""
    key = docs.schema["doc_id"].dataType.simpleString()
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())

    def work(batch: pa.RecordBatch):
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            found, offsets = [], [0]
            for body in part.column("body"):
                found += fragments(body.as_py(), size)
                offsets.append(len(found))
            columns = list(zip(*found)) if found else [()] * 6
            structs = pa.StructArray.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["key", "digest", "start", "count", "at", "times"]
            )
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("own"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)],
                ["doc_id", "own", "anchors"],
            )

    rows = by_batch(bodies(docs), work, f"doc_id {key}, own binary, anchors array<{_ANCHOR}>")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("one")
    same = rows.groupBy("own").agg(F.count(F.lit(1)).alias("weight"), one, F.first("anchors").alias("anchors"))
    return same.select(
        F.monotonically_increasing_id().alias("text"), "weight", F.col("one.doc_id").alias("id"), "own", "anchors"
    )


def bodies(docs: DataFrame) -> DataFrame:
    """doc_id, own (digest of the text), body."""
    return docs.select("doc_id", F.unhex(F.md5(text_bytes())).alias("own"), text_bytes().alias("body"))


# --- sorting --------------------------------------------------------------------


def repeated_windows(found: list[tuple[bytes, int, int]], size: int) -> list[np.ndarray]:
    """For each fragment (bytes, anchor's place, weight): which of its windows occur twice
    or more in all of them, by weight. Equal windows are equal relative to their anchors."""
    need = (size - BLOCK + 1) // BLOCK  # whole blocks in every window
    data = np.frombuffer(b"".join(f for f, _, _ in found), np.uint8)
    sizes = np.array([len(f) for f, _, _ in found])
    base = np.cumsum(sizes) - sizes
    lead = np.array([at % BLOCK for _, at, _ in found])
    blocks = (sizes - lead) // BLOCK
    owner = np.repeat(np.arange(len(found)), blocks)
    number = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    at = (base + lead)[owner] + number * BLOCK
    wide = data[at[:, None] + np.arange(BLOCK)].view(np.uint64).ravel()
    names = np.unique(wide, return_inverse=True)[1]
    # every fragment ends with a symbol of its own, below all blocks
    place = np.arange(len(names)) + owner
    symbols = np.empty(len(names) + len(found), np.int64)
    symbols[place] = names + len(found)
    symbols[np.cumsum(blocks + 1) - 1] = np.arange(len(found))
    order = suffix_array(symbols)
    # of the order, the suffixes that have enough blocks; equal ones are neighbours
    able = np.zeros(len(symbols), bool)
    able[place] = number + need <= blocks[owner]
    order = order[able[order]]
    equal = (symbols[order[1:, None] + np.arange(need)] == symbols[order[:-1, None] + np.arange(need)]).all(1)
    run = np.empty(len(symbols), np.int64)
    run[order] = np.cumsum(np.r_[True, ~equal]) if len(order) else 0
    # windows: the first whole block in it, and the bytes before and after the whole blocks
    windows = sizes - size + 1
    frag = np.repeat(np.arange(len(found)), windows)
    p = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    ahead = (lead[frag] - p) % BLOCK
    suffix = (np.cumsum(blocks + 1) - blocks - 1)[frag] + (p + ahead - lead[frag]) // BLOCK
    rest = size - need * BLOCK
    edges = np.zeros((len(p), -(-rest // 8) * 8), np.uint8)
    for j in range(rest):
        edges[:, j] = data[base[frag] + p + j + np.where(j >= ahead, need * BLOCK, 0)]
    keys = [*edges.view(np.uint64).T, ahead, run[suffix]]
    which = np.lexsort(keys)
    new = np.ones(len(which), bool)
    new[1:] = False
    for k in keys:
        ranked = k[which]
        new[1:] |= ranked[1:] != ranked[:-1]
    weight = np.array([w for _, _, w in found])[frag[which]]
    total = np.add.reduceat(weight, np.flatnonzero(new))
    twice = np.empty(len(frag), bool)
    twice[which] = (total > 1)[np.cumsum(new) - 1]
    return np.split(twice, np.cumsum(windows)[:-1])


def covered(twice: np.ndarray, size: int) -> list[tuple[int, int]]:
    """The bytes that repeated windows cover, as intervals."""
    starts = np.flatnonzero(twice)
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > size)
    first, last = starts[np.r_[0, breaks + 1]], starts[np.r_[breaks, len(starts) - 1]]
    return list(zip(first.tolist(), (last + size).tolist()))


_FRAGMENT = "key long, digest long, weight long, at int, body binary"
_PART = _FRAGMENT + ", of_key long, of_digest long, shift int"


def as_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(field.split(" ") for field in schema.split(", ")))
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names)


def sort_fragments(found: DataFrame, size: int) -> DataFrame:
    """key, digest, lo, hi: the covered bytes of every fragment (one row each), as intervals."""
    out = "key long, digest long, lo long, hi long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple] = {}
        held_bytes, now = 0, None
        for batch in batches:
            names = ("key", "digest", "weight", "at", "body")
            for key, digest, weight, at, body in zip(*(batch.column(c).to_pylist() for c in names)):
                if key != now and held_bytes > BATCH:
                    yield solved(held)
                    held, held_bytes = {}, 0
                now = key
                held[key, digest] = (body, at, weight)
                held_bytes += len(body)
        if held:
            yield solved(held)

    def solved(held: dict[tuple[int, int], tuple]) -> pa.RecordBatch:
        twice = repeated_windows(list(held.values()), size)
        return as_batch([(*name, lo, hi) for name, w in zip(held, twice) for lo, hi in covered(w, size)], out)

    return found.repartition("key").sortWithinPartitions("key").mapInArrow(work, out)


def parted(hot: DataFrame, size: int, width: int) -> DataFrame:
    """The windows of each fragment by ranges of their distance to the anchor."""

    def work(batch: pa.RecordBatch):
        rows = []
        for row in batch.to_pylist():
            body, at = row["body"], row["at"]
            count = len(body) - size + 1
            for c in range((at - count + 1) // width, at // width + 1):
                # windows at distances c * width .. (c + 1) * width - 1, and what all such have in common
                first, last = at - (c + 1) * width + 1, at - c * width
                core = body[last : max(last, first + size)]
                a, b = max(0, first), min(count - 1, last)
                piece = body[a : b + size]
                key = xxhash.xxh3_64_intdigest(core, c) - 2**63
                digest = xxhash.xxh3_64_intdigest(piece, at - a) - 2**63
                rows.append((key, digest, row["weight"], at - a, piece, row["key"], row["digest"], a))
        yield as_batch(rows, _PART)

    return by_batch(hot, work, _PART)


def solve(found: DataFrame, size: int, many: int, ranges: tuple[int, ...] = RANGES) -> DataFrame:
    """As ``sort_fragments``, with the groups of more than ``many`` fragments split first."""
    groups = found.groupBy("key").count().where(F.col("count") > many)
    hot = stored(groups.select(F.col("key").alias("k")), "hot")
    if not ranges or hot.isEmpty():
        return sort_fragments(found, size)
    is_hot = F.col("key") == F.col("k")
    direct = sort_fragments(found.join(hot, is_hot, "left_anti"), size)
    parts = stored(parted(found.join(hot, is_hot, "left_semi"), size, ranges[0]), "parts")
    merged = parts.groupBy("key", "digest").agg(
        F.sum("weight").alias("weight"), F.first("at").alias("at"), F.first("body").alias("body")
    )
    inner = solve(stored(merged, "merged"), size, many, ranges[1:]).withColumnsRenamed({"key": "k", "digest": "d"})
    origin = parts.select("key", "digest", "of_key", "of_digest", "shift")
    back = origin.join(inner, (F.col("key") == F.col("k")) & (F.col("digest") == F.col("d"))).select(
        F.col("of_key").alias("key"), F.col("of_digest").alias("digest"),
        (F.col("lo") + F.col("shift")).alias("lo"), (F.col("hi") + F.col("shift")).alias("hi"),
    )
    return direct.unionByName(back)


# --- the operator -----------------------------------------------------------------


def repeated_spans(docs: DataFrame, size: int = 400, many: int = MANY) -> DataFrame:
    """own (digest of a text), spans (array of lo, hi; they may overlap) of the texts that repeat something."""
    found = stored(texts(docs, size), "texts")
    each = found.select("text", "weight", F.explode("anchors").alias("a")).select("text", "weight", "a.*")
    rows = F.sum(F.col("weight") * F.col("times"))
    often = each.groupBy("key").agg(rows.alias("n")).where("n > 1").select(F.col("key").alias("k"))
    # a table of its own, so that the join deals both sides and Spark can split a hot anchor
    often = stored(often, "often")
    each = stored(each.join(often, F.col("key") == F.col("k"), "left_semi"), "anchors")
    one = F.min(F.struct("text", "start", "count", "at")).alias("one")
    kinds = each.groupBy("key", "digest").agg(rows.alias("weight"), one)
    wanted = kinds.groupBy(F.col("one.text").alias("t")).agg(
        F.collect_list(F.struct("key", "digest", "weight", "one.start", "one.count", "one.at")).alias("wanted")
    )  # as many as the text has anchors, at most
    where = found.join(wanted, F.col("text") == F.col("t")).select("id", F.col("own").alias("mark"), "wanted")
    holders = bodies(docs).join(where, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("own") == F.col("mark")))

    def cut(batch: pa.RecordBatch):
        for low in range(0, batch.num_rows, 64):
            part = batch.slice(low, 64)
            out = []
            for body, asked in zip(part.column("body").to_pylist(), part.column("wanted").to_pylist()):
                for w in asked:
                    piece = body[w["start"] : w["start"] + w["count"] + size - 1]
                    out.append((w["key"], w["digest"], w["weight"], w["at"], piece))
            yield as_batch(out, _FRAGMENT)

    pieces = stored(by_batch(holders.select("body", "wanted"), cut, _FRAGMENT), "fragments")
    solved = solve(pieces, size, many).withColumnsRenamed({"key": "k", "digest": "d"})
    met = each.join(solved, (F.col("key") == F.col("k")) & (F.col("digest") == F.col("d")))
    # a fragment that stands there several times repeats as a whole: what lies between the first and the last goes, too
    more = (F.col("times") - 1) * F.col("count")
    span = F.struct((F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi") + more).alias("hi"))
    spans = met.groupBy("text").agg(F.collect_set(span).alias("spans"))  # of one text
    return spans.join(found.select(F.col("text").alias("t"), "own"), F.col("text") == F.col("t")).select("own", "spans")


def suffix_dedup(docs: DataFrame, size: int = 400, many: int = MANY, keep_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes left): a row for each of ``docs``."""
    key = docs.schema["doc_id"].dataType.simpleString()
    spans = repeated_spans(docs, size, many).withColumnRenamed("own", "mark")
    rows = bodies(docs).join(spans, F.col("own") == F.col("mark"), "left").select("doc_id", "body", "spans")

    def work(batch: pa.RecordBatch):
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            out = []
            for body, them in zip(part.column("body").to_pylist(), part.column("spans").to_pylist()):
                kept, at, n = [], 0, 0
                end = None
                for lo, hi in sorted((s["lo"], s["hi"]) for s in them or ()):
                    if end is None or lo > end:
                        kept.append(body[at:lo])
                        n += 1
                        end = hi
                    else:
                        end = max(end, hi)
                    at = end
                rest = b"".join([*kept, body[at:]])
                out.append((len(body), len(body) - len(rest), n, hashlib.sha256(rest).hexdigest(), rest))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            columns, names = (columns, names) if keep_bytes else (columns[:-1], names[:-1])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *names])

    schema = f"doc_id {key}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return by_batch(rows, work, schema + ", kept binary" * keep_bytes)


SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
),
windows AS (
  SELECT r, i, md5(substr(h, 2 * i + 1, 800)) AS m
  FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM d WHERE length(h) >= 800)
),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY m) AS c FROM windows) WHERE c > 1),
marks AS (
  SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 400 THEN 0 ELSE 1 END AS new FROM twice
),
runs AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM marks),
spans AS (SELECT r, min(i) AS lo, max(i) + 400 AS hi FROM runs GROUP BY r, g),
gone AS (
  SELECT r, string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS head, max(hi) AS last,
         count(*) AS n_spans, sum(hi - lo) AS n_removed
  FROM (SELECT r, lo, hi, h, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS before FROM spans JOIN d USING (r))
  GROUP BY r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
"""
