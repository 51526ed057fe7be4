"""N-gram Jaccard join on parity sketches.

A document is the set of its distinct word n-grams, hashed to 64 bits. Sets A
and B link if ``100 * |A and B| >= percent * |A or B|``; then they differ in
at most ``d = min(|A|, |B|) * (100 - percent) / percent`` elements.

1. Rows with equal sets become one class, by a digest of the set.
2. A class with more than ``d`` n-grams that no other class has cannot link.
   They are counted on a share of all n-grams (those with a small hash, the
   same for everyone), so the count is a lower bound and loses no link. Each
   task sends an n-gram once, however many of its rows have it.
3. The other classes are hashed into sketches: every n-gram is XORed into one
   cell of a band's ``m`` cells. An n-gram that only one of two sets has
   changes one cell, so the number of cells that differ is at most ``d``. A band holds a
   range of sizes; a set also joins the next band if its partner can be there.
4. Pigeonhole: of any ``d + 1`` cells of a set, one is equal in both sketches.
   A set enters its fullest cells, at least ``d + 1`` of them, so that an
   equal cell stands for several equal n-grams. Classes that share a cell are joined to
   the smallest one there, and the connected ones make a cluster.
5. Clusters are verified exactly, all members against all, in blocks of
   bounded size: a large cluster becomes many tasks, one for each two of
   its blocks, which keep a spanning forest of the links they find.
6. The links' connected components get the smallest ``doc_id`` as their id.

No cap is set on partners or candidates. Verification compares n-grams by
their 64-bit hashes. The work on a cluster grows with the square of its distinct sets.

Defined results: a document without words (NULL, empty) has no n-grams and is
linked with nothing; with fewer than ``n`` words its whole sequence is its one
n-gram; a NULL ``doc_id`` is no candidate for a component's id, unless all are
NULL; repeated rows link with each other; only ``doc_id`` and ``text`` are read;
an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import WORD, by_batch, packed, partitions, stored, text_bytes
from finlake.llm.components import components

#: Upper over lower end of a band of set sizes.
BAND = 1.5
#: Documents and n-grams of a block of the verification.
BLOCK_DOCS = 512
BLOCK_GRAMS = 300_000
#: Columns of the membership matrix that are multiplied at a time.
COLUMNS = 4096

_K = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_set(text: bytes, n: int) -> np.ndarray:
    """The sorted distinct n-gram hashes of a text; A-Z count as a-z."""
    words = text.lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))], np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = len(words) - n + 1
    h = codes[:size].copy()
    for k in range(1, n):
        h = mixed(h * _K + codes[k : size + k])
    return np.unique(h)


def allowed(size: int, percent: int) -> int:
    """In how many elements a set of this size may differ from a partner, at most."""
    return size * (100 - percent) // percent


def digest(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


# --- classes ------------------------------------------------------------------


def classes(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, same (hash of the text), n_shingles, set (digest; NULL without n-grams) of every row."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch):
        sizes, digests = [], []
        for body in batch.column("body"):
            grams = gram_set(body.as_py(), n)
            sizes.append(len(grams))
            digests.append(digest(grams) if len(grams) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("same"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())],
            ["doc_id", "same", "n_shingles", "set"],
        )

    rows = docs.select("doc_id", F.xxhash64(text_bytes()).alias("same"), text_bytes().alias("body"))
    return by_batch(rows, work, f"doc_id {key}, same long, n_shingles long, set binary")


# --- n-grams of one class only --------------------------------------------------

_MANY = np.uint32(0xFFFFFFFF)


def lone_grams(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """set, n_shingles, lone: a lower bound of the class's n-grams that no other class has."""
    # enough n-grams that a set of lone ones shows more than ``allowed`` of them
    share = min(1.0, 2.25 * (100 - percent) / percent)
    least = np.uint64(min(int(share * 2**64), 2**64 - 1))
    buckets = 4 * partitions(docs.sparkSession)

    def send(batch: pa.RecordBatch):
        sets = {}
        for body in batch.column("body"):
            grams = gram_set(body.as_py(), n)
            if len(grams):
                sets[digest(grams)] = (len(grams), grams[: int(np.searchsorted(grams, least, "right"))].copy())
        if not sets:
            return
        names = b"".join(sets)
        mark = xxhash.xxh3_128_digest(names)  # of the batch, the same when it is made again
        grams = np.concatenate([g for _, g in sets.values()])
        owner = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(g) for _, g in sets.values()])
        order = np.argsort(grams, kind="stable")
        grams, owner = grams[order], owner[order]
        first = np.r_[True, grams[1:] != grams[:-1]]
        many = np.r_[~first[1:], False]
        grams, owner = grams[first], np.where(many[first], _MANY, owner[first])
        # a bucket is a range of hashes; the share takes the low ones
        bucket = (grams >> np.uint64(32)) * np.uint64(buckets) // ((least >> np.uint64(32)) + np.uint64(1))
        ends = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        rows = [(xxhash.xxh3_64_intdigest(mark) % buckets, mark, names, np.array([s for s, _ in sets.values()], "<u4").tobytes(), True)]
        for k in range(buckets):
            if ends[k] < ends[k + 1]:
                part = slice(ends[k], ends[k + 1])
                rows.append((k, mark, grams[part].tobytes(), owner[part].tobytes(), False))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()))],
            ["bucket", "mark", "a", "b", "head"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per bucket: how many of its n-grams each batch's classes have alone."""
        names = ("bucket", "mark", "a", "b", "head")
        now, parts = None, []
        for batch in batches:
            for bucket, mark, a, b, head in zip(*(batch.column(c).to_pylist() for c in names)):
                if head:
                    yield out([(mark, a, b, True)])
                    continue
                if bucket != now and parts:
                    yield out(alone(parts))
                    parts = []
                now = bucket
                parts.append((mark, np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint32)))
        if parts:
            yield out(alone(parts))

    def alone(parts: list) -> list[tuple]:
        grams = np.concatenate([g for _, g, _ in parts])
        owner = np.concatenate([o for _, _, o in parts])
        source = np.repeat(np.arange(len(parts)), [len(g) for _, g, _ in parts])
        order = np.argsort(grams)
        grams = grams[order]
        new = np.r_[True, grams[1:] != grams[:-1], True]
        lone = order[new[1:] & new[:-1]]
        lone = lone[owner[lone] != _MANY]
        lone = np.sort(lone)  # by source
        ends = np.searchsorted(source[lone], np.arange(len(parts) + 1))
        rows = []
        for k, (mark, _, _) in enumerate(parts):
            found = np.bincount(owner[lone[ends[k] : ends[k + 1]]])
            if len(found):
                rows.append((mark, found.astype("<u4").tobytes(), b"", False))
        return rows

    def out(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.binary(), pa.binary(), pa.binary(), pa.bool_())
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["mark", "a", "b", "head"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums a batch's counts; its head, which comes first, names the classes."""
        mark = names = sizes = lone = None

        def ended() -> Iterator[pa.RecordBatch]:
            if names is not None:
                sets = [names[i : i + 16] for i in range(0, len(names), 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets, pa.binary()), pa.array(sizes.astype(np.int64)), pa.array(lone)],
                    ["set", "n_shingles", "lone"],
                )

        for batch in batches:
            for m, a, b, head in zip(*(batch.column(c).to_pylist() for c in ("mark", "a", "b", "head"))):
                if m != mark:
                    yield from ended()
                    mark, names = m, None
                if head:  # equal batches (of repeated rows) have equal heads
                    names, sizes = a, np.frombuffer(b, "<u4")
                    lone = np.zeros(len(sizes), np.int64)
                else:
                    found = np.frombuffer(a, "<u4")
                    lone[: len(found)] += found
        yield from ended()

    body = docs.select(text_bytes().alias("body"))
    sent = by_batch(body, send, "bucket int, mark binary, a binary, b binary, head boolean")
    dealt = sent.repartition(buckets // 4, "bucket").sortWithinPartitions("bucket")
    counted = dealt.mapInArrow(count, "mark binary, a binary, b binary, head boolean")
    per_batch = counted.repartition("mark").sortWithinPartitions("mark", F.col("head").desc())
    return per_batch.mapInArrow(total, "set binary, n_shingles long, lone long")


# --- sketches -------------------------------------------------------------------


def band_of(size: int) -> int:
    return int(np.floor(np.log(size) / np.log(BAND) + 1e-9))


def cells(grams: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the cells that a set enters: per band its fullest cells, more than it may differ in."""
    size, keys = len(grams), []
    differ = allowed(size, percent)
    own = band_of(size)
    for band in (own, own + 1):
        lower = BAND**band
        if band > own and size * 100 < percent * lower * (1 - 1e-9):
            continue  # no partner of that band is so much larger
        # a fourth more cells than the band's largest set may differ in, so that the fullest do
        m = int(1.25 * BAND * lower * (100 - percent) / percent) + 2
        at = ((grams >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)  # rises with the hash
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        full = np.diff(np.r_[starts, size])
        sketch = np.bitwise_xor.reduceat(mixed(grams), starts)
        where = at[starts]
        if len(full) <= differ:  # too few cells are filled: empty ones are cells, too
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), where)
            where, sketch = np.r_[where, empty], np.r_[sketch, np.zeros(len(empty), np.uint64)]
        else:
            ranked = np.sort(full)[::-1]
            least = ranked[differ]  # at least ``differ + 1`` cells are as full as this
            where, sketch = where[full >= least], sketch[full >= least]
        keys.append(mixed(sketch ^ mixed(where * _K + np.uint64(band + 1))))
    return np.concatenate(keys)


def sketched(docs: DataFrame, chosen: DataFrame, n: int, percent: int) -> DataFrame:
    """set, n_shingles, grams (binary), cells (array) of the classes' chosen rows (id, own)."""
    rows = docs.select("doc_id", F.xxhash64(text_bytes()).alias("same"), text_bytes().alias("body"))
    # the ids are as many as the corpus has documents with copies: never broadcast, at any size
    rows = rows.join(chosen.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("same") == F.col("own")))

    def work(batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, 512):
            found = [gram_set(b, n) for b in batch.column("body").slice(at, 512).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([digest(g) for g in found], pa.binary()),
                    pa.array([len(g) for g in found], pa.int64()),
                    pa.array([g.tobytes() for g in found], pa.binary()),
                    pa.array([cells(g, percent).view(np.int64) for g in found], pa.list_(pa.int64())),
                ],
                ["set", "n_shingles", "grams", "cells"],
            )

    return by_batch(rows.select("body"), work, "set binary, n_shingles long, grams binary, cells array<long>")


# --- verification ---------------------------------------------------------------


def common_counts(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """How many elements each of ``left`` has in common with each of ``right`` (or of ``left``)."""
    both = left if right is None else left + right
    owner = np.repeat(np.arange(len(both)), [len(g) for g in both])
    grams, at = np.unique(np.concatenate(both), return_inverse=True)
    shared = np.bincount(at, minlength=len(grams)) > 1
    keep = shared[at]
    owner, at = owner[keep], (np.cumsum(shared) - 1)[at[keep]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((len(left), len(both) - len(left) if right is not None else len(left)), np.float32)
    width = int(shared.sum())
    for low in range(0, width, COLUMNS):
        a, b = np.searchsorted(at, [low, low + COLUMNS])
        x = np.zeros((len(both), min(COLUMNS, width - low)), np.float32)
        x[owner[a:b], at[a:b] - low] = 1  # sums of ones: exact in 32-bit floats
        out += x[: len(left)] @ (x[len(left) :] if right is not None else x).T
    return out


def linked(left: dict[bytes, np.ndarray], right: dict[bytes, np.ndarray] | None, percent: int) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the links within ``left``, or between ``left`` and ``right``."""
    a, b = list(left), list(left if right is None else right)
    if not a or not b:
        return []
    common = common_counts(list(left.values()), None if right is None else list(right.values())).astype(np.int64)
    n, m = (np.array([len(s[k]) for k in names]) for s, names in ((left, a), (left if right is None else right, b)))
    i, j = np.nonzero(100 * common >= percent * (n[:, None] + m[None, :] - common))
    top: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        while x in top:
            x = top[x]
        return x

    out = []
    for x, y in zip(i.tolist(), j.tolist()):
        if right is None and y <= x:
            continue
        p, q = root(a[x]), root(b[y])
        if p != q:
            top[max(p, q)] = min(p, q)
            out.append((a[x], b[y]))
    return out


def verified(clusters: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """a, b: links that connect whatever is linked. ``clusters``: node, root; ``found`` as ``sketched``."""
    members = clusters.join(found.select("set", "n_shingles"), F.col("node") == F.col("set")).select(
        F.col("root").alias("cluster"), "node", "n_shingles"
    )
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("c"), F.sum("n_shingles").alias("g"))
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK_DOCS), F.ceil(F.col("g") / BLOCK_GRAMS)).cast("int")
    sizes = sizes.where("c > 1").select(F.col("cluster").alias("k"), blocks.alias("blocks"))
    sizes = stored(sizes, "clusters")
    # the n-grams themselves join last, once all that is known of a set is in its row
    dealt = members.join(sizes, F.col("cluster") == F.col("k")).select(
        "cluster", "node", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own")
    )
    dealt = found.select("set", "grams").join(stored(dealt, "members"), F.col("set") == F.col("node"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tasks = dealt.select("cluster", "own", other.alias("other"), "set", "grams").select(
        "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "set", "grams"
    )
    tasks = tasks.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sides = None, ({}, {})
        for batch in batches:
            names = ("cluster", "i", "j", "own", "set", "grams")
            for cluster, i, j, own, name, grams in zip(*(batch.column(c).to_pylist() for c in names)):
                if (cluster, i, j) != task:
                    yield from ended(task, sides)
                    task, sides = (cluster, i, j), ({}, {})
                sides[own != i][name] = np.frombuffer(grams, np.uint64)
        yield from ended(task, sides)

    def ended(task, sides) -> Iterator[pa.RecordBatch]:
        if task is not None:
            found = linked(sides[0], None if task[1] == task[2] else sides[1], percent)
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return tasks.mapInArrow(work, "a binary, b binary")


# --- the join -------------------------------------------------------------------


def near_classes(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows' classes (as ``classes``), and node, root of the classes that link."""
    rows = stored(classes(docs, n), "classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "same")).alias("first")
    chosen = rows.where(F.col("set").isNotNull()).groupBy("set").agg(first)
    differ = F.floor(F.col("n_shingles") * (100 - percent) / percent)
    able = lone_grams(docs, n, percent).where((differ >= 1) & (F.col("lone") <= differ))
    able = able.select(F.col("set").alias("able")).distinct()
    chosen = chosen.join(able, F.col("set") == F.col("able"))
    chosen = stored(chosen.select(F.col("first.doc_id").alias("id"), F.col("first.same").alias("own")), "able")
    found = stored(sketched(docs, chosen, n, percent), "sketches")
    entered = found.select("set", F.explode("cells").alias("cell")).distinct()
    hubs = entered.groupBy("cell").agg(F.min("set").alias("hub"), F.count(F.lit(1)).alias("c"))
    # a table of its own, so that the join deals both sides and Spark can split a hot cell
    hubs = stored(hubs.where("c > 1").select(F.col("cell").alias("k"), "hub"), "hubs")
    met = entered.join(hubs, F.col("cell") == F.col("k")).select(F.col("set").alias("a"), F.col("hub").alias("b"))
    clusters = components(met)
    return rows, components(verified(stored(clusters, "clusters"), found, percent))


def near_groups(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id: a row for each of ``docs``."""
    rows, linked_sets = near_classes(docs, n, percent)
    sets = rows.where(F.col("set").isNotNull()).groupBy("set").agg(F.min("doc_id").alias("low"))
    sets = sets.join(linked_sets, F.col("set") == F.col("node"), "left")
    sets = sets.select("set", "low", F.coalesce("root", "set").alias("root"))
    lows = sets.groupBy("root").agg(F.min("low").alias("component")).select(F.col("root").alias("r"), "component")
    names = sets.join(lows, F.col("root") == F.col("r")).select(F.col("set").alias("s"), "component")
    met = rows.join(names, F.col("set") == F.col("s"), "left")
    return met.select(
        "doc_id", "n_shingles",
        F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )


def drop_near_copies(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without words, and of every component the row with the smallest
    ``doc_id`` (then text hash); of rows that repeat it, one."""
    rows, linked_sets = near_classes(docs, n, percent)
    met = rows.where(F.col("set").isNotNull()).join(linked_sets, F.col("set") == F.col("node"), "left")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "same")
    grouped = met.select(F.coalesce("root", "set").alias("root"), place.alias("place"))
    ties = grouped.groupBy("root", "place").agg(F.count(F.lit(1)).alias("ties"))
    best = ties.groupBy("root").agg(F.min(F.struct("place", "ties")).alias("best"))
    stays = best.select("root", F.col("best.place.doc_id").alias("id"), F.col("best.place.same").alias("own"), "best.ties")
    marked = packed(
        docs,
        doc_id=F.col("doc_id"),
        same=F.xxhash64(text_bytes()),
        worded=F.coalesce(F.col("text").rlike(WORD), F.lit(False)),
    )
    kept = marked.where("worded").join(
        stays, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("same") == F.col("own"))
    )
    again = kept.where("ties > 1").dropDuplicates(["root"])
    parts = kept.where("ties = 1"), again, marked.where("not worded")
    once, repeated, wordless = (part.select("row.*") for part in parts)
    return once.unionByName(repeated).unionByName(wordless)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
grams AS (
  SELECT DISTINCT r, array_to_string(list_slice(words, i, i + 2), ' ') AS g
  FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM d WHERE len(words) > 0)
),
sizes AS (SELECT r, count(*) AS n FROM grams GROUP BY r),
pairs AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM grams a JOIN grams b USING (g) WHERE a.r < b.r GROUP BY a.r, b.r),
links AS (
  SELECT x, y FROM pairs JOIN sizes s ON s.r = x JOIN sizes t ON t.r = y WHERE 100 * c >= 90 * (s.n + t.n - c)
),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT r AS node, r AS origin FROM d
  UNION
  SELECT y, origin FROM reach JOIN both_ways ON x = node
),
low AS (SELECT origin, min(doc_id) AS component_id FROM reach JOIN d ON d.r = node GROUP BY origin)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d JOIN low ON origin = d.r LEFT JOIN sizes USING (r)
"""
