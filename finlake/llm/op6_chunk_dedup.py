"""Repeated passages by content-defined chunks (gear rolling hash), followed to their true ends.

A gear hash of the last ``GRAM`` bytes decides where a chunk ends, so equal passages
are cut alike wherever they stand, and an insertion moves no later cut. Chunks
meet by digest; of equal chunks the first one (smallest id, then
position) owns the content. Neighbouring chunks that occur elsewhere, too, form
runs. The ends of a run are followed byte by byte, with the text around them,
against the first and the last place of the chunk there; runs of at least
``MIN_RUN`` bytes with what was added count. A document's removed spans are the
parts of its runs that it does not own; what was added goes with the chunk at
that end, as far as the owner's text agrees.

The cut rule: of the gear hashes of every ``WINDOW`` positions in a row the least
one (of equal ones the last) is a cut. A chunk's digest covers the chunk and the bytes before it,
``COVER`` in all, so that a chunk of a few bytes is not met everywhere (one that ends
earlier in its text has none). In ``COVER + WINDOW - 1`` = 100 equal bytes the last
window has a cut with ``COVER`` equal bytes before it, so two texts with 100 bytes in
common share a chunk, and what is equal beyond a run is shorter than ``AROUND`` bytes. Text that repeats
itself within a window is cut once a period.

Chunks with equal 64-bit digest are taken as equal. A batch of texts keeps its chunks as packed arrays
(``chunked``) and asks, per range of digests, which of its different ones are met in another batch, too
(``met_elsewhere``): 8 bytes a chunk are shuffled once, whatever a third of all rows share is one
entry a batch, and only chunks that do occur elsewhere become rows. Owners of those
are aggregated before the shuffle, so a hot chunk reaches the join as one row, and Spark's skew join
splits the other side.

Defined results: a NULL or empty text has no chunks and nothing removed; a
NULL ``doc_id`` comes after all ids; identical rows (same id and text) count as
one document; only ``doc_id`` and ``text`` are read; an empty table gives an
empty one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.common import by_batch, stored, text_bytes

GRAM, WINDOW = 8, 47
#: No chunk is longer, and no run goes on for so many equal bytes beyond its last chunk.
MOST = AROUND = WINDOW + GRAM
#: Bytes that a chunk's digest covers, to the chunk's end.
COVER = WINDOW + GRAM - 1
MIN_RUN = 100
#: Bytes cut at a time inside a task.
STEP = 1 << 16
#: Bytes of text whose chunks are packed together (a longer text is packed alone), and of digests compared in one group.
PACKED, COMPARED = 4 << 20, 4 << 20

#: One pseudo-random 32-bit number per byte value, made by a rule (splitmix64).
_x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(2**64 - 1)
_x = (_x ^ (_x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
GEAR = ((_x ^ (_x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB) >> np.uint64(32)).astype(np.uint32)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """sum of GEAR[data[i - j]] << 4j for j under GRAM, modulo 2^32, at every position."""
    h = GEAR[data]
    for width in (1, 2, 4):
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(4 * width)
        h = wider
    return h


def least(h: np.ndarray) -> np.ndarray:
    """Positions of the least value (of equal ones the last) of every WINDOW values in a row."""
    n = len(h)
    low = h.astype(np.uint64) << np.uint64(32) | np.arange(n, 0, -1, dtype=np.uint64)
    width = 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    at = n - (low & np.uint64(2**32 - 1)).astype(np.int64)
    return at[np.diff(at, prepend=-1) != 0]


def cuts(text: bytes) -> np.ndarray:
    """Ends of the chunks of a text."""
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    found = [np.zeros(0, np.int64)]
    for at in range(0, n, STEP):  # long texts in steps; windows and hashes need the bytes before
        low = max(0, at - AROUND)
        h = gear_hash(data[low : at + STEP])[GRAM - 1 :]
        if len(h) >= WINDOW:
            found.append(least(h) + low + GRAM)
    ends = np.concatenate(found)
    return np.unique(np.r_[ends, n]) if n else ends


def chunked(docs: DataFrame) -> DataFrame:
    """batch, docs (doc_id, same (hash of the text), n_bytes, n_chunks), lengths (a byte a chunk), digests (8 bytes
    a chunk that ends at COVER or later): the chunks of some texts in a row."""
    key = docs.schema["doc_id"].dataType.simpleString()

    def packs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = np.array(batch.column("n_bytes").to_numpy(zero_copy_only=False), np.int64)
        group = (np.cumsum(sizes) - sizes) // PACKED
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        return (batch.slice(i, j - i) for i, j in zip(edges, edges[1:]))

    def work(batch: pa.RecordBatch):
        for part in packs(batch):
            digests, lengths, counts = [], [], []
            for text in part.column("body"):
                text = text.as_py()
                ends = cuts(text)
                lengths.append(np.diff(ends, prepend=0).astype(np.uint8))
                counts.append(len(ends))
                digests += [xxhash.xxh3_64_intdigest(text[e - COVER : e]) for e in ends.tolist() if e >= COVER]
            names = ["doc_id", "same", "n_bytes", "n_chunks"]
            docs = pa.StructArray.from_arrays(
                [*(part.column(c) for c in names[:3]), pa.array(counts, pa.int64())], names
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().int >> 65], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), docs),
                    pa.array([np.concatenate(lengths).tobytes()], pa.binary()),
                    pa.array([np.array(digests, "<u8").tobytes()], pa.binary()),
                ],
                ["batch", "docs", "lengths", "digests"],
            )

    body = text_bytes()
    rows = docs.select(
        "doc_id", F.xxhash64(body).alias("same"), F.octet_length(body).cast("long").alias("n_bytes"), body.alias("body")
    )
    held = f"array<struct<doc_id:{key},same:long,n_bytes:long,n_chunks:long>>"
    return by_batch(rows, work, f"batch long, docs {held}, lengths binary, digests binary")


def met_elsewhere(packs: DataFrame) -> DataFrame:
    """batch, ranks: which of the batch's different digests, in their order, occur twice or more in all batches."""
    size = packs.agg(F.sum(F.octet_length("digests"))).first()[0] or 0
    bits = max(1, int(size // COMPARED).bit_length())

    def split(batch: pa.RecordBatch):
        for name, digests in zip(batch.column("batch").to_pylist(), batch.column("digests").to_pylist()):
            different, times = np.unique(np.frombuffer(digests, "<u8"), return_counts=True)
            ranges, at = np.unique(different >> np.uint64(64 - bits), return_index=True)
            ends = [*at[1:].tolist(), len(different)]
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(ranges.astype(np.int64)),
                "batch": pa.array([name] * len(at), pa.int64()),
                "at": pa.array(at.astype(np.int64)),
                "own": pa.array([different[i:j].tobytes() for i, j in zip(at, ends)], pa.binary()),
                "twice": pa.array([np.packbits(times[i:j] > 1).tobytes() for i, j in zip(at, ends)], pa.binary()),
            })

    def compare(table: pa.Table) -> pa.Table:
        own = [np.frombuffer(d, "<u8") for d in table.column("own").to_pylist()]
        met = np.concatenate(
            [np.unpackbits(np.frombuffer(t, np.uint8), count=len(d)) for t, d in zip(table.column("twice").to_pylist(), own)]
        ).astype(bool)
        every = np.concatenate(own)
        order = np.argsort(every)
        equal = np.diff(every[order]) == 0
        met[order[1:][equal]] = True
        met[order[:-1][equal]] = True
        ends = np.cumsum([len(d) for d in own])
        ranks = [
            (np.flatnonzero(met[e - len(d) : e]) + at).astype("<u4").tobytes()
            for d, e, at in zip(own, ends.tolist(), table.column("at").to_pylist())
        ]
        found = pa.table({"batch": table.column("batch"), "ranks": pa.array(ranks, pa.binary())})
        return found.filter(pc.greater(pc.binary_length(found.column("ranks")), 0))

    parts = by_batch(
        packs.select("batch", "digests"), split, "part long, batch long, at long, own binary, twice binary"
    )
    return parts.groupBy("part").applyInArrow(compare, "batch long, ranks binary")


def met_chunks(packs: DataFrame) -> DataFrame:
    """digest, doc_id, same, end, length of every chunk whose digest occurs twice or more."""
    key = packs.schema["docs"].dataType.elementType["doc_id"].dataType.simpleString()
    ranks = met_elsewhere(packs).groupBy(F.col("batch").alias("b")).agg(F.collect_list("ranks").alias("ranks"))

    def work(batch: pa.RecordBatch):
        for row in range(batch.num_rows):
            held = batch.column("docs")[row].values
            lengths, digests, ranks = (batch.column(c)[row].as_py() for c in ("lengths", "digests", "ranks"))
            lengths = np.frombuffer(lengths, np.uint8).astype(np.int64)
            counts = held.field("n_chunks").to_numpy()
            doc = np.repeat(np.arange(len(counts)), counts)
            ends = np.cumsum(lengths)
            ends -= np.r_[0, np.cumsum(held.field("n_bytes").to_numpy())][:-1][doc]
            some = ends >= COVER
            doc, ends, lengths = doc[some], ends[some], lengths[some]
            digests = np.frombuffer(digests, "<u8")
            different, place = np.unique(digests, return_inverse=True)
            met = np.zeros(len(different), bool)
            met[np.frombuffer(b"".join(ranks), "<u4")] = True
            for at in np.array_split(np.flatnonzero(met[place]), max(1, len(place) >> 16)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(digests[at].view(np.int64)),
                        held.field("doc_id").take(pa.array(doc[at])),
                        held.field("same").take(pa.array(doc[at])),
                        pa.array(ends[at]),
                        pa.array(lengths[at].astype(np.int32)),
                    ],
                    ["digest", "doc_id", "same", "end", "length"],
                )

    met = packs.join(ranks, F.col("batch") == F.col("b")).select("docs", "lengths", "digests", "ranks")
    return by_batch(met, work, f"digest long, doc_id {key}, same long, end long, length int")


def runs(packs: DataFrame) -> DataFrame:
    """doc_id, same, start, end, parts (start, end, owner_ids of what the document does not own), mates (side, first, i,
    s, at) of every run.

    Mates are the places of the chunk at the left (side 0) or right (1) end, other than itself:
    the first one (the owner's) and the last one, with the position there that matches the end."""
    each = stored(met_chunks(packs), "met")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "same", "end")
    shared = (
        each.groupBy(F.col("digest").alias("d"))
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("not (first <=> last)")  # not only in identical rows
    )
    # a table of its own, so that the join deals both sides and Spark can split a hot chunk
    met = each.join(stored(shared, "shared"), F.col("digest") == F.col("d"))
    per_doc = Window.partitionBy("doc_id", "same").orderBy("end")
    cover = F.col("end") - COVER
    of_doc = ["doc_id", "same"]
    rows = (
        met.select("doc_id", "same", "end", "length", "first", "last", place.eqNullSafe(F.col("first")).alias("owned"))
        .withColumn("before", F.lag("end").over(per_doc))
        .where("before is null or before <> end")  # identical rows are one document
        .withColumn("new", F.coalesce(F.col("before") != F.col("end") - F.col("length"), F.lit(True)))
        .withColumn("turn", F.col("new") | F.coalesce(F.lag("owned").over(per_doc) != F.col("owned"), F.lit(True)))
        .withColumn("run", F.sum(F.col("new").cast("long")).over(per_doc))
        .withColumn("part", F.sum(F.col("turn").cast("long")).over(per_doc))
    )
    parts = rows.groupBy(*of_doc, "run", "part").agg(
        F.min(cover).alias("start"), F.max("end").alias("end"), F.first("owned").alias("owned"),
        *(F.min_by(name, "end").alias(f"left_{name}") for name in ("first", "last")),
        *(F.max_by(name, "end").alias(f"right_{name}") for name in ("first", "last")),
        F.collect_set(F.when(~F.col("owned"), F.struct(F.col("first.doc_id").alias("i")))).alias("owner_ids"),
    )
    sides = [("left", "min_by"), ("right", "max_by")]
    found = parts.groupBy(*of_doc, "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        *(getattr(F, by)(f"{side}_{name}", "end").alias(f"{side}_{name}") for side, by in sides for name in ("first", "last")),
        F.collect_list(F.when(~F.col("owned"), F.struct("start", "end", "owner_ids"))).alias("parts"),
    )

    def mate(side: int, name: str) -> F.Column:
        at = F.col(f"{('left', 'right')[side]}_{name}")
        back = 0 if side else COVER
        own = (
            at["doc_id"].eqNullSafe(F.col("doc_id")) & (at["same"] == F.col("same"))
            & (at["end"] - back == F.col("end" if side else "start"))
        )
        return F.when(~own, F.struct(
            F.lit(side).alias("side"), F.lit(name == "first").alias("first"), at["doc_id"].alias("i"),
            at["same"].alias("s"), (at["end"] - back).alias("at"),
        ))

    mates = F.array_compact(F.array(*(mate(side, name) for side in (0, 1) for name in ("first", "last"))))
    return found.select("doc_id", "same", "start", "end", "parts", mates.alias("mates"))


def in_parts(some: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
    """``some`` of a few documents at a time: their chunks as Python values take many times the batch's bytes."""
    return lambda batch: (some(batch.slice(at, 64)) for at in range(0, batch.num_rows, 64))


def around(texts: DataFrame, places: DataFrame) -> DataFrame:
    """i, s, side, at, beside: the up to AROUND bytes before (side 0, backwards) or after (side 1) the ``places`` (i, s,
    side, at) in ``texts``."""
    key = places.schema["i"].dataType.simpleString()
    asked = places.groupBy("i", "s").agg(F.collect_set(F.struct("side", "at")).alias("ats"))
    met = texts.join(asked, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("same") == F.col("s")))

    def work(batch: pa.RecordBatch):
        for row in range(batch.num_rows):
            body = batch.column("body")[row].as_py()
            asked = batch.column("ats")[row].values
            side, at = asked.field("side"), asked.field("at")
            beside = [
                body[p : p + AROUND] if right else body[max(0, p - AROUND) : p][::-1]
                for right, p in zip(side.to_pylist(), at.to_pylist())
            ]
            again = pa.array(np.full(len(beside), row))
            yield pa.RecordBatch.from_arrays(
                [batch.column("i").take(again), batch.column("s").take(again), side, at, pa.array(beside, pa.binary())],
                ["i", "s", "side", "at", "beside"],
            )

    found = by_batch(met.select("i", "s", "ats", "body"), work, f"i {key}, s long, side int, at long, beside binary")
    return found.dropDuplicates(["i", "s", "side", "at"])  # identical rows


def extended(found: DataFrame, texts: DataFrame) -> DataFrame:
    """The runs with ``more``: bytes added (left to the owner's, left, right to the owner's, right)."""
    key = found.schema["doc_id"].dataType.simpleString()
    pairs = found.select(
        F.col("doc_id"), "same", "start", "end", F.explode("mates").alias("m"),
        F.when(F.col("m.side") == 0, F.col("start")).otherwise(F.col("end")).alias("mine"),
    )
    ours = pairs.select(F.col("doc_id").alias("i"), F.col("same").alias("s"), "m.side", F.col("mine").alias("at"))
    # a table of its own: read twice, and a hot owner's place can be split in the join
    near = stored(around(texts, ours.union(pairs.select("m.i", "m.s", "m.side", "m.at"))), "around")
    at = lambda t, i, s, p: (
        F.col(i).eqNullSafe(F.col(f"{t}.i")) & (F.col(s) == F.col(f"{t}.s")) & (F.col("m.side") == F.col(f"{t}.side"))
        & (F.col(p) == F.col(f"{t}.at"))
    )
    met = (
        pairs.join(near.alias("o"), at("o", "doc_id", "same", "mine"))
        .join(near.alias("t"), at("t", "m.i", "m.s", "m.at"))
        .select("doc_id", "same", "start", "end", "m.side", "m.first", F.col("o.beside").alias("a"), F.col("t.beside").alias("b"))
    )

    def work(batch: pa.RecordBatch):
        size = []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            n = min(len(a), len(b))
            size.append(n if a[:n] == b[:n] else next(j for j in range(n) if a[j] != b[j]))
        names = ["doc_id", "same", "start", "end", "side", "first"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(size, pa.int64())], [*names, "size"])

    sizes = by_batch(met, work, f"doc_id {key}, same long, start long, end long, side int, first boolean, size long")
    best = lambda side, which: F.coalesce(F.max(F.when((F.col("side") == side) & which, F.col("size"))), F.lit(0).cast("long"))
    owners = F.col("first")
    more = sizes.groupBy(F.col("doc_id").alias("i"), F.col("same").alias("s"), F.col("start").alias("low"), F.col("end").alias("high")).agg(
        F.array(best(0, owners), best(0, F.lit(True)), best(1, owners), best(1, F.lit(True))).alias("more")
    )
    met = found.join(
        more,
        F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("same") == F.col("s")) & (F.col("start") == F.col("low")) & (F.col("end") == F.col("high")),
        "left",
    )
    return met.select("doc_id", "same", "start", "end", "parts", "more")


def removals(found: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """doc_id, same, n_repeated (bytes in runs), n_removed, spans (array of start, end), owner_ids."""
    key = found.schema["doc_id"].dataType.simpleString()
    per_doc = found.groupBy("doc_id", "same").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "parts", "more"))).alias("them")
    )

    def joined(pieces: list[tuple[int, int]]) -> list[dict]:
        out = []
        for start, end in sorted(pieces):
            if out and start <= out[-1]["end"]:
                out[-1]["end"] = max(end, out[-1]["end"])
            elif end > start:
                out.append({"start": start, "end": end})
        return out

    def some(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for them in batch.column("them").to_pylist():
            repeated, gone, ids = [], [], set()
            for run in them:
                left_own, left, right_own, right = run["more"] or (0, 0, 0, 0)
                if run["end"] - run["start"] + left + right < min_run:
                    continue
                repeated.append((run["start"] - left, run["end"] + right))
                for part in run["parts"]:  # what was added belongs to the part at that end of the run
                    start = part["start"] - left_own * (part["start"] == run["start"])
                    gone.append((start, part["end"] + right_own * (part["end"] == run["end"])))
                    ids |= {owner["i"] for owner in part["owner_ids"]}
            spans = joined(gone)
            size = lambda them: sum(x["end"] - x["start"] for x in them)
            out.append((size(joined(repeated)), size(spans), spans, sorted(ids, key=lambda i: (i is None, i))))
        n, m, spans, ids = zip(*out)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("same"),
                pa.array(n, pa.int64()),
                pa.array(m, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(ids, pa.list_(batch.column("doc_id").type)),
            ],
            ["doc_id", "same", "n_repeated", "n_removed", "spans", "owner_ids"],
        )

    schema = (
        f"doc_id {key}, same long, n_repeated long, n_removed long, "
        f"spans array<struct<start:long,end:long>>, owner_ids array<{key}>"
    )
    return by_batch(per_doc, in_parts(some), schema)


def chunk_dedup(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """doc_id, n_bytes, n_chunks, n_repeated, n_removed, n_spans, spans, owner_ids: a row for each of ``docs``."""
    packs = stored(chunked(docs), "chunks")
    repeats = stored(runs(packs), "runs")
    body = text_bytes()
    texts = docs.select("doc_id", F.xxhash64(body).alias("same"), body.alias("body"))
    found = removals(extended(repeats, texts), min_run).withColumnsRenamed({"doc_id": "i", "same": "s"})
    sizes = packs.select(F.explode("docs").alias("d")).select("d.*")
    met = sizes.join(found, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("same") == F.col("s")), "left")
    none = F.lit(0).cast("long")
    return met.select(
        "doc_id", "n_bytes", "n_chunks",
        F.coalesce("n_repeated", none).alias("n_repeated"), F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("spans", F.from_json(F.lit("[]"), "array<struct<start:long,end:long>>")).alias("spans"),
        F.coalesce("owner_ids", F.array().cast(docs.select(F.array("doc_id")).schema[0].dataType)).alias("owner_ids"),
    )


def without_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, kept (bytes) of ``docs`` without the spans of ``chunk_dedup`` (ids unique in both)."""
    key = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_bytes().alias("body")).join(found.select(F.col("doc_id").alias("i"), "spans"), F.col("doc_id").eqNullSafe(F.col("i")))

    def work(batch: pa.RecordBatch):
        kept = []
        for body, spans in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist()):
            at, out = 0, []
            for s in spans:
                out.append(body[at : s["start"]])
                at = s["end"]
            kept.append(b"".join([*out, body[at:]]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.binary())], ["doc_id", "kept"])

    return by_batch(rows.select("doc_id", "body", "spans"), work, f"doc_id {key}, kept binary")
