"""Exact duplicates by Patricia tries whose terminal nodes hold the owner.

Texts are compared without white space, byte by byte. Every task first puts
the texts of its own partition into a compressed radix trie; equal texts meet
in one terminal node, which keeps the owner (most code points in the original
text, then smallest id) and the number of rows. So a text that a third of all
rows have leaves a task as one row. These rows are dealt by length (its power of two) and
some bits of the content's hash, and a trie per such part, of many texts, merges them. A trie that
grows over ``trie_bytes`` spills: in the first tries the largest subtree under the root goes, whose
terminals leave as rows and meet their equals in the part's trie; in a part's trie, whose texts come
in the order of their hashes, every subtree is complete when the next hash comes, and all go. So memory is
bounded whatever a partition holds. Parts come sorted, so only one trie is
open at a time.

Every row then finds its owner by the SHA-256 of its text; the owners' side has
each text once, so a hot group is split by Spark's skew join.

Defined results: a NULL text counts as empty; texts of white space only are
equal to empty ones; a NULL ``doc_id`` owns a group only if no other row ties
with it; repeated rows (same id and text) are counted each and are all marked
kept where that id owns the group, and ``drop_copies`` leaves one of them; only ``doc_id``
and ``text`` are read by ``exact_groups``; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from finlake.llm.common import SPACE, packed, partitions

TRIE_BYTES = 32 << 20
#: Memory of a node beside its label.
NODE_BYTES = 250
OUT_BYTES = 8 << 20


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    at, step = 0, 64
    while at < n and a[at : at + step] == b[at : at + step]:
        at += step
        step *= 2
    end = min(at + step, n)
    while end - at > 16:
        half = (at + end) // 2
        if a[at:half] == b[at:half]:
            at = half
        else:
            end = half
    while at < n and a[at] == b[at]:
        at += 1
    return min(at, n)


class Owner:
    """The row that stays of a group so far, and how many rows there are."""

    __slots__ = ("best", "doc_id", "rows", "ties")

    def __init__(self, chars: int, doc_id, rows: int, ties: int):
        self.best, self.doc_id, self.rows, self.ties = (-chars, doc_id is None, doc_id), doc_id, rows, ties

    def add(self, other: Owner) -> None:
        self.rows += other.rows
        if other.best[:2] == self.best[:2] and other.doc_id == self.doc_id:
            self.ties += other.ties
        elif other.best < self.best:
            self.best, self.doc_id, self.ties = other.best, other.doc_id, other.ties


class Node:
    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes, owner: Owner | None = None):
        self.label, self.owner = label, owner
        self.children: dict[int, Node] = {}


class Trie:
    """Compressed radix trie over byte strings with an owner in every terminal node."""

    def __init__(self):
        self.root = Node(b"")
        self.bytes = 0
        self.under: dict[int, int] = {}  # bytes under the root, by first byte

    def insert(self, key: bytes, owner: Owner) -> None:
        node, rest, grown = self.root, key, 0
        while rest:
            child = node.children.get(rest[0])
            if child is None:
                node.children[rest[0]] = Node(rest, owner)
                grown += len(rest) + NODE_BYTES
                break
            if not rest.startswith(child.label):
                at = common_prefix(rest, child.label)
                upper = Node(child.label[:at])
                child.label = child.label[at:]
                upper.children[child.label[0]] = child
                node.children[rest[0]] = child = upper
                grown += NODE_BYTES
            rest = rest[len(child.label) :]
            node = child
        else:
            if node.owner is None:
                node.owner = owner
            else:
                node.owner.add(owner)
        if grown:
            self.bytes += grown
            self.under[key[0]] = self.under.get(key[0], 0) + grown

    def spill(self) -> Iterator[tuple[bytes, Owner]]:
        """The terminals of the largest subtree, which leaves the trie."""
        first = max(self.under, key=self.under.__getitem__)
        self.bytes -= self.under.pop(first)
        return terminals(self.root.children.pop(first))

    def drain(self) -> Iterator[tuple[bytes, Owner]]:
        root, self.root, self.bytes, self.under = self.root, Node(b""), 0, {}
        return terminals(root)


def terminals(top: Node) -> Iterator[tuple[bytes, Owner]]:
    todo = [(b"", top)]
    while todo:
        above, node = todo.pop()
        key = above + node.label
        if node.owner is not None:
            yield key, node.owner
        todo += [(key, c) for c in node.children.values()]


def _batches(found: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size; the first field is the widest."""
    rows, size = [], 0
    for row in found:
        rows.append(row)
        size += len(row[0]) + 64
        if size > OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            yield from zip(*(part.column(n).to_pylist() for n in names))


def normal_text(text: str = "text") -> F.Column:
    """The text's bytes without white space; NULL as empty."""
    return F.coalesce(F.regexp_replace(text, SPACE + "+", ""), F.lit("")).cast("binary")


def owners(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """text_sha256, keep_id, keep_chars, group_size, ties (rows with the owner's id and length)."""
    key = docs.schema["doc_id"].dataType
    local = f"norm binary, chars long, doc_id {key.simpleString()}, rows long, ties long"

    id_type = to_arrow_type(key)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            trie = Trie()
            for norm, chars, doc_id in _rows(batches, ("norm", "chars", "doc_id")):
                trie.insert(norm, Owner(chars, doc_id, 1, 1))
                while trie.bytes > trie_bytes and trie.under:
                    yield from spilled(trie.spill())
            yield from spilled(trie.drain())

        def spilled(ends: Iterator[tuple[bytes, Owner]]) -> Iterator[tuple]:
            return ((k, -o.best[0], o.doc_id, o.rows, o.ties) for k, o in ends)

        names = ("norm", "chars", "doc_id", "rows", "ties")
        types = (pa.binary(), pa.int64(), id_type, pa.int64(), pa.int64())
        yield from _batches(found(), pa.schema(list(zip(names, types))))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            trie, part, hash_ = Trie(), None, None
            for norm, n, deal, h, chars, doc_id, rows, ties in _rows(
                batches, ("norm", "n", "deal", "h", "chars", "doc_id", "rows", "ties")
            ):
                # the parts come one after the other, in each the hashes: all but the texts of the hash at hand are complete
                if (n, deal) != part or (h != hash_ and trie.bytes > trie_bytes):
                    yield from ended(trie)
                part, hash_ = (n, deal), h
                trie.insert(norm, Owner(chars, doc_id, rows, ties))
            yield from ended(trie)

        def ended(trie: Trie) -> Iterator[tuple]:
            for k, o in trie.drain():
                yield hashlib.sha256(k).hexdigest(), o.doc_id, -o.best[0], o.rows, o.ties

        names = ("text_sha256", "keep_id", "keep_chars", "group_size", "ties")
        types = (pa.string(), id_type, pa.int64(), pa.int64(), pa.int64())
        yield from _batches(found(), pa.schema(list(zip(names, types))))

    rows = docs.select(
        normal_text().alias("norm"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"), "doc_id"
    )
    deals = 4 * partitions(docs.sparkSession)
    parts = rows.mapInArrow(combine, local).withColumns(
        {"n": F.length(F.bin(F.octet_length("norm"))), "h": F.xxhash64("norm")}
    )
    parts = parts.withColumn("deal", F.pmod("h", F.lit(deals)).cast("int"))
    parts = parts.repartition("n", "deal").sortWithinPartitions("n", "deal", "h")
    schema = f"text_sha256 string, keep_id {key.simpleString()}, keep_chars long, group_size long, ties long"
    return parts.mapInArrow(merge, schema)


def exact_groups(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: a row for each of ``docs``."""
    rows = docs.select(
        "doc_id",
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"),
        F.sha2(normal_text(), 256).alias("text_sha256"),
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    return rows.join(owners(docs, trie_bytes), "text_sha256").select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one for each text."""
    rows = packed(
        docs,
        sha=F.sha2(normal_text(), 256),
        doc_id=F.col("doc_id"),
        chars=F.coalesce(F.length("text"), F.lit(0)),
    )
    kept = rows.join(
        owners(docs),
        (F.col("sha") == F.col("text_sha256"))
        & F.col("doc_id").eqNullSafe(F.col("keep_id"))
        & (F.col("chars") == F.col("keep_chars")),
    )
    # only rows that repeat an id with its text need another look
    again = kept.where("ties > 1").dropDuplicates(["sha"])
    return kept.where("ties = 1").select("row.*").unionByName(again.select("row.*"))


SQL = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
),
best AS (
  SELECT text_sha256, count(*) AS group_size,
         arg_min(doc_id, struct_pack(a := -chars, b := doc_id)) AS keep_id
  FROM rows GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM rows JOIN best USING (text_sha256)
"""
