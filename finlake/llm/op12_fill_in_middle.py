"""Fill-in-middle: a text cut in three at ends of units, its middle moved to the end.

The cuts are found by rank and select on 64-bit words. The UTF-8 bytes of many texts
lie in one buffer, read as little-endian words of eight bytes; the bytes that end a
unit are marked by arithmetic on whole words, the marks of each word are counted
(``bitwise_count``) and summed up, the word that holds the wanted mark is found by
search in these sums, and the mark inside it by clearing the lower ones. Code points
are counted in the same way, by marks on continuation bytes. No text is split.

A unit is a line (``[^\\n]*\\n|[^\\n]+``) or a code point. Where the cuts go is drawn
from a hash of the id, so reruns agree: h1 to h4 are the first four 8-digit groups of
the hex sha256 of ``<seed>:<doc_id>``; with n units the prefix ends after the smaller of
h1 % (n + 1) and h2 % (n + 1) of them, the middle after the larger. A share of the
texts stays as it is (h3), and a share of the others has its suffix first (h4).

Defined results: a NULL text is empty; an empty text, and one that contains one of the
three marks, stays plain; a NULL ``doc_id`` hashes as an empty one and stays NULL; equal rows
give equal results; only ``doc_id`` and ``text`` are read, so further columns may have
any name; an empty table gives an empty one. A text may be as long as Spark allows:
a task handles ``STEP`` bytes at a time, or one longer text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of text handled at a time inside a task.
STEP = 8 << 20

_EACH = np.uint64(0x0101010101010101)
_HIGH, _LOW = _EACH * np.uint64(0x80), _EACH * np.uint64(0x7F)
_ONE, _EIGHT = np.uint64(1), np.uint64(8)


def newlines(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a line feed (no byte of a longer code point is)."""
    odd = words ^ _EACH * np.uint64(0x0A)
    return ~(((odd & _LOW) + _LOW) | odd | _LOW)


def continuations(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte 10xxxxxx, which goes on with a code point."""
    return words & ~(words << _ONE) & _HIGH


def code_point_ends(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte before one that starts a code point."""
    starts = ~continuations(words) & _HIGH
    after = np.append(starts[1:], _HIGH)
    return starts >> _EIGHT | after << np.uint64(56)


UNITS = {"line": newlines, "char": code_point_ends}


class Marks:
    """Rank and select on bytes that are marked by their high bit (the last word holds the buffer's end)."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` bytes are marked."""
        word = at >> 3
        below = (_ONE << ((at & 7) << 3).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The place of the marked byte with ``k`` marked ones before it."""
        word = np.searchsorted(self.before, k, "right") - 1
        left, marks = k - self.before[word], self.words[word]
        for step in range(7):
            marks = np.where(left > step, marks & (marks - _ONE), marks)
        lowest = marks & (~marks + _ONE)
        return (word << 3) + (np.bitwise_count(lowest - _ONE) >> 3)


def cut_points(data: np.ndarray, ends: np.ndarray, first: np.ndarray, second: np.ndarray, unit: str):
    """Per text (``data`` up to its entry of ``ends``, from the one before): the number n of units,
    the bytes up to the lower and the higher of the two cuts, and the code points in front
    of the first cut and between them. ``first`` and ``second`` are taken modulo n + 1."""
    words = np.zeros(len(data) // 8 + 1, "<u8")
    words.view(np.uint8)[: len(data)] = data
    units, inner = Marks(UNITS[unit](words)), Marks(continuations(words))
    starts = np.r_[0, ends[:-1]]
    low, high = units.rank(starts), units.rank(ends)
    marked = high - low
    last = np.zeros(len(ends), np.int64)
    some = marked > 0
    last[some] = units.select(high[some] - 1) + 1
    n = marked + ((ends > starts) & (~some | (last < ends)))  # what follows the last mark is a unit, too

    def place(k: np.ndarray) -> np.ndarray:
        at = np.where(k == 0, starts, ends)
        inside = (k > 0) & (k <= marked)
        at[inside] = units.select(low[inside] + k[inside] - 1) + 1
        return at

    one, two = first % (n + 1), second % (n + 1)
    a, b = place(np.minimum(one, two)), place(np.maximum(one, two))
    ranks = [at - inner.rank(at) for at in (starts, a, b)]
    return n, a - starts, b - starts, ranks[1] - ranks[0], ranks[2] - ranks[1]


CUT = "n long, prefix_bytes long, middle_end long, prefix_chars long, middle_chars long"


def cuts_of(body: pa.Array, first: pa.Array, second: pa.Array, unit: str) -> pa.StructArray:
    """``cut_points`` of an Arrow array of UTF-8 bytes, some texts at a time."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(body), 0)).astype(np.int64)
    groups = np.cumsum(sizes) // STEP
    edges = np.flatnonzero(np.diff(groups, prepend=-1, append=groups[-1] + 1 if len(groups) else 0))
    one, two = (np.asarray(x.fill_null(0)).astype(np.int64) for x in (first, second))
    parts = []
    for low, high in zip(edges[:-1], edges[1:]):
        data = np.frombuffer(b"".join(v for v in body[low:high].to_pylist() if v), np.uint8)
        parts.append(cut_points(data, np.cumsum(sizes[low:high]), one[low:high], two[low:high], unit))
    found = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5
    names = [f.split()[0] for f in CUT.split(", ")]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in found], names)


def cuts(text: Column, first: Column, second: Column, unit: str = "line") -> Column:
    """The struct ``CUT`` of a text: where its prefix and its middle end."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {sorted(UNITS)}")

    @F.arrow_udf(f"struct<{CUT.replace(' ', ':').replace(',:', ',')}>")
    def found(body: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        return cuts_of(body, one, two, unit)

    return found(text.cast("binary"), first, second)


def draws(seed: int) -> list[Column]:
    """h1 to h4 of a document."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, seed: int = 7, fim_percent: int = 100, spm_percent: int = 50, unit: str = "line"
) -> DataFrame:
    """doc_id, n, form (plain, psm or spm), prefix_chars, middle_chars, output (the text to train on)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), *[h.alias(f"h{k}") for k, h in enumerate(draws(seed), 1)])
    rows = rows.withColumn("cut", cuts(F.col("text"), F.col("h1"), F.col("h2"), unit))
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    plain = (F.col("text") == "") | marked | (F.pmod("h3", F.lit(100)) >= fim_percent)
    form = F.when(plain, "plain").when(F.pmod("h4", F.lit(100)) < spm_percent, "spm").otherwise("psm")
    rows = rows.withColumn("form", form)

    def piece(start: Column, end: Column) -> Column:
        return F.substring(F.col("text").cast("binary"), start.cast("int") + 1, (end - start).cast("int")).cast("string")

    a, b = F.col("cut.prefix_bytes"), F.col("cut.middle_end")
    prefix, middle = piece(F.lit(0), a), piece(a, b)
    suffix = piece(b, F.octet_length("text"))
    output = (
        F.when(F.col("form") == "plain", F.col("text"))
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    moved = F.col("form") != "plain"
    return rows.select(
        "doc_id", F.col("cut.n").alias("n"), "form",
        F.when(moved, F.col("cut.prefix_chars")).alias("prefix_chars"),
        F.when(moved, F.col("cut.middle_chars")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text again, from the output and its form alone: each mark occurs once, because a text that
    has one stays plain, and no mark can begin in one piece and end in the next."""
    low = len(PREFIX)

    def between(start: Column, end: Column) -> Column:
        return F.substring(output, start, end - start)

    s, p, m = (F.instr(output, mark) for mark in (SUFFIX, PREFIX, MIDDLE))
    middle = between(m + low, F.length(output) + 1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(between(p + low, s), middle, between(s + low, m)))
        .otherwise(F.concat(between(p + low, m), middle, between(s + low, p)))
    )


def fim_digests(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``fill_in_middle`` with digests in place of the texts."""
    made = fill_in_middle(docs, **options)
    again = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(again.cast("binary"), 256).alias("restored_sha256"),
    )


SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines
  FROM documents
),
drawn AS (
  SELECT *, len(lines) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM docs
),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
),
cut AS (
  SELECT *, array_to_string(list_slice(lines, 1, a), '') AS pre, array_to_string(list_slice(lines, a + 1, b), '') AS mid,
         array_to_string(list_slice(lines, b + 1, n), '') AS suf
  FROM formed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
