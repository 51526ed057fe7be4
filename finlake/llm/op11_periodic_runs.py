"""Periodic runs of words: suffix classes united by descending common prefix.

A run is a stretch of words with smallest period q, of at least ``max(least, 2 * q)`` words, that
neither neighbour extends. Per text: suffixes are sorted (rank doubling on numbers for
words), the common prefix of neighbours in that order is measured, and neighbours are
united from the longest common prefix down, as Kruskal's algorithm takes edges. Each
class (union-find) keeps its positions in order, the smaller set going into the larger.
Two positions i < j that become adjacent when classes unite at prefix length m have
exactly m words in common; if j - i <= m, the words from i to j + m repeat with period
j - i, and with another word before i than before j this is a run, whole:

* every run is met: its first two periods start at positions whose common prefix is
  the run's length less q, and a position between them in their class would give the run
  a smaller period;
* the period is the smallest one: with a smaller one, i plus that period would stand
  between i and j in the class.

Runs of ``least`` words need a common prefix of ``least / 2`` or more, so shorter prefixes unite
nothing. A text in which no window of that many words occurs twice has no run; such
texts, most of them, are not sorted at all.

A run's first q words are kept, the others are dropped (``collapsed``), which a word is as
soon as one run drops it.

Defined results: a NULL or empty text, or one of white space, has no words, no run and an empty
``collapsed``; a NULL ``doc_id`` stays NULL; equal rows give equal results; only ``doc_id``
and ``text`` are read; an empty table gives an empty one. Documents do not meet:
the work is a map, at most ``STEP`` bytes of texts at a time, or one longer text.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.common import WORD, by_batch, text_bytes

#: Words of the shortest run.
LEAST = 12
#: Bytes of text handled at a time inside a task.
STEP = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_windows(ids: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """The texts (``owner`` of each word, ascending) in which a window of ``size`` words occurs twice,
    by a 64-bit hash: a chance hit only means that a text is sorted for nothing."""
    n = len(ids) - size + 1
    if n < 2:
        return np.zeros(0, owner.dtype)
    window = owner[:n].astype(np.uint64)
    words = ids.astype(np.uint64)
    for k in range(size):
        window = (window + words[k : n + k]) * _MIX
        window ^= window >> np.uint64(29)
    whole = owner[:n] == owner[size - 1 :]
    window, texts = window[whole], owner[:n][whole]
    ordered = np.sort(window)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(0, owner.dtype)
    at = np.minimum(np.searchsorted(twice, window), len(twice) - 1)
    return np.unique(texts[twice[at] == window])


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """The suffixes of a sequence in lexicographic order, by rank doubling."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1  # 0: past the end
    width = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: max(0, n - width)] = rank[width:]
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        steps = np.cumsum(np.r_[True, ranked[1:] != ranked[:-1]])
        if steps[-1] == n or width >= n:
            return order
        rank[order] = steps
        width *= 2


def common_prefixes(ids: list[int], order: np.ndarray) -> np.ndarray:
    """Per place in the order, the words in common with the suffix in the place before (Kasai's way)."""
    n = len(ids)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    found = [0] * n
    h = 0
    for i, j in enumerate(before.tolist()):
        if j < 0:
            h = 0
            continue
        top = n - (i if i > j else j)
        while h < top and ids[i + h] == ids[j + h]:
            h += 1
        found[i] = h
        if h:
            h -= 1
    return np.array(found, np.int64)[order]


def runs_of(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of numbers, by start, then period."""
    half = (least + 1) // 2
    if len(ids) < max(least, 2):
        return []
    order = suffix_order(ids)
    words = ids.tolist()
    prefix = common_prefixes(words, order)
    edges = np.flatnonzero(prefix >= max(half, 1))
    edges = edges[np.argsort(-prefix[edges], kind="stable")]
    places = order.tolist()
    parent = list(range(len(places)))
    members: dict[int, list[int]] = {}
    runs: list[tuple[int, int, int]] = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def seed(i: int, j: int, m: int) -> None:
        q = j - i
        if q <= m and q + m >= least and (i == 0 or words[i - 1] != words[j - 1]):
            runs.append((i, q + m, q))

    for edge, m in zip(edges.tolist(), prefix[edges].tolist()):
        a, b = root(edge - 1), root(edge)
        into = members.pop(a, None) or [places[a]]
        small = members.pop(b, None) or [places[b]]
        if len(into) < len(small):
            a, b, into, small = b, a, small, into
        if len(small) == 1:
            x = small[0]
            k = bisect_left(into, x)
            if k:
                seed(into[k - 1], x, m)
            if k < len(into):
                seed(x, into[k], m)
            into.insert(k, x)
        else:
            before = -1
            for x, after in zip(small, [*small[1:], None]):
                k = bisect_left(into, x)  # adjacent: no other position of the smaller set lies between
                if k and before < into[k - 1]:
                    seed(into[k - 1], x, m)
                if k < len(into) and (after is None or into[k] < after):
                    seed(x, into[k], m)
                before = x
            into = sorted(into + small)  # two ascending runs: one merge
        parent[b] = a
        members[a] = into
    return sorted(runs, key=lambda r: (r[0], r[2]))


def text_runs(texts: list[bytes], least: int = LEAST) -> tuple[list[list[bytes]], dict[int, list[tuple[int, int, int]]]]:
    """The words of each text, and the runs of the texts that have any."""
    split = [t.split() for t in texts]  # bytes split at the ASCII white space
    number: dict[bytes, int] = {}
    flat = [number.setdefault(w, len(number)) for words in split for w in words]
    ids = np.array(flat, np.int64)
    sizes = np.array([len(w) for w in split], np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(split)), sizes)
    found = {}
    for t in repeated_windows(ids, owner, max(1, (least + 1) // 2)).tolist():
        runs = runs_of(ids[ends[t] - sizes[t] : ends[t]], least)
        if runs:
            found[t] = runs
    return split, found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


RUN = "struct<start:long,length:long,period:long>"


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period; by start, then period), collapsed (the kept words)."""
    key = docs.schema["doc_id"].dataType.simpleString()
    run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def work(batch: pa.RecordBatch):
        body = batch.column("body")
        sizes = np.asarray(pc.binary_length(body)).astype(np.int64)
        groups = np.cumsum(sizes) // STEP
        edges = [*np.flatnonzero(np.diff(groups, prepend=-1)).tolist(), len(sizes)]
        for low, high in zip(edges, edges[1:]):
            words, found = text_runs(body[low:high].to_pylist(), least)
            runs = [[dict(zip(("start", "length", "period"), r)) for r in found.get(t, ())] for t in range(len(words))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id")[low:high],
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array(runs, pa.list_(run)),
                    pa.array([collapsed(w, found.get(t, ())) for t, w in enumerate(words)], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    schema = f"doc_id {key}, n_words long, runs array<{RUN}>, collapsed string"
    return by_batch(docs.select("doc_id", text_bytes().alias("body")), work, schema)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text. With h = crc32 of the decimal id and g = h div 10, the text of a document with h % 10 = 0
    repeats itself from its word a = g % n on, with period 1 + (n - a) div (3 + g % 8);
    every other text stays as it is, as does that of a NULL id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words").cast("long")).withColumn("g", F.floor(F.col("h") / 10))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))

    def word(x: F.Column, i: F.Column) -> F.Column:
        at = F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
        return F.get("words", at.cast("int"))

    made = F.array_join(F.transform("words", word), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the greatest run (start, length, period, exponent_milli), runs_sha256, collapsed_sha256."""
    best = F.array_min(
        F.transform(
            "runs", lambda r: F.struct((-r["length"]).alias("m"), r["start"].alias("start"), r["period"].alias("period"))
        )
    )
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = found.withColumn("best", best)
    length, period = -F.col("best.m"), F.col("best.period")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        length.alias("length"), period.alias("period"),
        F.floor(F.expr("-best.m * 1000 div best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
