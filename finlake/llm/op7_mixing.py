"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

Targets: the sources, by code point with NULL last, weigh 5, 2, 1, repeating,
and share the size of the whole corpus; a target stops at ``cap`` times its
source's size and the excess is shared again by weight. That is one water
level: target = min(cap * size, weight * level), with the level that makes the
targets add up, found with running sums over the sources by cap * size / weight.

Copies: a document of a source is expected target / size times. Its whole
part is certain; the fractions are rounded so that the words taken stay on the
target. Two documents with fractions p and q meet; enough words move from one
to the other, in a random direction that keeps either's expectation, until one
fraction is 0 or 1. The other one goes on to the next meeting. Meetings form a
reduction tree: blocks of about ``BLOCK`` documents of one source are
reduced to one fraction each, then blocks of these, until one is left per
source, which is rounded at random. So a hot source is spread over as many
tasks as it has blocks, and the words taken miss a target by at most one
document (in ``mix_documents``, by at most one group of rows equal in every
column). The random numbers are hashes of the documents' ids and of the numbers
of equal rows: a rerun gives the same mix.

Defined results: a NULL or empty text has size 0 and takes 0; rows of
the same id, source and size are numbered and decided one by one, and rows equal
in every column share one decision in ``mix_documents``; NULL ids and sources are values
like others; of the columns only doc_id, text and source are read, so others
may have any name; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.common import WORD, packed, stored

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK = 64
#: Equal rows numbered at a time.
NUMBERED = 4096
#: A fraction this near to 0 or 1 counts as 0 or 1.
NEAR = 1e-9


def words() -> Column:
    return F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, target of ``sizes`` (source, source_size, one row per source)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    named = sizes.select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double").alias("weight"),
        (F.col("source_size") * cap).cast("double").alias("most"),
        F.sum("source_size").over(everything).cast("double").alias("total"),
    ).withColumn("full_at", F.col("most") / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onwards = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = named.withColumn(
        "level",
        (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onwards),
    )
    level = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(everything)
    return filled.select(
        "source", "source_size", F.coalesce(F.least("most", F.col("weight") * level), F.col("most")).alias("target")
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _meet(state: Column, other: Column) -> Column:
    """One meeting: the state is (done, now), ``now`` the one that still has a fraction."""

    def step(now: Column) -> Column:
        p, q, s, t = now["p"], other["p"], now["size"], other["size"]
        gain = F.least((1 - p) * s, q * t)  # words that can move to ``now``
        loss = F.least(p * s, (1 - q) * t)  # words that can move to ``other``
        draw = F.pmod(F.xxhash64(now["h"], other["h"]), F.lit(1 << 30)) / F.lit(float(1 << 30))
        sums = F.struct(gain.alias("gain"), loss.alias("loss"), draw.alias("draw"))
        return _let(
            sums,
            lambda m: _let(
                m["draw"] * (m["gain"] + m["loss"]) < m["loss"],
                lambda gains: F.when(p <= NEAR, end(now, 0.0, other))
                .when(p >= 1 - NEAR, end(now, 1.0, other))
                .when(q <= NEAR, end(other, 0.0, now))
                .when(q >= 1 - NEAR, end(other, 1.0, now))
                .when(gains & ((1 - p) * s <= q * t), end(now, 1.0, other.withField("p", q - m["gain"] / t)))
                .when(gains, end(other, 0.0, now.withField("p", p + m["gain"] / s)))
                .when(p * s <= (1 - q) * t, end(now, 0.0, other.withField("p", q + m["loss"] / t)))
                .otherwise(end(other, 1.0, now.withField("p", p - m["loss"] / s))),
            ),
        )

    def end(unit: Column, p: float, left: Column) -> Column:
        return F.struct(
            F.concat(state["done"], F.array(unit.withField("p", F.lit(p)))).alias("done"), left.alias("now")
        )

    return step(state["now"])


def pivotal(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """``p`` of every unit rounded to 0 or 1. ``units``: source, n (units of the source),
    unit (struct of h long, size long, p double in (0, 1), and more)."""
    largest = units.agg(F.max("n")).first()[0] or 0
    left, done, per = units, [], 1
    while True:
        per *= block
        blocks = F.ceil(F.col("n") / per).cast("long")
        at = F.pmod(F.xxhash64(F.col("unit.h"), F.lit(per)), blocks)
        # a block is about ``block`` units: the hash spreads a source evenly over its blocks
        grouped = left.groupBy("source", "n", at.alias("at")).agg(
            F.sort_array(F.collect_list(F.struct("unit.size", "unit.h", "unit"))).alias("them")
        )
        them = grouped.select("source", "n", F.transform("them", lambda x: x["unit"]).alias("them"))
        first = F.struct(F.slice("them", 1, 0).alias("done"), F.element_at("them", 1).alias("now"))
        reduced = them.select("source", "n", F.aggregate(F.slice("them", 2, 1 << 30), first, _meet).alias("r"))
        ended = F.transform("r.done", lambda u: F.struct(u.alias("unit"), F.lit(True).alias("ended")))
        open_ = F.array(F.struct(F.col("r.now").alias("unit"), F.lit(False).alias("ended")))
        level = reduced.select("source", "n", F.explode(F.concat(ended, open_)).alias("x"))
        level = stored(level.select("source", "n", "x.unit", "x.ended"), "pivotal")
        done.append(level.where("ended").select("source", "unit"))
        left = level.where(~F.col("ended")).select("source", "n", "unit")
        if per >= largest:
            break
    u = F.col("unit")
    draw = F.pmod(F.xxhash64(u["h"], F.lit("last")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    up = F.when(draw < u["p"], F.lit(1.0)).otherwise(F.lit(0.0))
    out = left.select("source", u.withField("p", up).alias("unit"))
    for part in done:
        out = out.unionByName(part)
    return out


def mix(units: DataFrame, keys: list[str], weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """keys, source, size, source_size, target, copies of ``units`` (keys, source, size long; a row per key)."""
    units = stored(units.select(*keys, "source", "size"), "units")
    sizes = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    goals = targets(sizes.select("source", "source_size"), weights, cap)
    goals = goals.join(
        sizes.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))
    ).drop("s")
    rate = F.least(F.lit(float(cap)), F.col("target") / F.col("source_size"))
    goals = goals.select(
        F.col("source").alias("goal_source"), "source_size", "target", "n",
        F.when(F.col("source_size") > 0, rate).otherwise(F.lit(0.0)).alias("rate"),
    )
    whole = F.floor(F.col("rate") + NEAR)
    wanted = units.join(goals, F.col("source").eqNullSafe(F.col("goal_source"))).select(
        *keys, "source", "size", "source_size", "target", "n", whole.alias("whole"),
        F.greatest(F.lit(0.0), F.col("rate") - whole).alias("p"),
    )
    carried = [*keys, "source_size", "target", "whole"]
    fields = [F.xxhash64(*keys).alias("h"), "size", "p", *carried]
    rounds = (F.col("p") > NEAR) & (F.col("size") > 0)
    certain = wanted.where(~rounds).select(*keys, "source", "size", "source_size", "target", F.col("whole").alias("copies"))
    rounded = pivotal(wanted.where(rounds).select("source", "n", F.struct(*fields).alias("unit")))
    u = F.col("unit")
    taken = rounded.select(
        *[u[k].alias(k) for k in keys], "source", u["size"].alias("size"), u["source_size"].alias("source_size"),
        u["target"].alias("target"), (u["whole"] + u["p"].cast("long")).alias("copies"),
    )
    return certain.unionByName(taken)


def mix_rows(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: a row for each of ``docs``."""
    rows = docs.select("doc_id", "source", words().alias("words"))
    times = rows.groupBy("doc_id", "source", "words").agg((F.count(F.lit(1)) - 1).alias("last"))
    # equal rows are numbered in blocks that are dealt out, so that no task makes all of a hot key's
    blocks = times.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("last") / NUMBERED))))
    dealt = blocks.repartition("doc_id", "source", "words", "block")
    first = F.col("block") * NUMBERED
    numbers = F.sequence(first, F.least(F.col("last"), first + NUMBERED - 1))
    units = dealt.select("doc_id", "source", "words", F.explode(numbers).alias("number"))
    mixed = mix(units.withColumn("size", F.col("words")), ["doc_id", "words", "number"])
    return mixed.select(
        "doc_id", F.col("words").alias("size"), "source_size", "target",
        (F.col("copies") * F.col("words")).alias("taken"), "copies",
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it."""
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select("doc_id", "source", words().alias("words"), hashed.alias("hash"))
    units = rows.groupBy("doc_id", "source", "words", "hash").agg(F.count(F.lit(1)).alias("times"))
    mixed = mix(units.withColumn("size", F.col("words") * F.col("times")), ["doc_id", "hash", "words", "times"])
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    chosen = mixed.where("copies > 0").select(F.col("doc_id").alias("id"), F.col("hash").alias("own"), each.alias("copy"))
    marked = packed(docs, doc_id=F.col("doc_id"), hash=hashed)
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("own"))
    return marked.join(chosen, same).select("row.*")
