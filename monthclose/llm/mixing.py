"""Mixing sources to target weights by entropy balancing.

Sources share ``share`` times all words by weight, none more than ``limit`` times its own; what exceeds that is
shared among the others by weight. Each document then gets a rate: among all rates between 0 and ``limit`` that
bring every source to its target, the ones closest in entropy to leaving the corpus as it is. By convex duality
these are ``min(limit, exp(tilt * size))`` with one multiplier per source, found by Newton steps on the dual,
each a distributed sum over (source, size) classes, inside a bracket that makes every step safe.

Rates are rounded into whole copies class by class, in ranges of size that are rounded side by side: a class takes
the number of copies nearest to its share of words plus what larger classes of its range are short of. What a whole
range is short of is then carried down the ranges of its source, so a source misses its target by less than its small
documents. Within a class, documents are told apart by a hash of id and text, so reruns agree. A class that holds more
than ``HOT_SHARE`` of all rows is dealt into parts of about that many.

Defined results: a null text has size 0 and is never copied (nor is any document without words); null sources
form one source, sorted last; rows that agree in id and text get equal copies; an empty table, or one without
words, gives targets 0. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthclose.llm.common import WORD, carried, settle, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
LIMIT = 2
#: Documents of one source and size that are more than this share of all rows are dealt into parts of about that share;
#: there are at most 1 / HOT_SHARE such classes.
HOT_SHARE = 1 / 4_096
#: Ranges of size: sizes that agree in their leading bits, this many; smaller sizes are ranges of their own.
RANGE_BITS = 7
TOLERANCE = 1e-7
MAX_STEPS = 60

CLASS = ["source", "size", "part"]


def size_of(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def measured(rows: DataFrame) -> DataFrame:
    """``rows`` (row) plus source, size and a hash that orders the documents of a class."""
    draw = F.xxhash64("row.doc_id", "row.text", F.lit(6))
    source = F.col("row.source").cast("string")
    return rows.withColumns({"source": source, "size": size_of("row.text"), "draw": draw})


def hot_classes(sizes: DataFrame, share: float = HOT_SHARE) -> DataFrame:
    """(h, hz, parts): the source and size of which more than ``share`` of all rows are, and into how many parts they
    are dealt. At most 1 / share rows."""
    counts = settle(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    rows = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first().rows
    most = max(1.0, rows * share)
    parts = F.ceil(F.col("n") / F.lit(most)).cast("int")
    return settle(counts.where(F.col("n") > most).select(F.col("source").alias("h"), F.col("size").alias("hz"), parts.alias("parts")))


def dealt(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` (source, size, draw) plus the part of their class."""
    same = rows["source"].eqNullSafe(F.col("h")) & (rows["size"] == F.col("hz"))
    part = F.coalesce(F.pmod(F.col("draw"), F.col("parts")), F.lit(0)).cast("int")
    return rows.join(F.broadcast(hot), same, "left").withColumn("part", part).drop("h", "hz", "parts")


def classes_of(sizes: DataFrame) -> DataFrame:
    """(source, size, part, n) of the rows of ``sizes``; the whole corpus becomes a table of distinct sizes."""
    return settle(sizes.groupBy(*CLASS).agg(F.count(F.lit(1)).alias("n")))


def targets(classes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT):
    """(source, source_size, target), one row per source.

    Taking from the source that reaches its limit first, the level at which the rest of the words is shared is
    what is left over the weights left; a source ends at its limit if its limit lies below weight times level.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = (
        classes.groupBy("source")
        .agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
        .withColumn("weight", F.get(cycle, (rank % len(weights)).cast("int")))
        .withColumn("cap", F.col("source_size") * float(limit))
    )
    everything = Window.partitionBy()
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levelled = sources.withColumn("level", level)
    uncapped = F.col("cap") >= F.col("weight") * F.col("level")
    final = F.min_by(F.when(uncapped, F.col("level")), F.when(uncapped, F.col("cap") / F.col("weight"))).over(everything)
    return levelled.withColumn("final", final).select(
        "source",
        "source_size",
        F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * F.col("final"))).alias("target"),
    )


def tilts(classes: DataFrame, goals: DataFrame, limit: float = LIMIT, tolerance: float = TOLERANCE) -> DataFrame:
    """(source, source_size, target, scale, tilt): rates are min(limit, exp(tilt * size / scale)).

    Newton steps on the logarithm of the words taken, for all sources at once: a step is one distributed sum per
    source over the classes, and the driver holds one multiplier per source (the parts a corpus is mixed from, not
    documents). A step that leaves the bracket found so far is replaced by halving it. A source whose target is its
    limit gets rate ``limit`` throughout (tilt is infinite), one without words keeps tilt 0.
    """
    spark = classes.sparkSession
    longest = classes.groupBy("source").agg(F.max("size").cast("double").alias("scale")).withColumnRenamed("source", "s")
    state = goals.join(longest, goals.source.eqNullSafe(F.col("s"))).drop("s").orderBy(F.col("source").asc_nulls_last()).collect()
    source = [r.source for r in state]
    size, target = (np.array([float(r[c]) for r in state]) for c in ("source_size", "target"))
    scale = np.maximum(np.array([r.scale for r in state], float), 1.0)
    full = target >= size * limit * (1 - 1e-12)
    tilt = np.where(full & (size > 0), math.inf, 0.0)
    low, high = np.full(len(state), -math.inf), np.full(len(state), math.inf)
    left = np.flatnonzero(~full)
    for _ in range(MAX_STEPS):
        if not len(left):
            break
        asked = spark.createDataFrame(
            [(source[i], int(i), float(scale[i]), float(tilt[i])) for i in left], "s string, i long, scale double, tilt double"
        )
        x = F.col("size") / F.col("scale")
        rate = F.least(F.exp(F.col("tilt") * x), F.lit(float(limit)))
        words = F.col("n") * F.col("size")
        sums = (
            classes.join(F.broadcast(asked), classes.source.eqNullSafe(F.col("s")))  # one row per source
            .groupBy("i")
            .agg(F.sum(words * rate).alias("taken"), F.sum(F.when(rate < limit, words * x * rate).otherwise(0.0)).alias("slope"))
            .collect()
        )
        at = np.array([r.i for r in sums])
        taken, slope = np.array([r.taken for r in sums]), np.array([r.slope for r in sums])
        near = np.abs(taken - target[at]) <= tolerance * target[at]
        below = taken < target[at]
        low[at] = np.where(below, tilt[at], low[at])
        high[at] = np.where(below, high[at], tilt[at])
        with np.errstate(all="ignore"):
            newton = tilt[at] - np.log(taken / target[at]) * taken / slope
            halved = np.where(
                np.isinf(low[at]), high[at] * 2 - 2, np.where(np.isinf(high[at]), low[at] * 2 + 2, (low[at] + high[at]) / 2)
            )
            inside = (slope > 0) & (newton > low[at]) & (newton < high[at])
        tilt[at] = np.where(near, tilt[at], np.where(inside, newton, halved))
        left = at[~near]
    # Sums of doubles depend on their order in the last digits; the multipliers must not.
    rows = [
        (source[i], int(state[i].source_size), float(target[i]), float(scale[i]), float(np.round(tilt[i], 8)))
        for i in range(len(state))
    ]
    return spark.createDataFrame(rows, "source string, source_size long, target double, scale double, tilt double")


def range_of(size: Column) -> Column:
    """Number of the range of a size: its bits but for the leading ``RANGE_BITS``, and these. Larger sizes have larger
    numbers; a source has at most 2**(RANGE_BITS - 1) ranges for each bit of its largest size."""
    spare = F.greatest(F.length(F.bin(size)) - RANGE_BITS, F.lit(0))
    leading = F.floor(size / F.pow(F.lit(2.0), spare)).cast("long")
    return (spare * (1 << RANGE_BITS) + leading).cast("int")


def _round_range(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies of each class of one range, largest documents first; what a class is short of is carried to the next
    one, and what the last one is short of stands in every row."""
    rows = rows.sort_values(["size", "part"], ascending=[False, True])
    copies, carry = [], 0.0
    for size, n, rate, limit in zip(rows["size"], rows["n"], rows["rate"], rows["limit"], strict=True):
        wanted = n * rate * size + carry
        take = int(min(max(round(wanted / size), 0), limit * n))
        copies.append(take)
        carry = wanted - take * size
    return rows.assign(copies=copies, short=carry)[["source", "size", "part", "n", "band", "limit", "copies", "short"]]


def _carry_down(bands: pd.DataFrame) -> pd.DataFrame:
    """What the ranges of one source are short of, from large to small: each adds or takes copies of its class of
    smallest size as far as that has room, and hands on the rest. A source has a few thousand ranges at most."""
    bands = bands.sort_values("band", ascending=False)
    more, carry = [], 0.0
    for size, n, limit, copies, short in zip(*(bands[c] for c in ("size", "n", "limit", "copies", "short")), strict=True):
        carry += short
        extra = int(min(max(round(carry / size), -copies), limit * n - copies))
        more.append(extra)
        carry -= extra * size
    return bands.assign(more=more).rename(columns={"source": "s", "size": "z", "part": "p"})[["s", "z", "p", "more"]]


def rounded(rated: DataFrame) -> DataFrame:
    """(source, size, part, n, copies) of classes with their rate and limit."""
    ranged = settle(
        rated.withColumn("band", range_of(F.col("size")))
        .groupBy("source", "band")
        .applyInPandas(_round_range, "source string, size long, part int, n long, band int, limit long, copies long, short double")
    )
    last = F.min(F.struct("size", "part", "n", "limit", "copies", "short")).alias("last")
    more = (
        ranged.groupBy("source", "band").agg(last).select("source", "band", "last.*")
        .groupBy("source")
        .applyInPandas(_carry_down, "s string, z long, p int, more long")
        .where("more <> 0")
    )
    same = ranged.source.eqNullSafe(F.col("s")) & (ranged["size"] == F.col("z")) & (ranged.part == F.col("p"))
    copies = F.col("copies") + F.coalesce("more", F.lit(0))
    return ranged.join(more, same, "left").select(*CLASS, "n", copies.alias("copies"))


def copy_plan(sizes: DataFrame, classes: DataFrame, solved: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(source, size, part, base, last_draw, target, source_size): each document of the class gets ``base`` copies,
    and one more if its draw does not exceed ``last_draw``."""
    rate = F.least(F.exp(F.col("tilt") * F.col("size") / F.col("scale")), F.lit(float(limit)))
    tilted = solved.withColumnRenamed("source", "s")
    rated = (
        classes.join(tilted, classes.source.eqNullSafe(F.col("s")))
        .where("size > 0")
        .select(*CLASS, "n", rate.alias("rate"), F.lit(limit).cast("long").alias("limit"))
    )
    planned = settle(
        rounded(rated).select(
            *CLASS,
            F.expr("copies div n").alias("base"),
            (F.col("copies") % F.col("n")).alias("extra"),
        )
    )
    some = planned.where("extra > 0").select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("part").alias("p"), "extra")
    order = Window.partitionBy(*CLASS).orderBy("draw")
    last = (
        sizes.join(some, sizes.source.eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("part") == F.col("p")))
        .withColumn("place", F.row_number().over(order))
        .where("place = extra")
        .select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("part").alias("p"), F.col("draw").alias("last_draw"))
    )
    return settle(
        planned.join(
            last,
            planned.source.eqNullSafe(last.s) & (planned["size"] == last.z) & (planned.part == last.p),
            "left",
        ).select(*CLASS, "base", "last_draw")
    )


def balanced(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: int = LIMIT):
    """The plan of ``copy_plan`` for ``docs``, the sizes it was made from, the solved sources and the hot classes."""
    rows = measured(carried(docs.select("doc_id", "source", "text")))
    narrow = settle(rows.select(F.col("row.doc_id").alias("doc_id"), "source", "size", "draw"))
    hot = hot_classes(narrow)
    sizes = dealt(narrow, hot)
    classes = classes_of(sizes)
    solved = tilts(classes, targets(classes, weights, share, limit), limit)
    return copy_plan(sizes, classes, solved, limit), sizes, solved, hot


def copies_of(base: Column, last_draw: Column, draw: Column) -> Column:
    return F.coalesce(base, F.lit(0)) + F.coalesce((draw <= last_draw).cast("int"), F.lit(0))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row."""
    plan, sizes, solved, _ = balanced(docs, weights, share, limit)
    plan = plan.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("part").alias("p"), "base", "last_draw")
    goal = solved.select(F.col("source").alias("g"), "source_size", "target")
    copied = sizes.join(
        plan, sizes.source.eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("part") == F.col("p")), "left"
    ).join(goal, sizes.source.eqNullSafe(F.col("g")))
    copies = copies_of(F.col("base"), F.col("last_draw"), F.col("draw"))
    return copied.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def mixed_rows(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: int = LIMIT):
    """``docs`` with every row repeated as often as the mix takes it; all columns as they came, whatever their names."""
    plan, _, _, hot = balanced(docs, weights, share, limit)
    plan = plan.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("part").alias("p"), "base", "last_draw")
    rows = dealt(measured(carried(docs)), hot)
    same = rows.source.eqNullSafe(F.col("s")) & (rows["size"] == F.col("z")) & (rows.part == F.col("p"))
    copies = copies_of(F.col("base"), F.col("last_draw"), F.col("draw")).cast("int")
    taken = rows.join(plan, same).withColumn("copies", copies).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
