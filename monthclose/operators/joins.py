"""Joins Spark has no single operator for, written as equi joins and windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthclose import fixed_values as fv
from monthclose.operators.skew import left_join
from monthclose.operators.tagged import united
from monthclose.params import SkewPolicy

_TUPLE = "__tuple"


def any_key_join(
    left: DataFrame, keys: Sequence[str], right: DataFrame, right_key: str, policy: SkewPolicy
) -> DataFrame:
    """Left outer join where any of ``keys`` may equal ``right_key``; a pair of rows matches once at most.

    An OR of equalities would compare all rows with all rows. Here each distinct tuple of left keys first learns,
    by one equi join per key against the distinct right keys, which of its keys occur on the right, and is
    unfolded to one row per such key, equal ones once, or to a single row without a key if none occurs. The left
    rows themselves are shuffled twice: to their tuple, and to the right rows. ``right_key`` is kept, other column
    names must differ between the sides.
    """
    present = right.select(right_key).dropna().distinct()
    hits = {key: f"__hit_{i}" for i, key in enumerate(keys)}
    together = F.struct(*[F.col(k) for k in keys])  # equal as a value also where a key is null
    tuples = left.select(*keys).distinct()
    for key, hit in hits.items():
        tuples = left_join(tuples, present.select(F.col(right_key).alias(key), F.lit(True).alias(hit)), [key], policy)
    occurring = F.array_distinct(F.array_compact(F.array(*[F.when(F.col(hit), F.col(key)) for key, hit in hits.items()])))
    unfolded = tuples.select(together.alias(_TUPLE), F.explode_outer(occurring).alias(right_key))
    rows = left_join(left.withColumn(_TUPLE, together), unfolded, [_TUPLE], policy).drop(_TUPLE)
    return left_join(rows, right, [right_key], policy, hot_in=right)


def near_day_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    days: int,
) -> DataFrame:
    """Inner equi join on ``key``, right rows lying 0 to ``days`` calendar days before the left row.

    Each left row is unfolded to its ``days + 1`` candidate days, so the day is part of the hash key and
    a busy key is spread over its days; no pair outside the range is ever formed.
    """
    day = "__day"
    unfolded = left.withColumn(
        day,
        F.explode(
            F.sequence(F.date_sub(F.to_date(left_time), days), F.to_date(left_time))
        ),
    )
    dated = right.withColumn(day, F.to_date(right_time))
    return unfolded.join(dated, [key, day]).drop(day)


def interval_in_force(
    facts: DataFrame,
    intervals: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    values: Sequence[str],
    policy: SkewPolicy,
    segment: str = "month",
) -> DataFrame:
    """``facts`` plus ``values`` of the interval with ``start <= at < end`` (null ``end`` = open).

    Where several intervals cover a fact, the one ending last wins, then the one starting last, then the
    largest values; a fact covered by none gets nulls. One row out per fact.

    Starts and times of facts are laid on one time line per key, and a running maximum of (end, start, values) over
    the intervals started so far yields the winner: if the last-ending one has expired, so have all others. Equal
    starts, and equal times of facts, are combined map-side first.

    The line is cut into segments of time (``segment``, as ``date_trunc`` names it) and the maximum taken in two
    passes. The first gives each segment its own maximum, and a running maximum over a key's segments, one row each,
    what is carried into the next. The second scans every segment by itself, the carried maximum in front. So a key
    that holds a third of all rows, all at distinct times, is spread over as many tasks as it has segments. The facts
    themselves meet the line by an equi join on (key, time), which can be split, instead of being compared with
    every interval of their key.
    """
    part, kind, best, time, open_end = "__segment", "__kind", "__best", "__time", "__end"
    carried_kind, interval_kind, fact_kind = 0, 1, 2

    def segment_of(at: Column) -> Column:
        return F.date_trunc(segment, at).cast("date")

    winner = F.struct(
        F.coalesce(F.col(end), F.lit(fv.OPEN_END).cast("timestamp_ntz")).alias(open_end),
        F.col(start).alias("__start"),
        *[F.col(v) for v in values],
    )
    started = {key: F.col(key), part: segment_of(F.col(start)), kind: F.lit(interval_kind), time: F.col(start), best: winner}
    asked = {key: F.col(key), part: segment_of(F.col(at)), kind: F.lit(fact_kind), time: F.col(at)}

    def without_time(columns: dict[str, Column]) -> dict[str, Column]:
        return {name: column for name, column in columns.items() if name not in (time, kind)}

    has_fact = "__has_fact"
    segments = united(
        [(intervals, without_time(started)), (facts, without_time(asked) | {has_fact: F.lit(True)})], [key, part], F.max
    )
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        segments.withColumn(best, F.max(best).over(before))
        .where(F.col(has_fact) & F.col(best).isNotNull())
        .select(key, part, F.lit(carried_kind).alias(kind), best)
    )
    line = united([(intervals, started), (facts, asked)], [key, part, kind, time], F.max)
    # What is carried has no time and comes first; at equal times intervals come before facts.
    running = (
        Window.partitionBy(key, part)
        .orderBy(F.col(time).asc_nulls_first(), kind)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    winners = (
        line.unionByName(carried, allowMissingColumns=True)
        .withColumn(best, F.max(best).over(running))
        .where(F.col(kind) == fact_kind)
        .select(key, F.col(time).alias(at), best)
    )
    in_force = F.col(at) < F.col(best)[open_end]
    return left_join(facts, winners, [key, at], policy).select(
        *[F.col(c) for c in facts.columns],
        *[F.when(in_force, F.col(best)[v]).alias(v) for v in values],
    )
