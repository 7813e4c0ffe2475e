"""First and latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def _sort(spec: str | Column, descending: bool) -> Column:
    if isinstance(spec, Column):
        return spec
    return F.col(spec).desc_nulls_first() if descending else F.col(spec).asc_nulls_last()


def _top_one(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    tie_break: Sequence[str] | None,
    descending: bool,
) -> DataFrame:
    """Row number 1 per key.

    The filter on the row number becomes a WindowGroupLimit below the exchange: each task forwards at
    most one row per key, so a hot key never reaches a single task with more rows than there are tasks.
    """
    named = {spec for spec in order if isinstance(spec, str)}
    rest = tie_break if tie_break is not None else [c for c in df.columns if c not in named and c not in keys]
    window = Window.partitionBy(*keys).orderBy(
        *[_sort(spec, descending) for spec in order], *[_sort(name, False) for name in rest]
    )
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def first_event(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Earliest row per key, nulls last. Ties go to the smallest ``tie_break`` values (default: all columns)."""
    return _top_one(df, keys, order, tie_break, descending=False)


def latest_event(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Latest row per key; a null order value counts as latest. Ties as in :func:`first_event`."""
    return _top_one(df, keys, order, tie_break, descending=True)


def distinct_in_order(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Distinct rows in the order of ``order``, by one exchange.

    Rows are dealt out by ranges of the order. Equal rows fall into one range, so they are made distinct where they lie,
    and each range is sorted by itself. Rows alike in all of ``order`` meet in one task, so it should name every column.
    Repeats travel to their range; where most rows are repeats, make them distinct map-side first.
    """
    return df.repartitionByRange(*order).distinct().orderBy(*order)


def with_volume(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Number of rows of a report, in total or per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("volume"))
