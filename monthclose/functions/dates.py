"""Month windows, day arithmetic and zone handling."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthclose.params import ReportParams


def prior_month_bounds(as_of: dt.date) -> tuple[dt.date, dt.date]:
    """First day of the month before ``as_of`` and first day of the month of ``as_of``."""
    this_month = as_of.replace(day=1)
    return (this_month - dt.timedelta(days=1)).replace(day=1), this_month


def prior_month_end(as_of: dt.date) -> dt.date:
    return as_of.replace(day=1) - dt.timedelta(days=1)


def day_literal(day: dt.date, data_type: T.DataType) -> Column:
    """Start of ``day`` as a literal of the column's own type, so that the scan can use the predicate."""
    if isinstance(data_type, T.DateType):
        return F.lit(day)
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")
    raise TypeError(f"expected a date or timestamp_ntz column, got {data_type.simpleString()}")


def _in_order(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _first_filled(df: DataFrame, names: list[str], test) -> Column:
    """``test`` applied to the first non-null of ``names``.

    Same truth as testing ``coalesce(...)``, but spelled as an OR over plain columns: a predicate on
    ``coalesce`` stays above the scan, this one reaches the Parquet row groups.
    """
    outcome = None
    for i, name in enumerate(names):
        here = test(F.col(name), df.schema[name].dataType)
        for earlier in names[:i]:
            here = F.col(earlier).isNull() & here
        outcome = here if outcome is None else outcome | here
    return outcome


def prior_month(
    df: DataFrame, when: str | Sequence[str], as_of: dt.date, rule: str = "calendar"
) -> DataFrame:
    """Rows whose ``when`` (first non-null, if several columns are given) lies in the prior month."""
    names = _in_order(when)
    if rule == "month_number":
        return df.where(F.month(F.coalesce(*[F.col(n) for n in names])) == as_of.month - 1)
    low, high = prior_month_bounds(as_of)
    return df.where(
        _first_filled(
            df, names, lambda c, t: (c >= day_literal(low, t)) & (c < day_literal(high, t))
        )
    )


def since(df: DataFrame, when: str | Sequence[str], cutover: dt.date | None) -> DataFrame:
    """Rows from ``cutover`` on; all rows if it is ``None``."""
    if cutover is None:
        return df
    return df.where(_first_filled(df, _in_order(when), lambda c, t: c >= day_literal(cutover, t)))


def reported_month(
    df: DataFrame, when: str | Sequence[str], params: ReportParams, cutover: bool = False
) -> DataFrame:
    """The month window of a report, with the cutover test where the report has one."""
    month = prior_month(df, when, params.as_of, params.month_rule)
    return since(month, when, params.cutover) if cutover else month


def month_end_snapshot(df: DataFrame, date_col: str, as_of: dt.date) -> DataFrame:
    """Rows of a daily snapshot taken on the last day of the prior month (prunes date partitions)."""
    return df.where(F.col(date_col) == day_literal(prior_month_end(as_of), df.schema[date_col].dataType))


def delinquent_since(days_past_due: Column, as_of: dt.date) -> Column:
    """Day on which an account fell behind, seen from the end of the prior month."""
    return F.date_sub(F.lit(prior_month_end(as_of)), days_past_due.cast("int"))


def day_distance(start: Column, end: Column) -> Column:
    """Number of midnights between two times; 23:59 to 00:01 is one day."""
    return F.datediff(F.to_date(end), F.to_date(start))


def to_local(ts: Column, params: ReportParams) -> Column:
    """Wall-clock time in the reporting zone; stays ``timestamp_ntz``."""
    return F.convert_timezone(F.lit(params.source_zone), F.lit(params.local_zone), ts)


def local_date(ts: Column, params: ReportParams) -> Column:
    return F.to_date(to_local(ts, params))


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def week_start(day: Column) -> Column:
    """Monday of the week of ``day``."""
    return F.to_date(F.date_trunc("week", day))
