"""Report parameters: the as-of date takes the place of the clock in every report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from monthclose import fixed_values as fv

MONTH_RULES = ("calendar", "month_number")


@dataclass(frozen=True)
class Program:
    """One card programme and the names it goes by in the different sources."""

    comb_name: str = fv.PROGRAM_COMB_NAME
    brand_names: tuple[str, ...] = fv.PROGRAM_BRAND_NAMES
    brand_ids: tuple[str, ...] = fv.PROGRAM_BRAND_IDS
    charge_off_names: tuple[str, ...] = fv.PROGRAM_CHARGE_OFF_NAMES
    canvas_pattern: str = fv.CANVAS_NAME_PATTERN


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as hot, and into how many parts its rows are split.

    A key is hot if it holds more than ``share`` of all rows of the side looked at, whatever their number. Not
    given, it is a quarter of what one of ``spark.sql.shuffle.partitions`` holds on average. The share bounds the
    number of hot keys by ``1 / share`` whatever the data size, which is what makes them safe to broadcast.

    ``clustered`` names the join keys by which both sides are stored in buckets (``Sources.clustered`` finds them): joins
    on these keep the stored partitioning and get no salt.
    """

    share: float | None = None
    salts: int = 64
    clustered: frozenset[tuple[str, ...]] = frozenset()

    def share_of(self, shuffle_partitions: int) -> float:
        return self.share if self.share is not None else 1 / (4 * max(1, shuffle_partitions))

    def __post_init__(self):
        if self.share is not None and not 0 < self.share <= 1:
            raise ValueError("share must lie in (0, 1]")
        if self.salts < 1:
            raise ValueError("salts must be at least 1")


@dataclass(frozen=True)
class ReportParams:
    """Everything a report needs besides its sources.

    ``month_rule='calendar'`` selects the calendar month before ``as_of``; ``'month_number'`` compares
    bare month numbers (any year; nothing in January) and exists for parity runs.
    ``cutover`` is the first day the programme is reported on; ``None`` switches the test off.
    """

    as_of: dt.date
    cutover: dt.date | None = dt.date.fromisoformat(fv.CUTOVER)
    program: Program = field(default_factory=Program)
    month_rule: str = "calendar"
    source_zone: str = "UTC"
    local_zone: str = fv.LOCAL_ZONE
    sms_flow_id: str = fv.SMS_FLOW_ID
    sms_since: dt.date = dt.date.fromisoformat(fv.SMS_SINCE)
    skew: SkewPolicy = field(default_factory=SkewPolicy)

    def __post_init__(self):
        if self.month_rule not in MONTH_RULES:
            raise ValueError(f"month_rule must be one of {MONTH_RULES}, not {self.month_rule!r}")
