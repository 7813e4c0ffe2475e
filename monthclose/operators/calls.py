"""Call-centre figures, each set in one pass over the calls."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthclose import fixed_values as fv
from monthclose.functions.labels import abandoned_call, handled_call, inbound_agent_call, is_inbound


def _rows(figures: DataFrame, lines: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row of figures turned into (statistic, num) rows."""
    pairs = [F.struct(F.lit(label).alias("statistic"), value.cast("double").alias("num")) for label, value in lines]
    return figures.select(F.inline(F.array(*pairs)))


def fold_flags(df: DataFrame, keys: Sequence[str], flags: Sequence[str], *measures: Column) -> DataFrame:
    """One row per ``keys``: whether any of its rows shows each flag, and ``measures`` over them.

    Counting distinct keys under several conditions then is counting rows: predicates become bits, the bits of a key
    are or-ed map-side, and no row is expanded into one copy per condition. Where the first key is null no flag shows."""
    named = F.col(keys[0]).isNotNull()
    bits = [F.when(F.col(flag) & named, 1 << n).otherwise(0) for n, flag in enumerate(flags)]
    folded = df.withColumn(_BITS, reduce(lambda a, b: a.bitwiseOR(b), bits))
    seen = folded.groupBy(*keys).agg(F.bit_or(_BITS).alias(_BITS), *measures)
    shown = [(F.col(_BITS).bitwiseAND(1 << n) != 0).alias(flag) for n, flag in enumerate(flags)]
    return seen.select(*[c for c in seen.columns if c != _BITS], *shown)


_BITS = "__bits"


def call_funnel(calls: DataFrame, distinct_wait: bool = True) -> DataFrame:
    """Calls offered, handled, abandoned and outbound, mean wait and mean handle time.

    The four counts come from one fold by call; sums behind the means ride along. The mean wait is over *distinct* wait
    times unless told otherwise: calls are folded by wait too, and what is left, one row per call and wait, is dealt
    out once as a row of the call and once as a row of the wait, for a second fold. Handle time has its own filter
    (inbound, talk time above zero) and skips calls with a null part.
    """
    wait = F.when(inbound_agent_call(), F.col("call_wait_time_seconds"))
    talk, hold, wrap = (F.col(f"call_{part}_time_seconds") for part in ("talk", "hold", "wrap_up"))
    handle = F.when(is_inbound() & (talk > 0), talk + hold + wrap).cast("double")
    shown = {
        "offered": inbound_agent_call(),
        "handled": handled_call(),
        "abandoned": abandoned_call(),
        "outbound": F.col("call_direction") == "outbound",
    }
    flags = list(shown)
    rows = calls.select("call_id", wait.alias("wait"), handle.alias("handle"), *[c.alias(n) for n, c in shown.items()])
    if distinct_wait:
        sums = {"handle": F.sum("handle"), "n_handle": F.count("handle")}
        seen = fold_flags(rows, ["call_id", "wait"], flags, *[c.alias(n) for n, c in sums.items()])
        kinds = {f.name: f.dataType for f in seen.schema.fields}
        of_call = F.struct(*[F.lit(None).cast(k).alias(c) if c == "wait" else F.col(c) for c, k in kinds.items()])
        of_wait = F.struct(*[F.col(c) if c == "wait" else F.lit(None).cast(k).alias(c) for c, k in kinds.items()])
        dealt = seen.select(F.inline(F.array(of_call, of_wait)))
        folded = fold_flags(dealt, ["call_id", "wait"], flags, F.sum("handle").alias("handle"), F.sum("n_handle").alias("n_handle"))
        mean_wait = F.avg("wait")
    else:
        sums = {"handle": F.sum("handle"), "n_handle": F.count("handle"), "wait": F.sum("wait"), "n_wait": F.count("wait")}
        folded = fold_flags(rows, ["call_id"], flags, *[c.alias(n) for n, c in sums.items()])
        mean_wait = F.try_divide(F.sum("wait").cast("double"), F.sum("n_wait").cast("double"))
    figures = folded.agg(
        *[F.count_if(flag).alias(f"n_{flag}") for flag in flags],
        mean_wait.alias("mean_wait"),
        F.round(F.try_divide(F.sum("handle"), F.sum("n_handle").cast("double")), 2).alias("mean_handle"),
    )
    return _rows(
        figures,
        [
            (fv.CALLS_OFFERED, F.col("n_offered")),
            (fv.CALLS_HANDLED, F.col("n_handled")),
            (fv.CALLS_ABANDONED, F.col("n_abandoned")),
            (fv.CALLS_OUTBOUND, F.col("n_outbound")),
            (fv.AVG_SPEED_OF_ANSWER, F.col("mean_wait")),
            (fv.AVG_HANDLE_TIME, F.col("mean_handle")),
        ],
    )


def sla_ratio(
    calls: DataFrame,
    threshold: int = 120,
    manual: Sequence[tuple[str, float | None]] = fv.MANUAL_SERVICE_LEVELS,
) -> DataFrame:
    """Share of offered calls answered in time, followed by the service levels entered by hand.

    The share is null when no call was offered.
    """
    in_time = inbound_agent_call() & (F.col("call_wait_time_seconds") <= threshold)
    rows = calls.select("call_id", inbound_agent_call().alias("offered"), in_time.alias("in_time"))
    per_call = fold_flags(rows, ["call_id"], ["offered", "in_time"])
    counts = per_call.agg(F.count_if("in_time").alias("n_in_time"), F.count_if("offered").alias("n_offered"))
    share = F.try_divide(F.col("n_in_time").cast("double"), F.col("n_offered").cast("double"))
    by_hand = [(label, F.lit(value).cast("double")) for label, value in manual]
    return _rows(counts, [(fv.CALL_RESPONSE_IN_TIME, share), *by_hand])
