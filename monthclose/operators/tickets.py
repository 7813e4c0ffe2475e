"""Ticket resolution, also through tickets merged into others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose import fixed_values as fv
from monthclose.functions.dates import local_date
from monthclose.functions.text import blank_to_null
from monthclose.operators.prefilter import key_bits, maybe_in
from monthclose.operators.skew import left_join
from monthclose.operators.tagged import united
from monthclose.params import ReportParams


def latest_solve_dates(history: DataFrame, params: ReportParams) -> DataFrame:
    """Local day of the latest 'solved' entry per ticket, null if an entry has no time.

    Only the time of the latest row is used, so a hash aggregate does; a null time counts as latest.
    """
    solved = history.where((F.col("field_name") == "status") & (F.col("field_value") == "solved"))
    latest = solved.groupBy("ticket_id").agg(
        F.max("updated_at").alias("latest"), F.count(F.lit(1)).alias("n"), F.count("updated_at").alias("n_timed")
    )
    return latest.select(
        "ticket_id",
        local_date(F.when(F.col("n") == F.col("n_timed"), F.col("latest")), params).alias("solve_date"),
    )


def merged_pairs(tickets: DataFrame) -> DataFrame:
    """ticket_id, array_index, merged_ticket_id: one row per ticket absorbed.

    The absorbing ticket must name a consumer and must not be marked as needing no account. Tickets with
    an empty or null list give no row.
    """
    need = F.col("custom_does_contact_have_account_with_imprint")
    return (
        tickets.where(F.size("merged_ticket_ids") > 0)
        .where(blank_to_null(F.col("custom_imprint_uuid")).isNotNull())
        .where(need.isNull() | (need != fv.NO_ACCOUNT_NEEDED))
        .select("ticket_id", F.posexplode("merged_ticket_ids").alias("array_index", "merged_ticket_id"))
    )


def merged_resolution(
    tickets: DataFrame, all_tickets: DataFrame, history: DataFrame, params: ReportParams, prefilter: bool = False
) -> DataFrame:
    """``tickets`` plus ``solve_date``: own solve date, else the latest one among the tickets absorbed.

    Absorbed tickets are looked up in ``all_tickets``. The history is reduced to one row per ticket map-side, before
    anything of it is shuffled. Own dates and those found through merges meet in one grouping by ticket, so
    ``tickets`` are joined once; rows of tickets that are not asked for go in that join.

    ``prefilter`` is for few ``tickets``: bit filters of their ids and of those they absorbed go over both large tables
    as they are read, so that of other tickets hardly a row is grouped or shuffled.
    """
    pairs = merged_pairs(all_tickets).select("ticket_id", "merged_ticket_id")
    if prefilter:
        pairs = maybe_in(pairs, ["ticket_id"], key_bits([(tickets, ["ticket_id"])]))
        asked = key_bits([(tickets, ["ticket_id"]), (pairs, ["merged_ticket_id"])])
        history = maybe_in(history, ["ticket_id"], asked)
    solved = latest_solve_dates(history, params)
    of_merged = solved.withColumnsRenamed({"ticket_id": "merged_ticket_id", "solve_date": "merged_solve_date"})
    through_merge = left_join(pairs, of_merged, ["merged_ticket_id"], params.skew)
    dates = united(
        [
            (solved, {"ticket_id": F.col("ticket_id"), "own_date": F.col("solve_date")}),
            (through_merge, {"ticket_id": F.col("ticket_id"), "merged_date": F.col("merged_solve_date")}),
        ],
        ["ticket_id"],
        F.max,
    ).select("ticket_id", F.coalesce("own_date", "merged_date").alias("solve_date"))
    return left_join(tickets, dates, ["ticket_id"], params.skew)
