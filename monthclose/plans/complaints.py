"""Complaints and how they were resolved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose import fixed_values as fv
from monthclose.functions.dates import reported_month
from monthclose.operators.identity import repeat_rows
from monthclose.operators.tickets import merged_resolution
from monthclose.params import ReportParams
from monthclose.sources.registry import Sources

_DETAILS = ["custom_issue_summary", "custom_complaint_summary", "custom_complaint_resolution", "solve_date"]


def _complaints(sources: Sources, params: ReportParams, tiers: tuple[str, ...]) -> DataFrame:
    tickets = sources["tickets"]
    complaints = tickets.where(
        F.col("custom_complaint")
        & F.col("brand_id").isin(*params.program.brand_ids)
        & (F.col("custom_issue_summary") != fv.ISSUE_TEST)
        & F.col("custom_criticality").isin(*tiers)
    )
    # A brand listed twice repeats its complaints; the names themselves are not reported. There is one row
    # per brand of the programme, which is what makes the broadcast safe.
    brands = sources["brands"].where(F.col("brand_id").isin(*params.program.brand_ids))
    listed = F.broadcast(brands.groupBy("brand_id").agg(F.count(F.lit(1)).alias("n_listed")))
    resolved = merged_resolution(complaints, tickets, sources["ticket_field_history"], params, prefilter=True)
    month = reported_month(resolved, "solve_date", params, cutover=True)
    counted = month.join(listed, "brand_id", "left").withColumn("n_listed", F.coalesce("n_listed", F.lit(1)))
    return repeat_rows(counted, "n_listed")


def complaints_tier1(sources: Sources, params: ReportParams) -> DataFrame:
    """Non-executive complaints resolved in the month."""
    return _complaints(sources, params, fv.TIER_1).select("custom_imprint_uuid", *_DETAILS)


def complaints_tier2(sources: Sources, params: ReportParams) -> DataFrame:
    """Complaints of the two higher tiers resolved in the month."""
    return _complaints(sources, params, fv.TIERS_2_3).select(*_DETAILS)
