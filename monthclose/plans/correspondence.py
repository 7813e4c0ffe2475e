"""E-mails received and sent, and marketing opt-outs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose import fixed_values as fv
from monthclose.functions.dates import prior_month_bounds, reported_month
from monthclose.functions.labels import email_direction, not_support_signature
from monthclose.operators.skew import filter_by_key, left_join
from monthclose.params import ReportParams
from monthclose.sources.registry import Sources


def _in_month(params: ReportParams, name: str):
    """The month window as an expression, for use inside an OR."""
    ts = F.col(name)
    if params.month_rule == "month_number":
        return F.month(ts) == params.as_of.month - 1
    low, high = (F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz") for d in prior_month_bounds(params.as_of))
    return (ts >= low) & (ts < high)


def _support_emails(sources: Sources, params: ReportParams, grouped: bool) -> DataFrame:
    is_email = F.col("request_channel") == "email"
    here_and_now = F.col("brand_id").isin(*params.program.brand_ids) & _in_month(params, "ticket_created_at_est")
    # What either test below needs of the contact itself, so that it is applied before any join.
    possible = (is_email & here_and_now) if grouped else (is_email | here_and_now)
    contacts = left_join(
        sources["contact_calls"].select(
            F.col("submitter_user_id").alias("user_id"),
            F.col("custom_imprint_uuid").alias("consumer_uuid"),
            "ticket_created_at_est",
            "request_channel",
            "brand_id",
            "submitter_role",
        ).where(possible),
        sources["users"].select("user_id", "user_signature").distinct(),
        ["user_id"],
        params.skew,
    )
    signature = F.col("user_signature")
    if grouped:
        by_signature = is_email & (not_support_signature(signature) | signature.isNull()) & here_and_now
    else:
        # As the report is defined: AND binds first, so channel and month are tested on one side each.
        by_signature = (is_email & not_support_signature(signature)) | (signature.isNull() & here_and_now)
    all_inbound = is_email & here_and_now
    directions = F.array_distinct(
        F.array_compact(
            F.array(
                F.when(by_signature, email_direction(signature, F.col("submitter_role"))),
                F.when(all_inbound, F.lit("inbound")),
            )
        )
    )
    listed = (
        contacts.where(by_signature | all_inbound)
        .select("consumer_uuid", F.col("ticket_created_at_est").alias("timestamp"), F.explode(directions).alias("direction"))
        .distinct()
    )
    accounts = sources["accounts"].select("consumer_uuid", "product_account_uuid")
    hot_in = sources.kept("accounts", ["consumer_uuid"]) or accounts
    return left_join(listed, accounts.distinct(), ["consumer_uuid"], params.skew, hot_in=hot_in).select(
        "product_account_uuid", "timestamp", "direction", F.lit(fv.SUPPORT_EMAIL).alias("correspondence_type")
    )


def _marketing_emails(sources: Sources, params: ReportParams) -> DataFrame:
    sent = reported_month(
        sources["email_event"].where(F.col("event_type") == fv.EVENT_EMAIL_SEND), "time_at_est", params
    )
    canvases = sources["canvas"].where(F.col("canvas_name").like(params.program.canvas_pattern)).select("canvas_id")
    accounts = (
        sources["accounts"]
        .where(F.col("merchant_combname") == params.program.comb_name)
        .select(F.col("consumer_uuid").alias("external_user_id"), "product_account_uuid")
    )
    return (
        sent.join(canvases, "canvas_id", "left_semi")
        .join(accounts, "external_user_id")
        .select(
            "product_account_uuid",
            F.col("time_at_est").alias("timestamp"),
            F.lit("outbound").alias("direction"),
            F.lit(fv.MARKETING_EMAIL).alias("correspondence_type"),
        )
    )


def correspondence(sources: Sources, params: ReportParams, grouped: bool = False) -> DataFrame:
    """E-mails of the month. ``grouped`` applies channel, brand and month to every support e-mail.

    An e-mail that counts as outbound by its signature is listed as inbound too, once.
    """
    return _support_emails(sources, params, grouped).union(_marketing_emails(sources, params)).distinct()


def opt_outs(sources: Sources, params: ReportParams) -> DataFrame:
    """Marketing opt-outs of programme consumers in the month."""
    events = sources["subscription_event"].where(
        F.upper("subscription_status") == fv.SUBSCRIPTION_UNSUBSCRIBED
    )
    consumers = (
        sources["accounts"].where(F.col("merchant_combname") == params.program.comb_name).select("consumer_uuid")
    )
    distinct = (
        reported_month(events, "time_at_est", params)
        .select(F.col("external_user_id").alias("consumer_uuid"), "channel", "time_at_est")
        .distinct()
    )
    return filter_by_key(distinct, consumers, ["consumer_uuid"], params.skew)
