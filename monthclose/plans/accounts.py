"""Account status reports: ID theft, bankruptcy, charge-off, collections, service members, applications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthclose import fixed_values as fv
from monthclose.functions.dates import delinquent_since, month_end_snapshot, reported_month
from monthclose.operators.dedup import first_event
from monthclose.operators.skew import filter_by_key
from monthclose.params import ReportParams, SkewPolicy
from monthclose.sources.registry import Sources


def _program_accounts(sources: Sources, params: ReportParams, by_brand_name: bool = False) -> DataFrame:
    accounts = sources["accounts"].where(~F.col("is_test_account"))
    if by_brand_name:
        return accounts.where(F.col("merchant_name").isin(*params.program.brand_names))
    return accounts.where(F.col("merchant_combname") == params.program.comb_name)


def _first_in_month(
    sources: Sources, params: ReportParams, condition: Column, cutover: bool, detail: str
) -> DataFrame:
    """First matching status event of the month per account: account, time, ``detail``.

    The accounts a report drops are dropped whole, so the first event can be chosen before accounts are
    joined: a hot account is down to one row per task when it meets an exchange.
    """
    events = sources["status_events"].where(condition)
    month = reported_month(events, "started_at_est", params, cutover=cutover)
    return first_event(
        month.select("product_account_uuid", "started_at_est", detail), ["product_account_uuid"], ["started_at_est"]
    )


def _of_program(events: DataFrame, accounts: DataFrame, policy: SkewPolicy) -> DataFrame:
    return filter_by_key(events, accounts, ["product_account_uuid"], policy)


def _with_merchant(events: DataFrame, accounts: DataFrame) -> DataFrame:
    """Events of the accounts plus the account's merchant name, still one row per account.

    An account listed many times is reduced to its smallest name map-side, before it meets its one event.
    """
    names = (
        accounts.where(F.col("product_account_uuid").isNotNull())
        .groupBy("product_account_uuid")
        .agg(F.min("merchant_name").alias("merchant_name"))
    )
    return events.join(names, "product_account_uuid")


def id_theft(sources: Sources, params: ReportParams) -> DataFrame:
    """Accounts with an ID-theft claim in the month."""
    events = _first_in_month(
        sources, params, F.col("status_reason_code") == fv.CODE_ID_THEFT, False, "status_reason_code"
    )
    return _of_program(events, _program_accounts(sources, params), params.skew)


def bankruptcy(sources: Sources, params: ReportParams) -> DataFrame:
    """Accounts newly bankrupt in the month, with the earliest such status."""
    events = _first_in_month(sources, params, F.col("status_reason") == fv.REASON_BANKRUPTCY, True, "status_reason")
    return _of_program(events, _program_accounts(sources, params), params.skew)


def charge_off(sources: Sources, params: ReportParams) -> DataFrame:
    """Accounts charged off in the month."""
    events = _first_in_month(sources, params, F.col("status") == fv.STATUS_CHARGE_OFF, False, "status")
    return _of_program(events, _program_accounts(sources, params), params.skew)


def scra(sources: Sources, params: ReportParams) -> DataFrame:
    """Accounts newly under service-member relief in the month."""
    wanted = F.col("status_reason").isin(*fv.REASONS_SCRA) & F.col("is_treatment")
    events = _first_in_month(sources, params, wanted, False, "status_reason")
    return _with_merchant(events, _program_accounts(sources, params, by_brand_name=True))


def collections(sources: Sources, params: ReportParams) -> DataFrame:
    """Delinquent accounts at month end, and accounts newly in credit counselling or deceased."""
    behind = (
        month_end_snapshot(sources["loan_tape"], "activity_date", params.as_of)
        .where(F.col("merchant_name").isin(*params.program.brand_names) & (F.col("days_past_due") > 0))
        .join(sources["accounts"].select("credit_line_uuid", "product_account_uuid").distinct(), "credit_line_uuid")
        .select(
            "product_account_uuid",
            delinquent_since(F.col("days_past_due"), params.as_of).cast("timestamp_ntz").alias("started_at_est"),
            F.lit(fv.STATUS_DELINQUENT).alias("status"),
            "merchant_name",
        )
    )
    wanted = F.col("status_reason").isin(*fv.REASONS_COLLECTIONS)
    events = _first_in_month(sources, params, wanted, False, "status_reason")
    flagged = _with_merchant(events, _program_accounts(sources, params, by_brand_name=True)).select(
        "product_account_uuid",
        "started_at_est",
        F.when(wanted, F.col("status_reason")).alias("status"),
        "merchant_name",
    )
    return behind.union(flagged).distinct()


def mla(sources: Sources, params: ReportParams) -> DataFrame:
    """Accounts whose application was flagged for military lending in the month; one row per application."""
    pulls = reported_month(sources["hardpull"].where(F.col("mla_flag")), "updated_at_est", params)
    first = first_event(pulls, ["application_uuid"], ["updated_at_est"])
    accounts = (
        _program_accounts(sources, params)
        .where(F.col("application_uuid").isNotNull())
        .groupBy("application_uuid")
        .agg(F.min("product_account_uuid").alias("product_account_uuid"))
    )
    return first.join(accounts, "application_uuid").select("product_account_uuid", "mla_flag")


def applications(sources: Sources, params: ReportParams) -> DataFrame:
    """Applications received in the month and their status, by time and status."""
    received = sources["applications"].where(
        (F.col("merchant_combname") == params.program.comb_name) & ~F.col("is_test_account")
    )
    month = reported_month(received, "application_submitted_at_est", params, cutover=True)
    # The id as last sort key makes the order total and lets the range partitioner split equal times.
    return month.select("application_uuid", "application_status", "application_submitted_at_est").orderBy(
        F.col("application_submitted_at_est").asc_nulls_last(),
        F.col("application_status").asc_nulls_last(),
        F.col("application_uuid").asc_nulls_last(),
    )
