"""Transaction reports: credit-balance refunds and posted transactions with the rate in force."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose import fixed_values as fv
from monthclose.functions.dates import reported_month
from monthclose.operators.dedup import distinct_in_order, first_event
from monthclose.operators.joins import interval_in_force
from monthclose.params import ReportParams, SkewPolicy
from monthclose.sources.registry import Sources


def rate_in_force(
    txns: DataFrame, rates: DataFrame, policy: SkewPolicy
) -> DataFrame:
    """Transactions plus ``final_apr`` valid at confirmation and the end of its interval.

    An open interval is preferred, then the one ending last.
    """
    return interval_in_force(
        txns,
        rates,
        key="credit_line_uuid",
        at="transaction_confirmed_at_est",
        start="effective_start_at_est",
        end="effective_end_at_est",
        values=["final_apr", "effective_end_at_est"],
        policy=policy,
    )


def credit_refunds(sources: Sources, params: ReportParams) -> DataFrame:
    """Credit-balance refunds created in the month, sign turned."""
    refunds = sources["transactions"].where(
        (F.col("transaction_type") == fv.TYPE_CREDIT_RETURN)
        & (F.col("merchant_combname") == params.program.comb_name)
        & (F.col("purchase_merchant_name") == fv.REFUND_MERCHANT)
    )
    return reported_month(refunds, "created_at_est", params).select(
        "product_account_uuid", "transaction_confirmed_at_est", (-F.col("amount")).alias("amount")
    )


def transactions(sources: Sources, params: ReportParams) -> DataFrame:
    """Posted transactions of the month with the rate in force, latest first."""
    posted = sources["transactions"].where(
        (F.col("merchant_combname") == params.program.comb_name)
        & (F.col("transaction_status") == fv.STATUS_CONFIRMED)
        & (F.col("transaction_type") != fv.TYPE_AUTH)
        & ~F.col("is_stmt_pseudo_txn")
        & ~F.col("is_pre_conversion_txn")
    )
    month = reported_month(posted, "transaction_confirmed_at_est", params, cutover=True).select(
        "transaction_uuid",
        "credit_line_uuid",
        "consumer_uuid",
        "purchase_merchant_name",
        "transaction_confirmed_at_est",
        "transaction_type",
        (-F.col("amount")).alias("signed_amount"),
        "fee_reason",
        "interest_reason",
    )
    accounts = (
        sources["accounts"]
        .where(~F.col("is_test_account"))
        .select("credit_line_uuid", "product_account_uuid")
    )
    rates = sources["apr_history"].select(
        "credit_line_uuid", "effective_start_at_est", "effective_end_at_est", "final_apr"
    )
    columns = [
        "product_account_uuid",
        "consumer_uuid",
        "purchase_merchant_name",
        "transaction_confirmed_at_est",
        "transaction_type",
        "signed_amount",
        "fee_reason",
        "interest_reason",
        "final_apr",
    ]
    # Transactions without a credit line have no account and are not reported.
    on_line = month.where(F.col("credit_line_uuid").isNotNull())
    rated = rate_in_force(on_line, rates, params.skew).join(accounts, "credit_line_uuid")
    # A transaction listed more than once keeps the row whose rate ends last; no rate counts as open.
    open_end = F.lit(fv.OPEN_END).cast("timestamp_ntz")
    latest_end = F.coalesce("effective_end_at_est", open_end).desc()
    one_each = first_event(rated, ["transaction_uuid"], [latest_end], tie_break=columns)
    rest = [F.col(c).asc_nulls_last() for c in columns if c != "transaction_confirmed_at_est"]
    order = [F.col("transaction_confirmed_at_est").desc_nulls_first(), *rest]
    return distinct_in_order(one_each.select(*columns), order)
