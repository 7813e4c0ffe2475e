"""Portfolio indicators: balances by age, charge-offs, disputes and fraud."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthclose import fixed_values as fv
from monthclose.functions.dates import month_end_snapshot, reported_month
from monthclose.functions.labels import dpd_bucket
from monthclose.operators.fraud import cancel_tally, dispute_tally, fraud_signals, sms_outcome
from monthclose.operators.skew import filter_by_key, left_join
from monthclose.params import ReportParams
from monthclose.sources.registry import Sources


def _line(label: str, df: DataFrame, account: str, amount) -> DataFrame:
    return df.agg(F.count_distinct(account).alias("n_accounts"), F.sum(amount).alias("amount")).select(
        F.lit(label).alias("dpd_bucket"), "n_accounts", "amount"
    )


def ageing_lines(sources: Sources, params: ReportParams) -> DataFrame:
    """Accounts and balance per ageing bucket at month end.

    Credit lines listed more than once in the reconciliation count their balance that many times.
    """
    tape = month_end_snapshot(sources["loan_tape"], "activity_date", params.as_of).where(
        F.col("merchant_name").isin(*params.program.brand_names)
    )
    listed = sources["profile_reconcile"].groupBy("credit_line_uuid").agg(F.count(F.lit(1)).alias("n_listed"))
    rows = left_join(
        tape.select("credit_line_uuid", "days_past_due", "total_balance"),
        listed,
        ["credit_line_uuid"],
        params.skew,
    )
    weighted = F.col("total_balance") * F.coalesce("n_listed", F.lit(1))
    return rows.groupBy(dpd_bucket(F.col("days_past_due")).alias("dpd_bucket")).agg(
        F.count_distinct("credit_line_uuid").alias("n_accounts"), F.sum(weighted).alias("amount")
    )


def charge_off_line(sources: Sources, params: ReportParams, last_snapshot: bool = False) -> DataFrame:
    """Charged-off accounts of the month; the amount adds up all daily snapshots unless told otherwise."""
    balances = sources["daily_account_balance"].where(
        (F.col("eod_status") == fv.STATUS_CHARGE_OFF)
        & F.col("merchant_name").isin(*params.program.charge_off_names)
        & ~F.col("is_test_account")
    )
    if last_snapshot:
        month = month_end_snapshot(balances, "activity_date", params.as_of)
    else:
        month = reported_month(balances, "activity_date", params)
    return _line(fv.LINE_CHARGE_OFF, month, "product_account_uuid", F.col("total_charged_off"))


def dispute_line(sources: Sources, params: ReportParams) -> DataFrame:
    disputed = sources["transactions"].where(
        (F.col("transaction_type") == fv.TYPE_DISPUTE) & (F.col("merchant_combname") == params.program.comb_name)
    )
    month = reported_month(disputed, "transaction_pending_at_est", params)
    return _line(fv.LINE_DISPUTES, month, "product_account_uuid", F.col("amount"))


def flagged_transactions(sources: Sources, params: ReportParams) -> DataFrame:
    """The month's transactions of the programme with their fraud signals."""
    txns = sources["transactions"]
    candidates = txns.where(
        (F.col("merchant_combname") == params.program.comb_name)
        & F.col("transaction_status").isin(*fv.FRAUD_LINE_STATUSES)
    )
    month = reported_month(candidates, "transaction_pending_at_est", params).select(
        "transaction_uuid",
        "source_transaction_id",
        "product_account_uuid",
        "purchase_auth_rejection_reason",
        "amount",
    )
    # Of all time, only rows carrying the id of one of these transactions matter on the other sides.
    same_id = filter_by_key(
        txns.select("transaction_uuid", "source_transaction_id", "card_uuid", "created_at_est"),
        month,
        ["transaction_uuid"],
        params.skew,
    )
    return fraud_signals(
        month,
        sources["status_events"],
        dispute_tally(txns, sources["disputes_log"], params.skew, auths=same_id),
        cancel_tally(sources["card_status_history"], same_id, params.skew),
        sms_outcome(sources["sms_executions"], sources["sms_execution_log"], sources["sms_execution_steps"], params),
        params.skew,
    )


def fraud_line(sources: Sources, params: ReportParams, one_row_per_txn: bool = False) -> DataFrame:
    """Accounts and amount of transactions with a fraud signal.

    The amount counts a transaction once per joined signal row; ``one_row_per_txn`` counts it once.
    """
    flagged = flagged_transactions(sources, params).where(F.col("is_fraud"))
    times = F.lit(1) if one_row_per_txn else F.col("n_fraud_rows")
    return _line(fv.LINE_FRAUD, flagged, "product_account_uuid", -F.col("amount") * times)


def portfolio(
    sources: Sources, params: ReportParams, one_row_per_txn: bool = False, last_snapshot: bool = False
) -> DataFrame:
    """All lines of the portfolio report: dpd_bucket, n_accounts, amount. Every label occurs once."""
    return (
        ageing_lines(sources, params)
        .union(charge_off_line(sources, params, last_snapshot))
        .union(dispute_line(sources, params))
        .union(fraud_line(sources, params, one_row_per_txn))
    )
