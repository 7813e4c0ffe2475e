"""Contact reports: dispute and fraud cases, agent calls, call-centre figures, service levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthclose import fixed_values as fv
from monthclose.functions.dates import reported_month
from monthclose.functions.labels import inbound_agent_call, program_of
from monthclose.operators.calls import call_funnel, sla_ratio
from monthclose.operators.identity import (
    N_ROWS,
    exclude_merged,
    identity_consumers,
    identity_counts,
    repeat_rows,
)
from monthclose.operators.skew import filter_by_key, left_join
from monthclose.params import ReportParams
from monthclose.sources.registry import Sources

TICKET_FIRST = ("ticket_created_at_est", "call_created_at_est")
CALL_FIRST = ("call_created_at_est", "ticket_created_at_est")
CALL_FIRST_UTC = ("call_created_at", "ticket_created_at")


def _program_calls(sources: Sources, params: ReportParams) -> DataFrame:
    return sources["contact_calls"].where(F.col("brand_id").isin(*params.program.brand_ids))


def _identity_of(calls: DataFrame, sources: Sources, params: ReportParams, identities, **hot) -> DataFrame:
    """Identity counts, per call or per call and consumer, of the call ids in ``calls``, over all rows carrying one of these ids."""
    every_call = sources["contact_calls"].select("call_id", "ticket_id")
    rows = filter_by_key(every_call, calls, ["call_id"], params.skew)
    return identities(rows, sources["ticket_comments"], sources["profiles"], params.skew, **hot)


def _with_accounts(contacts: DataFrame, sources: Sources, params: ReportParams, columns: list[str]) -> DataFrame:
    """``contacts`` plus ``columns`` of the consumer's accounts in the programme, and ``n_accounts`` alike."""
    keys = ["consumer_uuid", "program_name"]
    accounts = sources["accounts"].withColumnRenamed("merchant_combname", "program_name").select(*keys, *columns)
    counts = accounts.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("n_accounts"))
    kept = sources.kept("accounts", ["consumer_uuid", "merchant_combname"])
    return left_join(contacts, counts, keys, params.skew, hot_in=kept or accounts)


def _cases(
    sources: Sources,
    params: ReportParams,
    ticket_group: str,
    excluded_reasons: tuple[str, ...],
    timestamp_name: str,
    dedupe: bool,
) -> DataFrame:
    cases = _program_calls(sources, params).where(F.col("ticket_group") == ticket_group)
    for reason in excluded_reasons:
        cases = cases.where(F.col("custom_reason_code") != reason)
    in_month = reported_month(cases, TICKET_FIRST, params, cutover=True)
    month = exclude_merged(in_month, sources["ticket_tag_history"], params.skew).select(
        "call_id",
        F.col("custom_imprint_uuid").alias("consumer_uuid"),
        program_of(F.col("brand_id"), params.program).alias("program_name"),
        F.coalesce(*TICKET_FIRST).alias(timestamp_name),
        "custom_reason_code",
    )
    times: Column = F.lit(1).cast("bigint")
    if not dedupe:
        # The identity lookup adds no column here, it only repeats cases: take the counts, not the rows.
        lookup = _identity_of(month, sources, params, identity_counts).withColumnRenamed(N_ROWS, "n_identities")
        month = left_join(month, lookup, ["call_id"], params.skew)
        times = F.coalesce("n_identities", F.lit(1))
    with_account = _with_accounts(month, sources, params, ["product_account_uuid", "merchant_name"])
    counted = with_account.withColumn(N_ROWS, times * F.coalesce("n_accounts", F.lit(1)))
    return repeat_rows(counted, N_ROWS).select(
        "product_account_uuid",
        F.col("consumer_uuid").alias("custom_imprint_uuid"),
        timestamp_name,
        "custom_reason_code",
        "merchant_name",
    )


def disputes(sources: Sources, params: ReportParams, dedupe: bool = False) -> DataFrame:
    """Billing and payment disputes of the month. ``dedupe`` leaves out the repeats the identity lookup causes."""
    return _cases(sources, params, fv.GROUP_DISPUTES, (fv.REASON_TESTING,), "dispute_timestamp", dedupe)


def fraud_cases(sources: Sources, params: ReportParams, dedupe: bool = False) -> DataFrame:
    """Fraud cases of the month; ``dedupe`` as for :func:`disputes`."""
    reasons = (fv.REASON_TESTING, fv.REASON_BULK_REQUEST)
    return _cases(sources, params, fv.GROUP_FRAUD, reasons, "fraud_timestamp", dedupe)


def calls(sources: Sources, params: ReportParams) -> DataFrame:
    """Agent calls of the month, latest first, with the account found through ticket or phone number."""
    agent_calls = _program_calls(sources, params).where(
        inbound_agent_call() | (F.col("call_direction") == "outbound")
    )
    in_month = reported_month(agent_calls, CALL_FIRST, params, cutover=True)
    month = exclude_merged(in_month, sources["ticket_tag_history"], params.skew).select(
        "call_id",
        F.col("custom_imprint_uuid").alias("ticket_consumer"),
        F.coalesce(*CALL_FIRST).alias("call_timestamp"),
        F.col("custom_reason_code").alias("call_category"),
        "ticket_id",
        program_of(F.col("brand_id"), params.program, other=fv.OTHER_PROGRAM_IN_CALLS).alias("program_name"),
        "call_direction",
    )
    hot = {
        "hot_tickets": sources.kept("ticket_comments", ["ticket_id"]),
        "hot_phones": sources.kept("profiles", ["phone"]),
    }
    lookup = _identity_of(month, sources, params, identity_consumers, **hot).withColumnsRenamed(
        {"consumer_uuid": "phone_consumer", N_ROWS: "n_identities"}
    )
    identified = left_join(month, lookup, ["call_id"], params.skew, hot_in=sources.kept("contact_calls", ["call_id"]) or in_month).withColumn(
        "consumer_uuid", F.coalesce("ticket_consumer", "phone_consumer")
    )
    with_account = _with_accounts(identified, sources, params, ["product_account_uuid"])
    counted = with_account.withColumn(
        N_ROWS, F.coalesce("n_identities", F.lit(1)) * F.coalesce("n_accounts", F.lit(1))
    )
    columns = [
        "product_account_uuid",
        "consumer_uuid",
        "call_timestamp",
        "call_category",
        "ticket_id",
        "program_name",
        "call_direction",
    ]
    rest = [F.col(c).asc_nulls_last() for c in columns if c != "call_timestamp"]
    # Sorted as blocks of copies: fewer rows to move, and the range partitioner can part the blocks of a call.
    order = [F.col("call_timestamp").desc_nulls_first(), *rest]
    return repeat_rows(counted.select(*columns, N_ROWS), N_ROWS, order)


def call_kpis(sources: Sources, params: ReportParams, distinct_wait: bool = True) -> DataFrame:
    """Call-centre figures of the month."""
    month = reported_month(_program_calls(sources, params), CALL_FIRST_UTC, params, cutover=True)
    return call_funnel(month, distinct_wait)


def sla(
    sources: Sources,
    params: ReportParams,
    manual: tuple[tuple[str, float | None], ...] = fv.MANUAL_SERVICE_LEVELS,
) -> DataFrame:
    """Service levels of the month: share of calls answered within 120 seconds, and values entered by hand."""
    with_reason = _program_calls(sources, params).where(F.col("custom_reason_code").isNotNull())
    return sla_ratio(reported_month(with_reason, CALL_FIRST_UTC, params), manual=manual)
