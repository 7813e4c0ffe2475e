"""Report-shaped views over the driver tables.

Every expression is written in the SQL that Spark and DuckDB have in common, once, so both engines see
the same rows. Values the reports look for come from ``fixed_values``.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from monthclose import fixed_values as fv
from monthclose.sources.registry import Sources

_B1, _B2, _B3 = fv.PROGRAM_BRAND_IDS
_NAME_1, _NAME_2 = fv.PROGRAM_BRAND_NAMES
_COMB = fv.PROGRAM_COMB_NAME
_NONE = "Elsewhere"
_SUPPORT = fv.SUPPORT_SIGNATURE_PATTERN.strip("%")

# A number from 0 to 99 in every event: the hundredths of its value.
_K = "(cast(floor(value * 100) as bigint) % 100)"
_IN_PROGRAM = f"case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM') then '{_COMB}' else '{_NONE}' end"
_BRAND_OF_EVENT = (
    f"case event_type when 'click' then '{_B1}' when 'error' then '{_B2}' when 'view' then '{_B3}' "
    f"when 'purchase' then '{_B1}' else '1' end"
)
_TXN_ID = "'T' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string)"


def _steps_case() -> str:
    """One of the flow steps, or none, by the event's number."""
    steps = (
        *fv.SMS_STEPS_ALLOW,
        *fv.SMS_STEPS_LOCK_BY_RULE,
        *fv.SMS_STEPS_LOCK,
        *fv.SMS_STEPS_CONFIRMED_FRAUD,
        *fv.SMS_STEPS_UNRECOGNIZED,
    )
    branches = " ".join(f"when {_K} % {len(steps) + 2} = {i} then '{step}'" for i, step in enumerate(steps))
    return f"case {branches} when {_K} % {len(steps) + 2} = {len(steps)} then 'Trigger' else null end"


# view: (driver table, {column: expression})
VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "accounts": (
        "customer",
        {
            "product_account_uuid": "'A' || cast(c_custkey as string)",
            "consumer_uuid": "'C' || cast(c_custkey - c_custkey % 2 as string)",
            "application_uuid": "'P' || cast(c_custkey - c_custkey % 3 as string)",
            "credit_line_uuid": "'L' || cast(c_custkey as string)",
            "merchant_name": f"case c_mktsegment when 'BUILDING' then '{_NAME_1}' when 'MACHINERY' then '{_NAME_2}' "
            f"when 'FURNITURE' then '{_COMB}' else '{_NONE}' end",
            "merchant_combname": "case when c_mktsegment in ('BUILDING', 'MACHINERY', 'FURNITURE') "
            f"then '{_COMB}' else '{_NONE}' end",
            "is_test_account": "c_nationkey = 7",
        },
    ),
    "status_events": (
        "orders",
        {
            "product_account_uuid": "'A' || cast(o_custkey as string)",
            "started_at_est": "o_orderdate",
            "status": "case o_orderstatus when 'F' then 'CHARGE_OFF' when 'O' then 'OPEN' else 'SUSPENDED' end",
            "status_reason": "case o_orderpriority when '1-URGENT' then 'BANKRUPTCY' when '2-HIGH' then 'DECEASED' "
            "when '3-MEDIUM' then 'CCCS' when '4-NOT SPECIFIED' then 'SCRA' else 'CONVERTED_SCRA' end",
            "status_reason_code": "case o_orderpriority when '1-URGENT' then 'ID_THEFT' "
            "when '2-HIGH' then 'THIRD_PARTY_FRAUD' when '3-MEDIUM' then null else 'NONE' end",
            "is_treatment": "case when o_totalprice < 300000 then 'True' when o_totalprice < 400000 then 'False' "
            "else null end",
            "is_latest": "case o_orderstatus when 'P' then 'TRUE' else 'FALSE' end",
        },
    ),
    "transactions": (
        "lineitem",
        {
            "transaction_uuid": _TXN_ID,
            "source_transaction_id": "case when l_quantity > 45 then null else 'T' || cast(l_orderkey as string) "
            "|| '-' || cast(l_linenumber % 7 + 1 as string) end",
            "original_id": _TXN_ID,
            "product_account_uuid": "'A' || cast(l_partkey as string)",
            "consumer_uuid": "'C' || cast(l_partkey - l_partkey % 2 as string)",
            "credit_line_uuid": "case when l_linenumber <> 6 then 'L' || cast(l_partkey as string) end",
            "card_uuid": "'K' || cast(l_partkey as string)",
            "auth_user_uuid": "'U' || cast(l_suppkey as string)",
            "amount": "cast(l_extendedprice as decimal(18,2))",
            "transaction_type": "case when l_returnflag = 'R' then 'DISPUTE' when l_returnflag = 'N' then "
            "'CREDIT_RETURN' when l_linestatus = 'F' then 'AUTH' else 'PURCHASE' end",
            "transaction_status": "case when l_tax < 0.045 then 'CONFIRMED' when l_tax < 0.065 then 'PENDING' "
            "when l_tax < 0.075 then 'CANCELLED' else 'REJECTED' end",
            "created_at_est": "l_shipdate",
            "transaction_pending_at_est": "l_shipdate",
            "transaction_confirmed_at_est": "l_shipdate",
            "updated_at_est": "l_shipdate + interval '1' day",
            "purchase_merchant_name": "case when l_linenumber <= 3 then 'Credit balance refunded' "
            "else 'Shop ' || cast(l_suppkey as string) end",
            "merchant_name": f"case when l_discount < 0.045 then '{_NAME_1}' else '{_NAME_2}' end",
            "merchant_combname": f"case when l_discount < 0.075 then '{_COMB}' else '{_NONE}' end",
            "purchase_method": "l_linestatus",
            "purchase_category": "l_returnflag",
            "purchase_category_code": "cast(l_linenumber as string)",
            "purchase_auth_rejection_reason": "case when l_tax < 0.035 then null when l_tax < 0.055 then "
            "'blocked_by_feedzai_rules' when l_tax < 0.065 then 'insufficient_funds' else 'blocked_by_sardine_rules' end",
            "dispute_reason": "case when l_quantity < 15 then 'FRAUDULENT' when l_quantity < 40 then 'DUPLICATE' "
            "else null end",
            "dispute_explanation": "'line ' || cast(l_linenumber as string)",
            "fee_reason": "case when l_linenumber = 7 then 'LATE_FEE' else null end",
            "interest_reason": "case when l_linenumber = 6 then 'PURCHASE_INTEREST' else null end",
            "is_stmt_pseudo_txn": "l_quantity = 1",
            "is_pre_conversion_txn": "l_quantity = 2",
        },
    ),
    "contact_calls": (
        "events",
        {
            "call_id": f"case when {_K} >= 90 then null when event_type = 'error' then "
            "'E' || cast(event_id - event_id % 4 as string) else 'E' || cast(event_id as string) end",
            "ticket_id": "case when event_id % 41 <> 7 then 'K' || cast(event_id as string) end",
            "custom_imprint_uuid": "case when event_type = 'view' then null else 'C' || cast(user_id as string) end",
            "brand_id": _BRAND_OF_EVENT,
            "ticket_group": f"case when {_K} < 40 then 'Disputes' when {_K} < 75 then 'Fraud Ops' else 'General' end",
            "custom_reason_code": "case when value < 5 then 'general__testing' when value < 12 then "
            "'fraud__bulk_document_request' when value < 20 then null when value < 60 then 'billing__question' "
            "else 'card__status' end",
            "call_direction": f"case when {_K} % 5 = 0 then 'outbound' when {_K} = 1 then null else 'inbound' end",
            "is_overflowed": f"case when {_K} = 7 then 'TRUE' when {_K} = 8 then null else 'FALSE' end",
            "is_call_outside_business_hours": f"case when {_K} = 9 then 'TRUE' when {_K} = 11 then null else 'FALSE' end",
            "ivr_action": f"case when {_K} % 3 = 0 then null when {_K} < 85 then 'group' else 'voicemail' end",
            "call_completion_status": f"case when {_K} < 10 then 'abandoned_in_ivr' when {_K} < 20 then "
            f"'abandoned_in_queue' when {_K} < 30 then 'not_answered' when {_K} < 35 then 'abandoned_on_hold' "
            f"when {_K} < 38 then 'abandoned_in_voicemail' when {_K} < 50 then null else 'completed' end",
            "has_customer_requested_voicemail": "value > 150",
            "call_wait_time_seconds": "cast(floor(value * 3) as bigint)",
            "call_talk_time_seconds": f"case when {_K} % 4 = 0 then 0 else cast(floor(value) as bigint) end",
            "call_hold_time_seconds": f"case when {_K} % 11 = 0 then null else {_K} end",
            "call_wrap_up_time_seconds": "cast(10 as bigint)",
            "call_created_at": f"case when {_K} >= 90 then null else ts end",
            "ticket_created_at": "ts - interval '30' minute",
            "call_created_at_est": f"case when {_K} >= 90 then null else ts - interval '5' hour end",
            "ticket_created_at_est": f"case when {_K} = 3 then null else ts - interval '330' minute end",
            "request_channel": f"case {_K} % 3 when 0 then 'email' when 1 then 'phone' else 'chat' end",
            "submitter_user_id": f"case when {_K} % 7 = 0 then null else 'U' || cast(user_id as string) end",
            "submitter_role": f"case {_K} % 6 when 0 then 'agent' when 1 then 'admin' when 2 then null "
            "else 'end-user' end",
        },
    ),
    "ticket_comments": (
        "events",
        {
            "ticket_id": "'K' || cast(event_id - event_id % 2 as string)",
            "call_from_number": f"case when {_K} < 20 then null when {_K} < 60 then "
            "'+1 (212) ' || substr(lpad(cast(user_id as string), 7, '0'), 1, 3) || '-' "
            "|| substr(lpad(cast(user_id as string), 7, '0'), 4, 4) "
            f"when {_K} < 95 then '212' || lpad(cast(user_id as string), 7, '0') else 'withheld' end",
        },
    ),
    "profiles": (
        "customer",
        {
            "consumer_uuid": "'C' || cast(c_custkey - c_custkey % 2 as string)",
            "phone": "'212' || lpad(cast((c_custkey - c_custkey % 3) % 10000000 as string), 7, '0')",
        },
    ),
    "users": (
        "customer",
        {
            "user_id": "'U' || cast(c_custkey as string)",
            "user_signature": "case c_mktsegment when 'BUILDING' then null when 'MACHINERY' then "
            f"'Your {_SUPPORT} team' else 'Regards' end",
        },
    ),
    "ticket_tag_history": (
        "events",
        {
            "ticket_id": "'K' || cast(event_id - event_id % 3 as string)",
            "tag_name": f"case when {_K} % 6 = 5 then 'closed_by_merge' else 'spam' end",
        },
    ),
    "brands": (
        "region",
        {
            "brand_id": f"case r_regionkey when 0 then '{_B1}' when 1 then '{_B2}' when 2 then '{_B3}' "
            "else cast(r_regionkey as string) end",
            "brand_name": "r_name",
        },
    ),
    "tickets": (
        "events",
        {
            "ticket_id": "'K' || cast(event_id as string)",
            "brand_id": _BRAND_OF_EVENT,
            "via_channel": f"case {_K} % 5 when 0 then 'native_messaging' when 1 then 'chat' when 2 then 'web' "
            "when 3 then 'answer_bot_for_web_widget' else 'api' end",
            "ticket_created_at": "ts",
            "custom_complaint": f"case when {_K} % 4 = 3 then 'FALSE' else 'TRUE' end",
            "custom_imprint_uuid": f"case {_K} % 10 when 3 then '' when 6 then null "
            "else 'C' || cast(user_id as string) end",
            "merged_ticket_ids": f"case {_K} % 4 when 0 then '[\"K' || cast(event_id + 1 as string) || '\",\"K' "
            "|| cast(event_id + 2 as string) || '\"]' when 1 then null else '[]' end",
            "custom_does_contact_have_account_with_imprint": f"case {_K} % 9 when 0 then 'no_uuid_needed' "
            "when 1 then null else 'yes' end",
            "custom_issue_summary": f"case {_K} % 13 when 0 then 'Test' when 1 then null "
            f"else 'Issue ' || cast({_K} as string) end",
            "custom_complaint_summary": "'Complaint ' || cast(event_id as string)",
            "custom_complaint_resolution": "event_type",
            "custom_criticality": "case when value < 30 then 'tier_1' when value < 60 then 'tier_2' else 'tier_3' end",
        },
    ),
    "ticket_field_history": (
        "events",
        {
            "ticket_id": "'K' || cast(event_id - event_id % 2 as string)",
            "field_name": f"case when {_K} % 10 = 0 then 'priority' else 'status' end",
            "field_value": "case when event_type in ('purchase', 'view', 'error') then 'solved' else 'open' end",
            "updated_at": "ts + interval '2' day",
        },
    ),
    "applications": (
        "orders",
        {
            "application_uuid": "'P' || cast(o_orderkey as string)",
            "application_status": "o_orderstatus",
            "application_submitted_at_est": "o_orderdate",
            "merchant_combname": _IN_PROGRAM,
            "is_test_account": "o_totalprice < 20000",
        },
    ),
    "hardpull": (
        "orders",
        {
            "application_uuid": "'P' || cast(o_custkey as string)",
            "mla_flag": "o_orderpriority in ('1-URGENT', '2-HIGH')",
            "updated_at_est": "o_orderdate",
        },
    ),
    "loan_tape": (
        "orders",
        {
            "credit_line_uuid": "'L' || cast(o_custkey as string)",
            "activity_date": "last_day(cast(o_orderdate as date))",
            "days_past_due": "case when o_totalprice < 50000 then null when o_totalprice < 90000 then 0 "
            "else cast(floor(o_totalprice / 1500) as int) - 75 end",
            "total_balance": "cast(o_totalprice as decimal(18,2))",
            "merchant_name": f"case o_orderpriority when '1-URGENT' then '{_NAME_1}' when '2-HIGH' then '{_NAME_2}' "
            f"when '3-MEDIUM' then '{_NAME_1}' else '{_NONE}' end",
        },
    ),
    "daily_account_balance": (
        "orders",
        {
            "product_account_uuid": "'A' || cast(o_custkey as string)",
            "eod_status": "case o_orderstatus when 'F' then 'CHARGE_OFF' else 'OPEN' end",
            "total_charged_off": "cast(o_totalprice as decimal(18,2))",
            "merchant_name": f"case o_orderpriority when '1-URGENT' then '{_NAME_1}' when '2-HIGH' then '{_COMB}' "
            f"when '3-MEDIUM' then '{_NAME_2}' else '{_NONE}' end",
            "activity_date": "cast(o_orderdate as date)",
            "is_test_account": "o_totalprice < 20000",
        },
    ),
    "card_status_history": (
        "orders",
        {
            "card_uuid": "'K' || cast(o_custkey as string)",
            "product_account_uuid": "'A' || cast(o_custkey as string)",
            "card_status": "case o_orderstatus when 'P' then 'ACTIVE' else 'CANCELED' end",
            "card_type": "case when o_totalprice < 250000 then 'PHYSICAL' else 'VIRTUAL' end",
            "cancel_reason": "case o_orderpriority when '1-URGENT' then 'STOLEN' when '2-HIGH' then 'FRAUD' "
            "when '3-MEDIUM' then 'EXPIRED' when '4-NOT SPECIFIED' then null else 'LOST' end",
            "last_ingest_at_est": "o_orderdate",
        },
    ),
    "apr_history": (
        "orders",
        {
            "credit_line_uuid": "'L' || cast(o_custkey as string)",
            "effective_start_at_est": "o_orderdate",
            "effective_end_at_est": "case when o_totalprice > 450000 then null when o_totalprice > 250000 then "
            "o_orderdate + interval '200' day else o_orderdate + interval '90' day end",
            "final_apr": "cast(o_orderkey % 30 as decimal(9,4))",
        },
    ),
    "disputes_log": (
        "orders",
        {
            "transaction_uuid": "'T' || cast(o_orderkey as string) || '-' || case o_orderstatus when 'F' then '1' "
            "when 'O' then '3' else '5' end",
            "reason_for_dispute": "case o_orderpriority when '1-URGENT' then 'Unauthorized use' when '2-HIGH' then "
            "null else 'Not as described' end",
            "workflow_stage": "case when o_totalprice < 300000 then 'Resolution' else 'Intake' end",
            "billing_error_status_resolution": "case when o_totalprice < 200000 then 'Borrower favor' "
            "else 'Merchant favor' end",
        },
    ),
    "sms_executions": (
        "events",
        {
            "execution_id": "'X' || cast(event_id as string)",
            "flow_id": f"case when {_K} < 80 then '{fv.SMS_FLOW_ID}' else 'other' end",
            "execution_status": f"case when {_K} % 3 = 0 then 'active' else 'ended' end",
            "created_at_est": "ts",
        },
    ),
    "sms_execution_log": (
        "events",
        {
            "event_id": "'X' || cast(event_id - event_id % 2 as string)",
            "consumer_uuid": "'C' || cast(user_id as string)",
            "source_uuid": f"'T' || cast(event_id as string) || '-' || cast({_K} % 7 + 1 as string)",
            "cardname": f"case when {_K} % 2 = 0 then 'Card A' else 'Card B' end",
            "transactionamount": "cast(value as decimal(18,2))",
        },
    ),
    "sms_execution_steps": (
        "events",
        {
            "execution_id": "'X' || cast(event_id - event_id % 3 as string)",
            "execution_step_name": "'step ' || event_type",
            "transitioned_from": _steps_case(),
            "transitioned_to": f"'end ' || cast({_K} as string)",
            "created_at_est": "ts + interval '1' minute",
        },
    ),
    "email_event": (
        "events",
        {
            "external_user_id": "'C' || cast(user_id as string)",
            "event_type": "case when event_type in ('view', 'click') then 'users.messages.email.Send' "
            "when event_type = 'error' then 'users.messages.email.Unsubscribe' else 'users.messages.email.Open' end",
            "canvas_id": f"'V' || cast({_K} as string)",
            "time_at_est": "ts",
        },
    ),
    "subscription_event": (
        "events",
        {
            "external_user_id": f"case when {_K} = 50 then null else 'C' || cast(user_id as string) end",
            "subscription_status": "case when event_type in ('view', 'error') then 'Unsubscribed' else 'subscribed' end",
            "channel": f"case when {_K} % 2 = 0 then 'email' else 'sms' end",
            "time_at_est": "ts",
        },
    ),
    "canvas": (
        "nation",
        {
            "canvas_id": "'V' || cast(n_nationkey as string)",
            "canvas_name": f"case when n_regionkey < 3 then '{_COMB} welcome' else 'Other' end",
        },
    ),
    "profile_reconcile": ("customer", {"credit_line_uuid": "'L' || cast(c_custkey - c_custkey % 2 as string)"}),
}


class DriverSources(Sources):
    """All report sources, derived from the driver tables by Spark when they are first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._sf_dir = spark, sf_dir
        self._driver_tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._driver_tables:
            self._driver_tables[name] = self._spark.read.parquet(f"{self._sf_dir}/{name}.parquet")
        return self._driver_tables[name]

    def get(self, name: str) -> DataFrame:
        if name not in self._tables:
            table, columns = VIEWS[name]
            self.register(
                name,
                self.table(table).selectExpr(*[f"{expression} AS {column}" for column, expression in columns.items()]),
            )
        return super().get(name)

    __getitem__ = get


@lru_cache(maxsize=8)
def driver_sources(spark: SparkSession, sf_dir: str) -> DriverSources:
    """The sources of a session and directory, defined once and used by all queries."""
    return DriverSources(spark, sf_dir)


def with_views(names: list[str], body: str) -> str:
    """``body`` preceded by the named views as common table expressions, for the SQL oracle."""
    ctes = []
    for name in names:
        table, columns = VIEWS[name]
        listed = ", ".join(f"{expression} AS {column}" for column, expression in columns.items())
        ctes.append(f"v_{name} AS (SELECT {listed} FROM {table})")
    return "WITH " + ", ".join(ctes) + " " + body
