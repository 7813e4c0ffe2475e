"""Columns each source table must have. Extra columns are allowed and never read."""

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "money": T.DecimalType(18, 2),
    "rate": T.DecimalType(9, 4),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<string>": T.ArrayType(T.StringType()),
}

# Column names and types of the source tables.
_COLUMNS = {
    "accounts": """product_account_uuid string, consumer_uuid string, application_uuid string,
        credit_line_uuid string, merchant_name string, merchant_combname string, is_test_account boolean""",
    "status_events": """product_account_uuid string, started_at_est timestamp_ntz, status string,
        status_reason string, status_reason_code string, is_treatment boolean, is_latest boolean""",
    "transactions": """transaction_uuid string, source_transaction_id string, original_id string,
        product_account_uuid string, consumer_uuid string, credit_line_uuid string, card_uuid string,
        auth_user_uuid string, amount money, transaction_type string, transaction_status string,
        created_at_est timestamp_ntz, transaction_pending_at_est timestamp_ntz,
        transaction_confirmed_at_est timestamp_ntz, updated_at_est timestamp_ntz,
        purchase_merchant_name string, merchant_name string, merchant_combname string,
        purchase_method string, purchase_category string, purchase_category_code string,
        purchase_auth_rejection_reason string, dispute_reason string, dispute_explanation string,
        fee_reason string, interest_reason string, is_stmt_pseudo_txn boolean, is_pre_conversion_txn boolean""",
    "contact_calls": """call_id string, ticket_id string, custom_imprint_uuid string, brand_id string,
        ticket_group string, custom_reason_code string, call_direction string, is_overflowed boolean,
        is_call_outside_business_hours boolean, ivr_action string, call_completion_status string,
        has_customer_requested_voicemail boolean, call_wait_time_seconds bigint,
        call_talk_time_seconds bigint, call_hold_time_seconds bigint, call_wrap_up_time_seconds bigint,
        call_created_at timestamp_ntz, ticket_created_at timestamp_ntz, call_created_at_est timestamp_ntz,
        ticket_created_at_est timestamp_ntz, request_channel string, submitter_user_id string,
        submitter_role string""",
    "ticket_comments": "ticket_id string, call_from_number string",
    "profiles": "consumer_uuid string, phone string",
    "users": "user_id string, user_signature string",
    "ticket_tag_history": "ticket_id string, tag_name string",
    "brands": "brand_id string, brand_name string",
    "ticket_field_history": """ticket_id string, field_name string, field_value string,
        updated_at timestamp_ntz""",
    "tickets": """ticket_id string, brand_id string, via_channel string, ticket_created_at timestamp_ntz,
        custom_complaint boolean, custom_imprint_uuid string, merged_ticket_ids array<string>,
        custom_does_contact_have_account_with_imprint string, custom_issue_summary string,
        custom_complaint_summary string, custom_complaint_resolution string, custom_criticality string""",
    "applications": """application_uuid string, application_status string,
        application_submitted_at_est timestamp_ntz, merchant_combname string, is_test_account boolean""",
    "hardpull": "application_uuid string, mla_flag boolean, updated_at_est timestamp_ntz",
    "loan_tape": """credit_line_uuid string, activity_date date, days_past_due int,
        total_balance money, merchant_name string""",
    "daily_account_balance": """product_account_uuid string, eod_status string,
        total_charged_off money, merchant_name string, activity_date date, is_test_account boolean""",
    "card_status_history": """card_uuid string, product_account_uuid string, card_status string,
        card_type string, cancel_reason string, last_ingest_at_est timestamp_ntz""",
    "apr_history": """credit_line_uuid string, effective_start_at_est timestamp_ntz,
        effective_end_at_est timestamp_ntz, final_apr rate""",
    "disputes_log": """transaction_uuid string, reason_for_dispute string, workflow_stage string,
        billing_error_status_resolution string""",
    "sms_executions": """execution_id string, flow_id string, execution_status string,
        created_at_est timestamp_ntz""",
    "sms_execution_log": """event_id string, consumer_uuid string, source_uuid string, cardname string,
        transactionamount money""",
    "sms_execution_steps": """execution_id string, execution_step_name string, transitioned_from string,
        transitioned_to string, created_at_est timestamp_ntz""",
    "email_event": "external_user_id string, event_type string, canvas_id string, time_at_est timestamp_ntz",
    "subscription_event": """external_user_id string, subscription_status string, channel string,
        time_at_est timestamp_ntz""",
    "canvas": "canvas_id string, canvas_name string",
    "profile_reconcile": "credit_line_uuid string",
}


def _schema(columns: str) -> T.StructType:
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


SCHEMAS: dict[str, T.StructType] = {name: _schema(columns) for name, columns in _COLUMNS.items()}
