"""SQL for the reports, stated row by row: plain joins with all their repeats, no counting of rows ahead.

The reports take shorter ways to the same rows; this is what those are measured against.
"""

from __future__ import annotations

from checks.driver_views import with_views
from monthclose import fixed_values as fv

ORDERS_MONTH = "DATE '1998-05-01'"
EVENTS_MONTH = "DATE '2024-01-01'"
ORDERS_CUTOVER = "TIMESTAMP '1998-05-10'"
EVENTS_CUTOVER = "TIMESTAMP '2024-01-10'"
SMS_SINCE = "TIMESTAMP '2024-01-05'"


def text_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


COMB = f"'{fv.PROGRAM_COMB_NAME}'"
BRANDS = text_list(fv.PROGRAM_BRAND_IDS)
NAMES = text_list(fv.PROGRAM_BRAND_NAMES)


def in_month(column: str, month: str) -> str:
    return f"date_trunc('month', {column}) = {month}"


def _status_report(condition: str, detail: str, program: str, cutover: bool = False, merchant: bool = False,
                   month_test: str | None = None, since: str = ORDERS_CUTOVER) -> str:
    month_test = month_test or in_month("e.started_at_est", ORDERS_MONTH)
    extra = f"AND e.started_at_est >= {since}" if cutover else ""
    shown = ", best.m AS merchant_name" if merchant else ""
    return with_views(
        ["status_events", "accounts"],
        f"""SELECT product_account_uuid, best.t AS started_at_est, best.d AS {detail}{shown}
        FROM (SELECT e.product_account_uuid,
                     min({{'t': e.started_at_est, 'd': e.{detail}, 'm': a.merchant_name}}) AS best
              FROM v_status_events e, v_accounts a
              WHERE a.product_account_uuid = e.product_account_uuid AND NOT a.is_test_account
                AND {program} AND {condition} AND {month_test} {extra}
              GROUP BY e.product_account_uuid)""",
    )


ID_THEFT = _status_report("e.status_reason_code = 'ID_THEFT'", "status_reason_code", f"a.merchant_combname = {COMB}")
BANKRUPTCY = _status_report(
    "e.status_reason = 'BANKRUPTCY'", "status_reason", f"a.merchant_combname = {COMB}", cutover=True
)
BANKRUPTCY_JUNE = _status_report(
    "e.status_reason = 'BANKRUPTCY'", "status_reason", f"a.merchant_combname = {COMB}", cutover=True,
    month_test=in_month("e.started_at_est", "TIMESTAMP '1998-06-01'"),
)
BANKRUPTCY_MONTH_NUMBER = _status_report(
    "e.status_reason = 'BANKRUPTCY'",
    "status_reason",
    f"a.merchant_combname = {COMB}",
    month_test="extract(month FROM e.started_at_est) = 5",
)
CHARGE_OFF = _status_report("e.status = 'CHARGE_OFF'", "status", f"a.merchant_combname = {COMB}")
SCRA = _status_report(
    "e.status_reason IN ('SCRA', 'CONVERTED_SCRA') AND e.is_treatment = 'True'",
    "status_reason",
    f"a.merchant_name IN {NAMES}",
    merchant=True,
)

COLLECTIONS = with_views(
    ["status_events", "accounts", "loan_tape"],
    f"""SELECT a.product_account_uuid,
               CAST(DATE '1998-05-31' - t.days_past_due AS TIMESTAMP) AS started_at_est,
               'DELINQUENT' AS status, t.merchant_name
        FROM v_loan_tape t, v_accounts a
        WHERE a.credit_line_uuid = t.credit_line_uuid AND t.merchant_name IN {NAMES}
          AND t.activity_date = DATE '1998-05-31' AND t.days_past_due > 0
        UNION
        SELECT product_account_uuid, best.t, best.d, best.m
        FROM (SELECT e.product_account_uuid,
                     min({{'t': e.started_at_est, 'd': e.status_reason, 'm': a.merchant_name}}) AS best
              FROM v_status_events e, v_accounts a
              WHERE a.product_account_uuid = e.product_account_uuid AND NOT a.is_test_account
                AND a.merchant_name IN {NAMES} AND e.status_reason IN ('CCCS', 'DECEASED')
                AND {in_month("e.started_at_est", ORDERS_MONTH)}
              GROUP BY e.product_account_uuid)""",
)

MLA = with_views(
    ["hardpull", "accounts"],
    f"""SELECT best.a AS product_account_uuid, TRUE AS mla_flag
        FROM (SELECT h.application_uuid, min({{'t': h.updated_at_est, 'a': a.product_account_uuid}}) AS best
              FROM v_hardpull h, v_accounts a
              WHERE a.application_uuid = h.application_uuid AND h.mla_flag AND NOT a.is_test_account
                AND a.merchant_combname = {COMB} AND {in_month("h.updated_at_est", ORDERS_MONTH)}
              GROUP BY h.application_uuid)""",
)

APPLICATIONS = with_views(
    ["applications"],
    f"""SELECT application_uuid, application_status, application_submitted_at_est FROM v_applications
        WHERE merchant_combname = {COMB} AND NOT is_test_account
          AND {in_month("application_submitted_at_est", ORDERS_MONTH)}
          AND application_submitted_at_est >= {ORDERS_CUTOVER}
        ORDER BY application_submitted_at_est, application_status, application_uuid""",
)

DIGITS = "regexp_replace(n.call_from_number, '[^0-9]', '', 'g')"
# One row per call, number on its ticket and owner of the number.
LOOKUP = f"""numbers AS (SELECT DISTINCT ticket_id, call_from_number FROM v_ticket_comments
                 WHERE call_from_number IS NOT NULL),
    phones AS (SELECT c.call_id, c.ticket_id,
                      CASE WHEN {DIGITS} SIMILAR TO '1[0-9]{{10}}' THEN substr({DIGITS}, 2) ELSE {DIGITS} END AS user_phone
               FROM v_contact_calls c LEFT JOIN numbers n ON n.ticket_id = c.ticket_id),
    owners AS (SELECT DISTINCT phone, consumer_uuid FROM v_profiles),
    lookup AS (SELECT p.call_id, p.ticket_id, p.user_phone, o.consumer_uuid
               FROM phones p LEFT JOIN owners o ON o.phone = p.user_phone)"""
NOT_MERGED = f"""NOT EXISTS (SELECT 1 FROM v_ticket_tag_history m
    WHERE m.tag_name = '{fv.TAG_MERGED}' AND m.ticket_id = c.ticket_id)"""
CONTACT_VIEWS = ["contact_calls", "ticket_comments", "profiles", "accounts", "ticket_tag_history"]

AGENT_CALL = f"""(c.call_direction = 'inbound' AND c.custom_reason_code IS DISTINCT FROM '{fv.REASON_TESTING}'
    AND c.is_overflowed = 'FALSE' AND coalesce(c.ivr_action, 'group') = 'group'
    AND c.is_call_outside_business_hours = 'FALSE'"""
OFFERED = AGENT_CALL + " AND c.call_completion_status IS DISTINCT FROM 'abandoned_in_ivr')"
HANDLED = AGENT_CALL + f" AND c.call_completion_status IN {text_list(fv.HANDLED_STATUSES)} " \
    "AND NOT c.has_customer_requested_voicemail)"
ABANDONED = AGENT_CALL + f" AND c.call_completion_status IN {text_list(fv.ABANDONED_STATUSES)} " \
    "AND NOT c.has_customer_requested_voicemail)"


def _cases(group: str, timestamp: str, reasons, repeated: bool = True) -> str:
    taken = "coalesce(c.ticket_created_at_est, c.call_created_at_est)"
    lookup = "LEFT JOIN lookup l ON l.call_id = c.call_id" if repeated else ""
    return with_views(
        CONTACT_VIEWS,
        f""", {LOOKUP}
        SELECT a.product_account_uuid, c.custom_imprint_uuid, {taken} AS {timestamp}, c.custom_reason_code, a.merchant_name
        FROM v_contact_calls c {lookup}
        LEFT JOIN v_accounts a ON a.consumer_uuid = c.custom_imprint_uuid AND a.merchant_combname = {COMB}
        WHERE c.brand_id IN {BRANDS} AND c.ticket_group = '{group}' AND {NOT_MERGED}
          AND c.custom_reason_code NOT IN {text_list(reasons)}
          AND {in_month(taken, EVENTS_MONTH)} AND {taken} >= {EVENTS_CUTOVER}""",
    )


DISPUTES = _cases(fv.GROUP_DISPUTES, "dispute_timestamp", [fv.REASON_TESTING])
DISPUTES_DEDUPED = _cases(fv.GROUP_DISPUTES, "dispute_timestamp", [fv.REASON_TESTING], repeated=False)
FRAUD_CASES = _cases(fv.GROUP_FRAUD, "fraud_timestamp", [fv.REASON_TESTING, fv.REASON_BULK_REQUEST])

_TAKEN = "coalesce(c.call_created_at_est, c.ticket_created_at_est)"
CALLS = with_views(
    CONTACT_VIEWS,
    f""", {LOOKUP}
    SELECT a.product_account_uuid, coalesce(c.custom_imprint_uuid, l.consumer_uuid) AS consumer_uuid,
           {_TAKEN} AS call_timestamp, c.custom_reason_code AS call_category, c.ticket_id,
           {COMB} AS program_name, c.call_direction
    FROM v_contact_calls c LEFT JOIN lookup l ON l.call_id = c.call_id
    LEFT JOIN v_accounts a ON a.consumer_uuid = coalesce(c.custom_imprint_uuid, l.consumer_uuid)
                          AND a.merchant_combname = {COMB}
    WHERE c.brand_id IN {BRANDS} AND ({OFFERED} OR c.call_direction = 'outbound') AND {NOT_MERGED}
      AND {in_month(_TAKEN, EVENTS_MONTH)} AND {_TAKEN} >= {EVENTS_CUTOVER}
    ORDER BY call_timestamp DESC""",
)

_UTC = "coalesce(c.call_created_at, c.ticket_created_at)"
_KPI_ROWS = f"""FROM v_contact_calls c WHERE c.brand_id IN {BRANDS}
    AND {in_month(_UTC, EVENTS_MONTH)} AND {_UTC} >= {EVENTS_CUTOVER}"""


def kpi_sql(distinct: str = "DISTINCT") -> str:
    counts = [
        (fv.CALLS_OFFERED, OFFERED),
        (fv.CALLS_HANDLED, HANDLED),
        (fv.CALLS_ABANDONED, ABANDONED),
        (fv.CALLS_OUTBOUND, "(c.call_direction = 'outbound')"),
    ]
    lines = [
        f"SELECT '{label}' AS statistic, CAST(count(DISTINCT c.call_id) AS DOUBLE) AS num {_KPI_ROWS} AND {test}"
        for label, test in counts
    ]
    lines.append(
        f"SELECT '{fv.AVG_SPEED_OF_ANSWER}', CAST(avg({distinct} c.call_wait_time_seconds) AS DOUBLE) "
        f"{_KPI_ROWS} AND {OFFERED}"
    )
    lines.append(
        f"SELECT '{fv.AVG_HANDLE_TIME}', round(avg(c.call_talk_time_seconds + c.call_hold_time_seconds "
        f"+ c.call_wrap_up_time_seconds), 2) {_KPI_ROWS} AND c.call_direction = 'inbound' "
        "AND c.call_talk_time_seconds > 0"
    )
    return with_views(["contact_calls"], " UNION ".join(lines))


CALL_KPIS = kpi_sql()

_MANUAL = " UNION ALL ".join(
    f"SELECT '{label}', CAST({'NULL' if value is None else value} AS DOUBLE)"
    for label, value in fv.MANUAL_SERVICE_LEVELS
)
SLA = with_views(
    ["contact_calls"],
    f"""SELECT '{fv.CALL_RESPONSE_IN_TIME}' AS statistic,
               count(DISTINCT CASE WHEN c.call_wait_time_seconds <= 120 THEN c.call_id END)
               / CAST(nullif(count(DISTINCT c.call_id), 0) AS DOUBLE) AS num
        FROM v_contact_calls c
        WHERE c.brand_id IN {BRANDS} AND {OFFERED} AND c.custom_reason_code IS NOT NULL
          AND {in_month(_UTC, EVENTS_MONTH)}
        UNION ALL {_MANUAL}""",
)

LOCAL_DAY = "CAST(timezone('America/New_York', timezone('UTC', h.updated_at)) AS DATE)"
SOLVED = f"""solved AS (SELECT ticket_id, day FROM (
        SELECT h.ticket_id, {LOCAL_DAY} AS day,
               row_number() OVER (PARTITION BY h.ticket_id ORDER BY h.updated_at DESC NULLS FIRST) AS nth
        FROM v_ticket_field_history h WHERE h.field_name = 'status' AND h.field_value = 'solved') WHERE nth = 1)"""
MERGED = """absorbed AS (SELECT DISTINCT ticket_id, custom_imprint_uuid,
                      unnest(from_json(merged_ticket_ids, '["VARCHAR"]')) AS merged_id
               FROM v_tickets
               WHERE coalesce(custom_imprint_uuid, '') <> ''
                 AND custom_does_contact_have_account_with_imprint IS DISTINCT FROM 'no_uuid_needed')"""
THROUGH = """through AS (SELECT a.ticket_id, max(s.day) AS day
              FROM absorbed a JOIN solved s ON s.ticket_id = a.merged_id GROUP BY a.ticket_id)"""


def _complaints(tiers, columns: str) -> str:
    return with_views(
        ["tickets", "ticket_field_history", "brands"],
        f""", {SOLVED}, {MERGED}, {THROUGH}
        SELECT {columns} t.custom_issue_summary, t.custom_complaint_summary, t.custom_complaint_resolution,
               coalesce(s.day, m.day) AS solve_date
        FROM v_tickets t LEFT JOIN v_brands b ON b.brand_id = t.brand_id
        LEFT JOIN solved s ON s.ticket_id = t.ticket_id LEFT JOIN through m ON m.ticket_id = t.ticket_id
        WHERE t.custom_complaint = 'TRUE' AND t.brand_id IN {BRANDS} AND t.custom_issue_summary <> 'Test'
          AND t.custom_criticality IN {text_list(tiers)}
          AND {in_month("coalesce(s.day, m.day)", EVENTS_MONTH)}
          AND coalesce(s.day, m.day) >= {EVENTS_CUTOVER}""",
    )


COMPLAINTS_TIER1 = _complaints(fv.TIER_1, "t.custom_imprint_uuid,")
COMPLAINTS_TIER2 = _complaints(fv.TIERS_2_3, "")

CREDIT_REFUNDS = with_views(
    ["transactions"],
    f"""SELECT product_account_uuid, transaction_confirmed_at_est, CAST(0 - amount AS DOUBLE) AS amount
        FROM v_transactions
        WHERE transaction_type = 'CREDIT_RETURN' AND merchant_combname = {COMB}
          AND purchase_merchant_name = 'Credit balance refunded' AND {in_month("created_at_est", ORDERS_MONTH)}""",
)

_OPEN = "TIMESTAMP '9999-12-31'"
# Every transaction row with its rate: all intervals around the time, best one kept.
RATED = f"""numbered AS (SELECT *, row_number() OVER () AS row_no FROM v_transactions),
    rated AS (SELECT n.*, r.final_apr, r.effective_end_at_est
      FROM numbered n LEFT JOIN v_apr_history r ON r.credit_line_uuid = n.credit_line_uuid
       AND n.transaction_confirmed_at_est >= r.effective_start_at_est
       AND (n.transaction_confirmed_at_est < r.effective_end_at_est OR r.effective_end_at_est IS NULL)
      QUALIFY row_number() OVER (PARTITION BY n.row_no ORDER BY coalesce(r.effective_end_at_est, {_OPEN}) DESC,
              r.effective_start_at_est DESC, r.final_apr DESC) = 1)"""

TRANSACTIONS = with_views(
    ["transactions", "accounts", "apr_history"],
    f""", {RATED}
    SELECT DISTINCT product_account_uuid, consumer_uuid, purchase_merchant_name, transaction_confirmed_at_est,
           transaction_type, CAST(0 - amount AS DOUBLE) AS signed_amount, fee_reason, interest_reason,
           CAST(final_apr AS DOUBLE) AS final_apr
    FROM (SELECT a.product_account_uuid, t.* EXCLUDE (product_account_uuid)
          FROM rated t JOIN v_accounts a ON a.credit_line_uuid = t.credit_line_uuid
          WHERE NOT a.is_test_account AND t.merchant_combname = {COMB} AND t.transaction_status = 'CONFIRMED'
            AND t.transaction_type <> 'AUTH' AND NOT t.is_stmt_pseudo_txn AND NOT t.is_pre_conversion_txn
            AND {in_month("t.transaction_confirmed_at_est", ORDERS_MONTH)}
            AND t.transaction_confirmed_at_est >= {ORDERS_CUTOVER}
          QUALIFY row_number() OVER (PARTITION BY t.transaction_uuid
              ORDER BY coalesce(t.effective_end_at_est, {_OPEN}) DESC, a.product_account_uuid, t.consumer_uuid,
                       t.purchase_merchant_name, t.transaction_confirmed_at_est, t.transaction_type, 0 - t.amount,
                       t.fee_reason, t.interest_reason, t.final_apr) = 1)""",
)

CHAIN = """chain AS (SELECT d.transaction_uuid AS dispute_transaction_uuid,
             d.source_transaction_id AS posted_transaction_uuid, d.dispute_reason, d.dispute_explanation,
             d.consumer_uuid AS dispute_consumer_uuid, d.transaction_pending_at_est AS dispute_start,
             d.updated_at_est AS dispute_updated, d.transaction_status AS dispute_status,
             d.purchase_method, d.purchase_category, d.purchase_category_code, d.merchant_name,
             d.purchase_merchant_name, d.amount, d.auth_user_uuid,
             p.original_id AS transaction_original, p.transaction_confirmed_at_est AS transaction_date,
             u.transaction_uuid AS auth_transaction_uuid,
             g.transaction_uuid AS log_transaction_uuid, g.reason_for_dispute, g.workflow_stage,
             g.billing_error_status_resolution
      FROM (SELECT * FROM v_transactions WHERE transaction_type = 'DISPUTE') d
      LEFT JOIN v_transactions p ON p.transaction_uuid = d.source_transaction_id
      LEFT JOIN v_transactions u ON u.source_transaction_id = p.original_id
      LEFT JOIN v_disputes_log g ON g.transaction_uuid IN
           (d.transaction_uuid, d.source_transaction_id, u.transaction_uuid))"""

REISSUE = """reissue AS (SELECT k.card_uuid, k.product_account_uuid, k.card_status, k.card_type, k.cancel_reason,
             k.last_ingest_at_est, t.created_at_est AS txn_created_at_est, t.transaction_uuid,
             date_diff('day', CAST(k.last_ingest_at_est AS DATE), CAST(t.created_at_est AS DATE)) AS date_diff
      FROM v_card_status_history k JOIN v_transactions t ON t.card_uuid = k.card_uuid
       AND date_diff('day', CAST(k.last_ingest_at_est AS DATE), CAST(t.created_at_est AS DATE)) BETWEEN -3 AND 0
      WHERE k.card_status = 'CANCELED')"""

_ALLOW = text_list(fv.SMS_STEPS_ALLOW)
_FRAUD_STEPS = text_list((*fv.SMS_STEPS_LOCK_BY_RULE, *fv.SMS_STEPS_LOCK, *fv.SMS_STEPS_CONFIRMED_FRAUD))
_REPLIED = text_list((*fv.SMS_STEPS_ALLOW, *fv.SMS_STEPS_LOCK_BY_RULE, *fv.SMS_STEPS_CONFIRMED_FRAUD))
_DECIDED = text_list((*fv.SMS_STEPS_ALLOW, *fv.SMS_STEPS_CONFIRMED_FRAUD))
_UNRECOGNIZED = text_list(fv.SMS_STEPS_UNRECOGNIZED)
SMS = f"""sms_all AS (SELECT e.execution_id, e.created_at_est, s.created_at_est AS step_created_at_est,
             s.created_at_est + INTERVAL 2 DAY AS allowlist_window, l.consumer_uuid, l.source_uuid,
             l.transactionamount AS amount, l.cardname AS card_name, s.execution_step_name, s.transitioned_from,
             s.transitioned_to, coalesce(s.transitioned_from IN {_ALLOW}, FALSE) AS is_not_fraud_sms,
             coalesce(s.transitioned_from IN {_FRAUD_STEPS}, FALSE) AS is_fraud_sms,
             coalesce(s.transitioned_from NOT IN {_REPLIED} AND e.execution_status = 'ended', FALSE) AS is_no_reply_sms,
             coalesce(s.transitioned_from IN {_UNRECOGNIZED}, FALSE) AS has_unrecognized_sms,
             e.execution_status AS execution_status_sms,
             CASE WHEN s.transitioned_from IN {_DECIDED} THEN 0 ELSE 1 END AS priority
      FROM v_sms_executions e LEFT JOIN v_sms_execution_log l ON l.event_id = e.execution_id
      LEFT JOIN v_sms_execution_steps s ON s.execution_id = e.execution_id
      WHERE e.flow_id = '{fv.SMS_FLOW_ID}' AND e.created_at_est >= {SMS_SINCE}),
    sms AS (SELECT * FROM sms_all QUALIFY row_number() OVER (PARTITION BY execution_id ORDER BY priority,
             step_created_at_est NULLS LAST, execution_step_name NULLS LAST, transitioned_from NULLS LAST,
             transitioned_to NULLS LAST, source_uuid NULLS LAST, consumer_uuid NULLS LAST, amount NULLS LAST,
             card_name NULLS LAST) = 1)"""

# Every transaction of the month with every combination of its account states, disputes, cards and replies.
def signals_sql(month_test: str) -> str:
    return f"""signals AS (SELECT t.row_no, t.transaction_uuid, t.source_transaction_id, t.product_account_uuid,
             t.amount,
             coalesce(t.purchase_auth_rejection_reason NOT IN {text_list(fv.REJECTIONS_BY_FRAUD_RULES)}, FALSE) AS auth_signal,
             coalesce((c.dispute_reason = 'FRAUDULENT' OR c.reason_for_dispute ILIKE '%unauthorized%')
                 AND c.workflow_stage = 'Resolution'
                 AND c.billing_error_status_resolution = 'Borrower favor', FALSE) AS dispute_signal,
             coalesce(e.status_reason_code IN {text_list(fv.STATUS_CODES_FRAUD)}, FALSE) AS status_signal,
             coalesce(r.cancel_reason IN {text_list(fv.CANCEL_REASONS_FRAUD)}, FALSE) AS card_signal,
             coalesce(s.is_fraud_sms, FALSE) AS sms_signal
      FROM (SELECT *, row_number() OVER () AS row_no FROM v_transactions) t
      LEFT JOIN (SELECT * FROM v_status_events WHERE is_latest = 'TRUE') e
             ON e.product_account_uuid = t.product_account_uuid
      LEFT JOIN chain c ON c.auth_transaction_uuid = t.transaction_uuid
      LEFT JOIN reissue r ON r.transaction_uuid = t.transaction_uuid
      LEFT JOIN sms s ON s.source_uuid = t.source_transaction_id
      WHERE t.merchant_combname = {COMB} AND t.transaction_status IN {text_list(fv.FRAUD_LINE_STATUSES)}
        AND {month_test})"""


SIGNALS = signals_sql(in_month("t.transaction_pending_at_est", ORDERS_MONTH))
ANY_SIGNAL = "(auth_signal OR dispute_signal OR status_signal OR card_signal OR sms_signal)"
FRAUD_VIEWS = [
    "transactions",
    "status_events",
    "disputes_log",
    "card_status_history",
    "sms_executions",
    "sms_execution_log",
    "sms_execution_steps",
]

_BUCKET = "CASE WHEN coalesce(days_past_due, 0) = 0 THEN 'A. current' " + " ".join(
    f"WHEN days_past_due >= {first} THEN '{label}'" for label, first, _ in reversed(fv.AGEING_BUCKETS)
) + " ELSE 'error' END"
BUCKET_SQL = _BUCKET


def portfolio_sql(one_row_per_txn: bool = False, last_snapshot: bool = False) -> str:
    charge_month = (
        "activity_date = DATE '1998-05-31'" if last_snapshot else in_month("activity_date", ORDERS_MONTH)
    )
    fraud_rows = (
        f"(SELECT DISTINCT row_no, product_account_uuid, amount FROM signals WHERE {ANY_SIGNAL})"
        if one_row_per_txn
        else f"(SELECT product_account_uuid, amount FROM signals WHERE {ANY_SIGNAL})"
    )
    return with_views(
        [*FRAUD_VIEWS, "loan_tape", "profile_reconcile", "daily_account_balance"],
        f""", {CHAIN}, {REISSUE}, {SMS}, {SIGNALS}
        SELECT {_BUCKET} AS dpd_bucket, count(DISTINCT t.credit_line_uuid) AS n_accounts,
               CAST(sum(t.total_balance) AS DOUBLE) AS amount
        FROM v_loan_tape t LEFT JOIN v_profile_reconcile p ON p.credit_line_uuid = t.credit_line_uuid
        WHERE t.activity_date = DATE '1998-05-31' AND t.merchant_name IN {NAMES} GROUP BY 1
        UNION
        SELECT 'charge off', count(DISTINCT product_account_uuid), CAST(sum(total_charged_off) AS DOUBLE)
        FROM v_daily_account_balance
        WHERE eod_status = 'CHARGE_OFF' AND merchant_name IN {text_list(fv.PROGRAM_CHARGE_OFF_NAMES)}
          AND NOT is_test_account AND {charge_month}
        UNION
        SELECT 'disputes', count(DISTINCT product_account_uuid), CAST(sum(amount) AS DOUBLE)
        FROM v_transactions
        WHERE transaction_type = 'DISPUTE' AND merchant_combname = {COMB}
          AND {in_month("transaction_pending_at_est", ORDERS_MONTH)}
        UNION
        SELECT 'fraud', count(DISTINCT product_account_uuid), CAST(sum(0 - amount) AS DOUBLE) FROM {fraud_rows}""",
    )


PORTFOLIO = portfolio_sql()


def correspondence_sql(grouped: bool = False) -> str:
    here_and_now = f"c.brand_id IN {BRANDS} AND {in_month('c.ticket_created_at_est', EVENTS_MONTH)}"
    ours = f"u.user_signature LIKE '{fv.SUPPORT_SIGNATURE_PATTERN}'"
    if grouped:
        first = f"c.request_channel = 'email' AND coalesce(NOT {ours}, TRUE) AND {here_and_now}"
    else:
        first = f"(c.request_channel = 'email' AND NOT {ours}) OR (u.user_signature IS NULL AND {here_and_now})"
    return with_views(
        ["contact_calls", "users", "accounts", "email_event", "canvas"],
        f"""SELECT a.product_account_uuid, c.ticket_created_at_est AS "timestamp",
                   CASE WHEN coalesce(NOT {ours}, TRUE) AND c.submitter_role NOT IN {text_list(fv.STAFF_ROLES)}
                        THEN 'inbound' ELSE 'outbound' END AS direction,
                   '{fv.SUPPORT_EMAIL}' AS correspondence_type
            FROM v_contact_calls c LEFT JOIN v_users u ON u.user_id = c.submitter_user_id
            LEFT JOIN v_accounts a ON a.consumer_uuid = c.custom_imprint_uuid
            WHERE {first}
            UNION
            SELECT a.product_account_uuid, c.ticket_created_at_est, 'inbound', '{fv.SUPPORT_EMAIL}'
            FROM v_contact_calls c LEFT JOIN v_accounts a ON a.consumer_uuid = c.custom_imprint_uuid
            WHERE c.request_channel = 'email' AND {here_and_now}
            UNION
            SELECT a.product_account_uuid, e.time_at_est, 'outbound', '{fv.MARKETING_EMAIL}'
            FROM v_email_event e JOIN v_accounts a ON a.consumer_uuid = e.external_user_id
            WHERE a.merchant_combname = {COMB} AND e.event_type = '{fv.EVENT_EMAIL_SEND}'
              AND e.canvas_id IN (SELECT canvas_id FROM v_canvas WHERE canvas_name LIKE '{fv.CANVAS_NAME_PATTERN}')
              AND {in_month("e.time_at_est", EVENTS_MONTH)}""",
    )


CORRESPONDENCE = correspondence_sql()

OPT_OUTS = with_views(
    ["subscription_event", "email_event", "accounts"],
    f"""SELECT DISTINCT coalesce(s.external_user_id, u.external_user_id) AS consumer_uuid, s.channel, s.time_at_est
        FROM v_subscription_event s FULL JOIN
             (SELECT DISTINCT external_user_id FROM v_email_event
              WHERE upper(event_type) = '{fv.EVENT_EMAIL_UNSUBSCRIBE}') u
          ON u.external_user_id = s.external_user_id
        WHERE upper(s.subscription_status) = 'UNSUBSCRIBED' AND {in_month("s.time_at_est", EVENTS_MONTH)}
          AND s.external_user_id IN (SELECT consumer_uuid FROM v_accounts WHERE merchant_combname = {COMB})""",
)
