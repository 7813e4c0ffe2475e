"""Operators over whole driver tables, each with the SQL for the same rows."""

from __future__ import annotations

import datetime as dt
from functools import partial
from inspect import signature

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import report_sql as sql
from checks.catalog import EVENTS, HOT, ORDERS, Check, plain
from checks.driver_views import driver_sources, with_views
from monthclose import fixed_values as fv
from monthclose import plans
from monthclose.functions.dates import (
    day_distance,
    delinquent_since,
    local_date,
    month_end_snapshot,
    prior_month,
    since,
    to_local,
    week_start,
    year_month,
)
from monthclose.functions.labels import (
    channel_of,
    dpd_bucket,
    email_direction,
    inbound_agent_call,
    not_support_signature,
    program_of,
)
from monthclose.functions.text import blank_to_null, digits, normalize_phone
from monthclose.operators.calls import call_funnel, sla_ratio
from monthclose.operators.dedup import first_event, latest_event, with_volume
from monthclose.operators.fraud import (
    cancel_near_txn,
    cancel_tally,
    dispute_chain,
    dispute_tally,
    fraud_signals,
    sms_outcome,
)
from monthclose.operators.identity import contact_identity, exclude_merged
from monthclose.operators.joins import any_key_join
from monthclose.operators.skew import filter_by_key, full_outer_join, left_join
from monthclose.operators.tickets import merged_pairs, merged_resolution
from monthclose.plans.transactions import rate_in_force

OPERATORS: dict[str, Check] = {}
AS_OF = dt.date(1998, 6, 15)


def check(sql_text: str | None):
    """Register a function of (sources) as a query, with its SQL. One that takes a skew policy too is registered a
    second time, with a policy that makes keys of the driver tables hot."""

    def register(function):
        def build(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
            return plain(function(driver_sources(spark, sf_dir), **options))

        OPERATORS[function.__name__] = Check(build, sql_text)
        if "policy" in signature(function).parameters:
            OPERATORS[f"{function.__name__}_hot_keys"] = Check(partial(build, policy=HOT), sql_text)
        return function

    return register


# Month windows and dates


@check(
    """SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
    FROM lineitem WHERE l_shipdate >= DATE '1998-05-01' AND l_shipdate < DATE '1998-06-01' GROUP BY 1"""
)
def prior_month_calendar(s):
    month = prior_month(s.table("lineitem"), "l_shipdate", AS_OF)
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return month.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum(price).alias("price"))


@check(
    """SELECT extract(year FROM o_orderdate) AS y, count(*) AS n FROM orders
    WHERE extract(month FROM o_orderdate) = 5 GROUP BY 1"""
)
def prior_month_number(s):
    month = prior_month(s.table("orders"), "o_orderdate", AS_OF, rule="month_number")
    return month.groupBy(F.year("o_orderdate").cast("bigint").alias("y")).agg(F.count(F.lit(1)).alias("n"))


@check(
    with_views(
        ["contact_calls"],
        """SELECT call_direction, count(*) AS n FROM v_contact_calls
        WHERE date_trunc('month', coalesce(call_created_at_est, ticket_created_at_est)) = DATE '2024-01-01'
        GROUP BY 1""",
    )
)
def prior_month_first_of(s):
    month = prior_month(s["contact_calls"], ["call_created_at_est", "ticket_created_at_est"], EVENTS.as_of)
    return month.groupBy("call_direction").agg(F.count(F.lit(1)).alias("n"))


@check(
    """SELECT o_orderstatus, count(*) AS n FROM orders
    WHERE date_trunc('day', o_orderdate) >= DATE '1998-05-10' GROUP BY 1"""
)
def since_cutover(s):
    late = since(s.table("orders"), "o_orderdate", dt.date(1998, 5, 10))
    return late.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@check(
    with_views(
        ["loan_tape"],
        """SELECT credit_line_uuid, activity_date, days_past_due FROM v_loan_tape
        WHERE activity_date = DATE '1998-05-31'""",
    )
)
def month_end_rows(s):
    tape = month_end_snapshot(s["loan_tape"], "activity_date", AS_OF)
    return tape.select("credit_line_uuid", "activity_date", "days_past_due")


@check(
    with_views(
        ["loan_tape"],
        """SELECT CAST(DATE '1998-05-31' - days_past_due AS DATE) AS behind_since, count(*) AS n FROM v_loan_tape
        WHERE days_past_due > 0 GROUP BY 1""",
    )
)
def behind_since(s):
    behind = s["loan_tape"].where(F.col("days_past_due") > 0)
    return behind.groupBy(delinquent_since(F.col("days_past_due"), AS_OF).alias("behind_since")).agg(
        F.count(F.lit(1)).alias("n")
    )


_LOCAL = "timezone('America/New_York', timezone('UTC', ticket_created_at))"


@check(
    with_views(
        ["tickets"],
        f"""SELECT date_diff('day', CAST({_LOCAL} AS DATE), CAST(ticket_created_at AS DATE)) AS days, count(*) AS n
        FROM v_tickets GROUP BY 1""",
    )
)
def day_boundaries(s):
    """Midnights between the local and the UTC time of a ticket: five hours apart, yet one day late in the evening."""
    created = F.col("ticket_created_at")
    days = day_distance(to_local(created, EVENTS), created).cast("bigint")
    return s["tickets"].groupBy(days.alias("days")).agg(F.count(F.lit(1)).alias("n"))


@check(
    with_views(
        ["tickets"],
        f"""SELECT ticket_id, {_LOCAL} AS created_at_est, CAST({_LOCAL} AS DATE) AS created_date,
                   strftime({_LOCAL}, '%Y-%m') AS year_month,
                   CAST(date_trunc('week', CAST({_LOCAL} AS DATE)) AS DATE) AS weekstart FROM v_tickets""",
    )
)
def local_times(s):
    created = to_local(F.col("ticket_created_at"), EVENTS)
    return (
        s["tickets"]
        .select("ticket_id", created.alias("created_at_est"))
        .withColumns(
            {"created_date": F.to_date("created_at_est"), "year_month": year_month(F.col("created_at_est"))}
        )
        .withColumn("weekstart", week_start(F.col("created_date")))
    )


# First and latest rows


@check(
    """SELECT o_custkey, best.d AS o_orderdate, best.k AS o_orderkey
    FROM (SELECT o_custkey, min({'d': o_orderdate, 'k': o_orderkey}) AS best FROM orders GROUP BY 1)"""
)
def first_per_key(s):
    return first_event(
        s.table("orders").select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], ["o_orderdate"]
    )


@check(
    with_views(
        ["contact_calls"],
        """SELECT brand_id, user_key, ticket_id, call_created_at FROM (
            SELECT brand_id, submitter_user_id AS user_key, ticket_id, call_created_at,
                   row_number() OVER (PARTITION BY brand_id, submitter_user_id
                                      ORDER BY call_created_at DESC NULLS FIRST, ticket_id) AS nth
            FROM v_contact_calls) WHERE nth = 1""",
    )
)
def latest_per_key(s):
    calls = s["contact_calls"].select(
        "brand_id", F.col("submitter_user_id").alias("user_key"), "ticket_id", "call_created_at"
    )
    return latest_event(calls, ["brand_id", "user_key"], ["call_created_at"])


@check(
    """SELECT user_id, event_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY CASE WHEN event_type IN ('purchase', 'signup') THEN 0 ELSE 1 END, ts, event_id) AS nth
        FROM events) WHERE nth = 1"""
)
def first_by_priority(s):
    ranked = s.table("events").select(
        "user_id",
        "event_id",
        "event_type",
        "ts",
        F.when(F.col("event_type").isin("purchase", "signup"), 0).otherwise(1).alias("priority"),
    )
    return first_event(ranked, ["user_id"], ["priority", "ts"]).select("user_id", "event_id", "event_type")


@check(
    with_views(
        ["apr_history"],
        """SELECT credit_line_uuid, effective_start_at_est, effective_end_at_est, CAST(final_apr AS DOUBLE) AS final_apr
        FROM v_apr_history QUALIFY row_number() OVER (PARTITION BY credit_line_uuid
            ORDER BY coalesce(effective_end_at_est, TIMESTAMP '9999-12-31') DESC, effective_start_at_est, final_apr) = 1""",
    )
)
def open_interval_first(s):
    open_end = F.lit(fv.OPEN_END).cast("timestamp_ntz")
    return first_event(
        s["apr_history"],
        ["credit_line_uuid"],
        [F.coalesce("effective_end_at_est", open_end).desc()],
        tie_break=["effective_start_at_est", "final_apr"],
    )


@check("SELECT DISTINCT o_orderstatus, o_orderpriority, o_custkey FROM orders")
def distinct_rows(s):
    return s.table("orders").select("o_orderstatus", "o_orderpriority", "o_custkey").distinct()


# Contacts


@check(
    with_views(
        ["ticket_comments"],
        f"""SELECT call_from_number, CASE WHEN left({sql.DIGITS}, 1) = '1' AND length({sql.DIGITS}) = 11
                   THEN right({sql.DIGITS}, 10) ELSE {sql.DIGITS} END AS user_phone,
                   length({sql.DIGITS}) AS n_digits, count(*) AS n
            FROM v_ticket_comments n GROUP BY 1, 2, 3""",
    )
)
def phone_numbers(s):
    number = F.col("call_from_number")
    return (
        s["ticket_comments"]
        .groupBy(number)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            number,
            normalize_phone(number).alias("user_phone"),
            F.length(digits(number)).cast("bigint").alias("n_digits"),
            "n",
        )
    )


@check(
    with_views(
        ["contact_calls", "ticket_comments", "profiles"],
        f", {sql.LOOKUP} SELECT call_id, ticket_id, user_phone, consumer_uuid FROM lookup",
    )
)
def identity_of_calls(s):
    return contact_identity(s["contact_calls"], s["ticket_comments"], s["profiles"], EVENTS.skew).select(
        "call_id", "ticket_id", "user_phone", "consumer_uuid"
    )


@check(
    with_views(
        ["contact_calls", "ticket_tag_history"],
        """SELECT c.ticket_id, c.call_id FROM v_contact_calls c ANTI JOIN
        (SELECT ticket_id FROM v_ticket_tag_history WHERE tag_name = 'closed_by_merge') m ON m.ticket_id = c.ticket_id""",
    )
)
def unmerged_tickets(s):
    return exclude_merged(s["contact_calls"].select("ticket_id", "call_id"), s["ticket_tag_history"], EVENTS.skew)


@check(
    with_views(
        ["email_event", "canvas"],
        f"""SELECT external_user_id, canvas_id, time_at_est FROM v_email_event
        WHERE canvas_id IN (SELECT canvas_id FROM v_canvas WHERE canvas_name LIKE '{fv.CANVAS_NAME_PATTERN}')""",
    )
)
def semi_join_rows(s):
    wanted = s["canvas"].where(F.col("canvas_name").like(fv.CANVAS_NAME_PATTERN)).select("canvas_id")
    events = s["email_event"].select("external_user_id", "canvas_id", "time_at_est")
    return filter_by_key(events, wanted, ["canvas_id"], EVENTS.skew)


@check(
    with_views(
        ["contact_calls", "accounts"],
        f"""SELECT c.ticket_id, c.program_name, a.product_account_uuid
        FROM (SELECT *, CASE WHEN brand_id IN {sql.BRANDS} THEN {sql.COMB} ELSE 'Elsewhere' END AS program_name
              FROM v_contact_calls) c
        LEFT JOIN v_accounts a ON a.consumer_uuid = coalesce(c.custom_imprint_uuid, 'C' || substr(c.submitter_user_id, 2))
                              AND a.merchant_combname = c.program_name""",
    )
)
def accounts_of_calls(s):
    """Left join on a coalesced key and a computed program name."""
    calls = s["contact_calls"].select(
        "ticket_id",
        program_of(F.col("brand_id"), EVENTS.program, other="Elsewhere").alias("program_name"),
        F.coalesce("custom_imprint_uuid", F.concat(F.lit("C"), F.substring("submitter_user_id", 2, 30))).alias(
            "consumer_uuid"
        ),
    )
    accounts = s["accounts"].select(
        "consumer_uuid", F.col("merchant_combname").alias("program_name"), "product_account_uuid"
    )
    joined = left_join(calls, accounts, ["consumer_uuid", "program_name"], EVENTS.skew, hot_in=accounts)
    return joined.select("ticket_id", "program_name", "product_account_uuid")


@check(
    with_views(
        ["contact_calls", "ticket_tag_history"],
        """SELECT c.ticket_group, t.tag_name, count(*) AS n FROM v_contact_calls c
        LEFT JOIN v_ticket_tag_history t ON t.ticket_id = c.ticket_id AND t.tag_name = 'spam' GROUP BY 1, 2""",
    )
)
def left_join_constant_side(s):
    """Left join with a condition on the right side alone: the right side is filtered first."""
    spam = s["ticket_tag_history"].where(F.col("tag_name") == "spam")
    joined = left_join(s["contact_calls"].select("ticket_id", "ticket_group"), spam, ["ticket_id"], EVENTS.skew, hot_in=spam)
    return joined.groupBy("ticket_group", "tag_name").agg(F.count(F.lit(1)).alias("n"))


@check(
    with_views(
        ["contact_calls"],
        f"""SELECT c.ticket_group, CASE WHEN c.brand_id IN {sql.BRANDS} THEN {sql.COMB} ELSE '{fv.OTHER_PROGRAM_IN_CASES}' END AS program_name,
        count(*) FILTER (WHERE {sql.OFFERED}) AS n_offered, count(*) FILTER (WHERE {sql.AGENT_CALL})) AS n_reaching,
        count(*) AS n FROM v_contact_calls c GROUP BY 1, 2""",
    )
)
def agent_call_counts(s):
    return (
        s["contact_calls"]
        .groupBy("ticket_group", program_of(F.col("brand_id"), EVENTS.program).alias("program_name"))
        .agg(
            F.count_if(inbound_agent_call()).alias("n_offered"),
            F.count_if(inbound_agent_call(exclude_ivr_abandoned=False)).alias("n_reaching"),
            F.count(F.lit(1)).alias("n"),
        )
    )


@check(sql.kpi_sql().replace(sql._KPI_ROWS, "FROM v_contact_calls c WHERE TRUE"))
def call_funnel_all(s):
    return call_funnel(s["contact_calls"])


@check(
    with_views(
        ["contact_calls"],
        f"""SELECT '{fv.CALL_RESPONSE_IN_TIME}' AS statistic,
        count(DISTINCT c.call_id) FILTER (WHERE c.call_wait_time_seconds <= 120)
        / CAST(count(DISTINCT c.call_id) AS DOUBLE) AS num FROM v_contact_calls c WHERE {sql.OFFERED}
        UNION ALL {sql._MANUAL}""",
    )
)
def sla_all(s):
    return sla_ratio(s["contact_calls"])


_OURS = f"u.user_signature LIKE '{fv.SUPPORT_SIGNATURE_PATTERN}'"


@check(
    with_views(
        ["contact_calls", "users"],
        f"""SELECT c.submitter_role, CASE WHEN (NOT {_OURS} OR u.user_signature IS NULL)
                   AND c.submitter_role NOT IN ('agent', 'admin') THEN 'inbound' ELSE 'outbound' END AS direction,
                   count(*) AS n
            FROM v_contact_calls c LEFT JOIN v_users u ON u.user_id = c.submitter_user_id GROUP BY 1, 2""",
    )
)
def email_directions(s):
    contacts = s["contact_calls"].select(F.col("submitter_user_id").alias("user_id"), "submitter_role")
    joined = left_join(contacts, s["users"], ["user_id"], EVENTS.skew)
    direction = email_direction(F.col("user_signature"), F.col("submitter_role"))
    return joined.groupBy("submitter_role", direction.alias("direction")).agg(F.count(F.lit(1)).alias("n"))


@check(
    with_views(
        ["users"],
        f"""SELECT count(*) FILTER (WHERE NOT {_OURS}) AS n_other, count(*) FILTER (WHERE {_OURS}) AS n_ours,
        count(*) FILTER (WHERE u.user_signature ILIKE '{fv.SUPPORT_SIGNATURE_PATTERN}') AS n_any_case,
        count(*) FILTER (WHERE u.user_signature IS NULL) AS n_none,
        count(*) FILTER (WHERE u.user_signature <> 'Regards') AS n_differs,
        count(*) FILTER (WHERE u.user_signature <> 'Regards' OR u.user_signature IS NULL) AS n_differs_or_none,
        count(*) FILTER (WHERE u.user_signature NOT IN ('Regards', 'Thanks')) AS n_not_in,
        count(*) FILTER (WHERE u.user_id = 'U1' OR u.user_signature = 'Regards' AND u.user_id > 'U5') AS n_ungrouped
        FROM v_users u""",
    )
)
def null_logic_counts(s):
    """Predicates over a nullable column: LIKE, inequality and NOT IN drop nulls unless told otherwise."""
    signature, user = F.col("user_signature"), F.col("user_id")
    return s["users"].agg(
        F.count_if(not_support_signature(signature)).alias("n_other"),
        F.count_if(signature.like(fv.SUPPORT_SIGNATURE_PATTERN)).alias("n_ours"),
        F.count_if(F.upper(signature).like(fv.SUPPORT_SIGNATURE_PATTERN.upper())).alias("n_any_case"),
        F.count_if(signature.isNull()).alias("n_none"),
        F.count_if(signature != "Regards").alias("n_differs"),
        F.count_if((signature != "Regards") | signature.isNull()).alias("n_differs_or_none"),
        F.count_if(~signature.isin("Regards", "Thanks")).alias("n_not_in"),
        F.count_if((user == "U1") | (signature == "Regards") & (user > "U5")).alias("n_ungrouped"),
    )


# Tickets


@check(
    with_views(
        ["tickets"],
        """SELECT CASE WHEN via_channel IN ('native_messaging', 'chat') THEN 'chat'
                       WHEN via_channel IN ('web', 'answer_bot_for_web_widget') THEN 'email'
                       ELSE via_channel END AS channel, count(*) AS n,
                  count(nullif(custom_imprint_uuid, '')) AS n_named
           FROM v_tickets GROUP BY 1""",
    )
)
def ticket_channels(s):
    named = blank_to_null(F.col("custom_imprint_uuid"))
    return (
        s["tickets"]
        .groupBy(channel_of(F.col("via_channel")).alias("channel"))
        .agg(F.count(F.lit(1)).alias("n"), F.count(named).alias("n_named"))
    )


@check(
    with_views(
        ["tickets"],
        """SELECT ticket_id, unnest(range(len(ids))) AS array_index, unnest(ids) AS merged_ticket_id
        FROM (SELECT ticket_id, from_json(merged_ticket_ids, '["VARCHAR"]') AS ids FROM v_tickets
              WHERE custom_imprint_uuid <> '' AND coalesce(custom_does_contact_have_account_with_imprint, '')
                    <> 'no_uuid_needed')""",
    )
)
def absorbed_tickets(s):
    return merged_pairs(s["tickets"]).withColumn("array_index", F.col("array_index").cast("bigint"))


@check(
    with_views(
        ["tickets", "ticket_field_history"],
        f""", {sql.SOLVED}, {sql.MERGED}, {sql.THROUGH}
        SELECT t.ticket_id, coalesce(s.day, m.day) AS solve_date FROM v_tickets t
        LEFT JOIN solved s ON s.ticket_id = t.ticket_id LEFT JOIN through m ON m.ticket_id = t.ticket_id""",
    )
)
def resolution_of_tickets(s):
    tickets = s["tickets"]
    return merged_resolution(tickets.select("ticket_id"), tickets, s["ticket_field_history"], EVENTS)


@check(
    with_views(
        ["ticket_field_history"],
        f"""SELECT {sql.LOCAL_DAY} AS day, h.field_value, count(*) AS n FROM v_ticket_field_history h
        WHERE h.field_name = 'status' GROUP BY 1, 2""",
    )
)
def local_days(s):
    history = s["ticket_field_history"].where(F.col("field_name") == "status")
    return history.groupBy(local_date(F.col("updated_at"), EVENTS).alias("day"), "field_value").agg(
        F.count(F.lit(1)).alias("n")
    )


# Portfolio and fraud


@check(
    with_views(
        ["loan_tape"],
        f"""SELECT {sql.BUCKET_SQL} AS bucket, count(DISTINCT credit_line_uuid) AS n_accounts, count(*) AS n,
        CAST(sum(total_balance) AS DOUBLE) AS amount FROM v_loan_tape GROUP BY 1""",
    )
)
def ageing_buckets(s):
    return (
        s["loan_tape"]
        .groupBy(dpd_bucket(F.col("days_past_due")).alias("bucket"))
        .agg(
            F.count_distinct("credit_line_uuid").alias("n_accounts"),
            F.count(F.lit(1)).alias("n"),
            F.sum("total_balance").alias("amount"),
        )
    )


@check(
    with_views(
        ["card_status_history", "transactions"],
        f""", {sql.REISSUE} SELECT card_uuid, product_account_uuid, card_status, card_type, cancel_reason,
        last_ingest_at_est, txn_created_at_est, transaction_uuid, date_diff FROM reissue""",
    )
)
def cancelled_after_txn(s):
    pairs = cancel_near_txn(s["card_status_history"], s["transactions"])
    return pairs.withColumn("date_diff", F.col("date_diff").cast("bigint"))


@check(
    with_views(
        ["card_status_history", "transactions"],
        f""", {sql.REISSUE} SELECT transaction_uuid, count(*) AS n_all,
        count(*) FILTER (WHERE cancel_reason IN ('STOLEN', 'FRAUD', 'LOST')) AS n_fraud FROM reissue GROUP BY 1""",
    )
)
def cancellations_per_txn(s):
    return cancel_tally(s["card_status_history"], s["transactions"], ORDERS.skew)


@check(
    with_views(
        ["transactions", "disputes_log"],
        f", {sql.CHAIN} SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM chain",
    )
)
def disputes_with_log(s, policy=ORDERS.skew):
    return dispute_chain(s["transactions"], s["disputes_log"], policy)


@check(
    """SELECT l_returnflag, l_linestatus, count(*) AS n, count(c_custkey) AS n_matched,
    CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM lineitem LEFT JOIN customer ON c_custkey = l_orderkey OR c_custkey = l_partkey OR c_custkey = l_suppkey
    GROUP BY 1, 2"""
)
def any_of_three_keys(s, policy=ORDERS.skew):
    lines = s.table("lineitem").select("l_returnflag", "l_linestatus", "l_orderkey", "l_partkey", "l_suppkey")
    customers = s.table("customer").select("c_custkey", F.col("c_acctbal").cast("decimal(18,2)").alias("balance"))
    joined = any_key_join(lines, ["l_orderkey", "l_partkey", "l_suppkey"], customers, "c_custkey", policy)
    return joined.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.count("c_custkey").alias("n_matched"), F.sum("balance").alias("balance")
    )


@check(
    with_views(
        ["sms_executions", "sms_execution_log", "sms_execution_steps"],
        f", {sql.SMS} SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM sms",
    )
)
def sms_outcomes(s):
    outcome = sms_outcome(s["sms_executions"], s["sms_execution_log"], s["sms_execution_steps"], EVENTS)
    return outcome.withColumn("priority", F.col("priority").cast("int"))


_SIGNALS = ("auth_signal", "dispute_signal", "card_signal", "status_signal", "sms_signal")


@check(
    with_views(
        sql.FRAUD_VIEWS,
        f""", {sql.CHAIN}, {sql.REISSUE}, {sql.SMS}, {sql.signals_sql("TRUE")}
        SELECT transaction_uuid, product_account_uuid, {", ".join(f"bool_or({x}) AS {x}" for x in _SIGNALS)},
               count(*) FILTER (WHERE {sql.ANY_SIGNAL}) AS n_fraud_rows
        FROM signals GROUP BY row_no, transaction_uuid, product_account_uuid""",
    )
)
def signals_of_txns(s):
    """Fraud signals of every programme transaction, with the number of joined rows that show one."""
    txns = s["transactions"]
    candidates = txns.where(
        (F.col("merchant_combname") == ORDERS.program.comb_name)
        & F.col("transaction_status").isin(*fv.FRAUD_LINE_STATUSES)
    ).select(
        "transaction_uuid",
        "source_transaction_id",
        "product_account_uuid",
        "purchase_auth_rejection_reason",
        "amount",
    )
    flagged = fraud_signals(
        candidates,
        s["status_events"],
        dispute_tally(txns, s["disputes_log"], ORDERS.skew),
        cancel_tally(s["card_status_history"], txns, ORDERS.skew),
        sms_outcome(s["sms_executions"], s["sms_execution_log"], s["sms_execution_steps"], ORDERS),
        ORDERS.skew,
    )
    rows = F.col("n_fraud_rows").cast("long").alias("n_fraud_rows")
    return flagged.select("transaction_uuid", "product_account_uuid", *_SIGNALS, rows)


@check(
    with_views(
        ["transactions", "apr_history"],
        f""", {sql.RATED} SELECT transaction_uuid, credit_line_uuid, transaction_confirmed_at_est,
        CAST(final_apr AS DOUBLE) AS final_apr, effective_end_at_est FROM rated""",
    )
)
def rates_of_txns(s, policy=ORDERS.skew):
    txns = s["transactions"].select("transaction_uuid", "credit_line_uuid", "transaction_confirmed_at_est")
    return rate_in_force(txns, s["apr_history"], policy)


# Joins, sets, sorting, arithmetic


@check(
    with_views(
        ["subscription_event", "email_event"],
        f"""SELECT coalesce(s.external_user_id, u.external_user_id) AS consumer_uuid, s.channel, s.time_at_est
        FROM v_subscription_event s FULL OUTER JOIN (SELECT DISTINCT external_user_id FROM v_email_event
             WHERE upper(event_type) = '{fv.EVENT_EMAIL_UNSUBSCRIBE}') u ON u.external_user_id = s.external_user_id""",
    )
)
def full_outer_opt_outs(s):
    unsubscribed = (
        s["email_event"]
        .where(F.upper("event_type") == fv.EVENT_EMAIL_UNSUBSCRIBE)
        .select(F.col("external_user_id").alias("consumer_uuid"))
        .distinct()
    )
    events = s["subscription_event"].select(F.col("external_user_id").alias("consumer_uuid"), "channel", "time_at_est")
    return full_outer_join(events, unsubscribed, ["consumer_uuid"], EVENTS.skew).select(
        "consumer_uuid", "channel", "time_at_est"
    )


@check(
    """SELECT o_custkey AS k, o_orderstatus AS label FROM orders UNION SELECT c_custkey, c_mktsegment FROM customer
    UNION SELECT o_custkey, o_orderstatus FROM orders"""
)
def union_of_distinct(s):
    """Positional union, repeats within and across branches removed."""
    orders = s.table("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("label"))
    customers = s.table("customer").select("c_custkey", "c_mktsegment")
    return orders.union(customers).union(orders).distinct()


@check(
    """SELECT 'orders' AS statistic, CAST(count(*) AS DOUBLE) AS num FROM orders
    UNION ALL SELECT 'mean price', round(avg(o_totalprice), 4) FROM orders
    UNION ALL SELECT 'open share', count(*) FILTER (WHERE o_orderstatus = 'O') / CAST(count(*) AS DOUBLE) FROM orders
    UNION ALL SELECT 'by hand', NULL UNION ALL SELECT 'by hand', 0.99918"""
)
def union_of_mixed_types(s):
    """Counts, means, ratios, nulls and constants in one column of doubles."""
    orders = s.table("orders")
    figures = orders.agg(
        F.count(F.lit(1)).cast("double").alias("orders"),
        F.round(F.avg("o_totalprice"), 4).alias("mean"),
        F.count_if(F.col("o_orderstatus") == "O").alias("n_open"),
    )
    measured = figures.select(
        F.inline(
            F.array(
                F.struct(F.lit("orders").alias("statistic"), F.col("orders").alias("num")),
                F.struct(F.lit("mean price").alias("statistic"), F.col("mean").alias("num")),
                F.struct(
                    F.lit("open share").alias("statistic"),
                    F.try_divide(F.col("n_open").cast("double"), F.col("orders")).alias("num"),
                ),
            )
        )
    )
    by_hand = orders.sparkSession.createDataFrame([("by hand", None), ("by hand", 0.99918)], measured.schema)
    return measured.unionByName(by_hand)


@check(
    """SELECT o_orderpriority, count(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'F') AS n_final,
    count(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'O') AS n_open,
    round(avg(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'P'), 6) AS mean_key,
    count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1"""
)
def conditional_distinct(s):
    """Several conditional distinct counts of one column share one pass over it."""
    return (
        s.table("orders")
        .groupBy("o_orderpriority")
        .agg(
            F.expr("count(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'F')").alias("n_final"),
            F.expr("count(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'O')").alias("n_open"),
            F.expr("round(avg(DISTINCT o_custkey) FILTER (WHERE o_orderstatus = 'P'), 6)").alias("mean_key"),
            F.count_distinct("o_custkey").alias("n"),
        )
    )


@check("SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders ORDER BY o_orderdate DESC, o_orderstatus, o_orderkey")
def sorted_rows(s):
    return (
        s.table("orders")
        .select("o_orderkey", "o_orderdate", "o_orderstatus")
        .orderBy(F.col("o_orderdate").desc_nulls_first(), F.col("o_orderstatus").asc_nulls_last(), "o_orderkey")
    )


@check(
    with_views(
        ["transactions"],
        """SELECT transaction_type, CAST(sum(0 - amount) AS DOUBLE) AS signed_amount,
        round(CAST(sum(amount) AS DOUBLE) / count(*), 2) AS mean_amount, max(purchase_merchant_name) AS last_merchant
        FROM v_transactions GROUP BY 1""",
    )
)
def signed_amounts(s):
    total = F.sum("amount")
    return (
        s["transactions"]
        .groupBy("transaction_type")
        .agg(
            F.sum(-F.col("amount")).alias("signed_amount"),
            F.round(total.cast("double") / F.count(F.lit(1)), 2).alias("mean_amount"),
            F.max("purchase_merchant_name").alias("last_merchant"),
        )
    )


_VOLUMES = {
    "id_theft": (ORDERS, sql.ID_THEFT),
    "applications": (ORDERS, sql.APPLICATIONS),
    "bankruptcy": (ORDERS, sql.BANKRUPTCY),
    "disputes": (EVENTS, sql.DISPUTES),
    "charge_off": (ORDERS, sql.CHARGE_OFF),
    "collections": (ORDERS, sql.COLLECTIONS),
    "credit_refunds": (ORDERS, sql.CREDIT_REFUNDS),
    "fraud_cases": (EVENTS, sql.FRAUD_CASES),
    "opt_outs": (EVENTS, sql.OPT_OUTS),
    "scra": (ORDERS, sql.SCRA),
    "complaints_tier1": (EVENTS, sql.COMPLAINTS_TIER1),
}


@check(
    " UNION ALL ".join(
        f"SELECT '{name}' AS report, count(*) AS volume FROM ({text})" for name, (_, text) in _VOLUMES.items()
    )
)
def report_volumes(s):
    """Rows of each report that asks for its volume."""
    lines = None
    for name, (params, _) in _VOLUMES.items():
        volume = with_volume(plans.REPORTS[name](s, params)).select(F.lit(name).alias("report"), "volume")
        lines = volume if lines is None else lines.unionByName(volume)
    return lines
