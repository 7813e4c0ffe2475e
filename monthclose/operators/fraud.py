"""Fraud signals of a transaction: cancelled cards, disputes, account status, SMS replies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthclose import fixed_values as fv
from monthclose.functions.dates import day_distance, day_literal
from monthclose.operators.dedup import first_event
from monthclose.operators.joins import any_key_join, near_day_join
from monthclose.operators.skew import any_null, left_join, spread
from monthclose.operators.tagged import united
from monthclose.params import ReportParams, SkewPolicy

N_ALL = "n_all"
N_FRAUD = "n_fraud"
_SPREAD = "__spread"


def canceled_cards(cards: DataFrame) -> DataFrame:
    return cards.where(F.col("card_status") == fv.CARD_CANCELED)


def cancel_near_txn(cards: DataFrame, txns: DataFrame, days: int = 3) -> DataFrame:
    """Cancelled cards with each of their transactions up to ``days`` calendar days before."""
    left = canceled_cards(cards).select(
        "card_uuid", "product_account_uuid", "card_status", "card_type", "cancel_reason", "last_ingest_at_est"
    )
    right = txns.select("card_uuid", F.col("created_at_est").alias("txn_created_at_est"), "transaction_uuid")
    pairs = near_day_join(left, right, "card_uuid", "last_ingest_at_est", "txn_created_at_est", days)
    return pairs.withColumn("date_diff", day_distance(F.col("last_ingest_at_est"), F.col("txn_created_at_est")))


def cancel_tally(cards: DataFrame, txns: DataFrame, policy: SkewPolicy, days: int = 3) -> DataFrame:
    """Per transaction_uuid: rows of :func:`cancel_near_txn`, and those cancelled for fraud, as counts.

    Cancellations are added up per card and day first. A day then goes to the blocks of days in which its transactions
    may lie, mostly one, instead of to each of its ``days + 1`` candidate days, and a transaction to the block of its
    own day. There it meets no more rows than a block has days, plus ``days``, however busy its card.
    """
    reason_is_fraud = F.coalesce(F.col("cancel_reason").isin(*fv.CANCEL_REASONS_FRAUD), F.lit(False))
    block_days = 2 * (days + 1)

    def block(day: Column) -> Column:
        return F.floor(F.unix_date(day) / block_days)

    per_day = (
        canceled_cards(cards)
        .where(F.col("card_uuid").isNotNull())
        .select("card_uuid", reason_is_fraud.cast("bigint").alias("fraud"), F.to_date("last_ingest_at_est").alias("observed"))
        .groupBy("card_uuid", "observed")
        .agg(F.count(F.lit(1)).alias(N_ALL), F.sum("fraud").alias(N_FRAUD))
    )
    blocks = F.sequence(block(F.date_sub("observed", days)), block(F.col("observed")))
    day = F.to_date("created_at_est")
    dated = txns.select("transaction_uuid", "card_uuid", day.alias("day"), block(day).alias("block"))
    # As the grouping is by another key, an exchange lies right below either side, and a busy block can be split.
    return (
        dated.join(per_day.withColumn("block", F.explode(blocks)), ["card_uuid", "block"])
        .where(F.col("observed").between(F.col("day"), F.date_add("day", days)))
        .groupBy("transaction_uuid")
        .agg(F.sum(N_ALL).alias(N_ALL), F.sum(N_FRAUD).alias(N_FRAUD))
    )


def disputes_to_auth(txns: DataFrame, policy: SkewPolicy) -> DataFrame:
    """Disputes with the posted transaction they are about and the authorisation that one came from."""
    disputes = txns.where(F.col("transaction_type") == fv.TYPE_DISPUTE).select(
        F.col("transaction_uuid").alias("dispute_transaction_uuid"),
        F.col("source_transaction_id").alias("posted_transaction_uuid"),
        "dispute_reason",
        "dispute_explanation",
        F.col("consumer_uuid").alias("dispute_consumer_uuid"),
        F.col("transaction_pending_at_est").alias("dispute_start"),
        F.col("updated_at_est").alias("dispute_updated"),
        F.col("transaction_status").alias("dispute_status"),
        "purchase_method",
        "purchase_category",
        "purchase_category_code",
        "merchant_name",
        "purchase_merchant_name",
        "amount",
        "auth_user_uuid",
    )
    posted = txns.select(
        F.col("transaction_uuid").alias("posted_transaction_uuid"),
        F.col("original_id").alias("transaction_original"),
        F.col("transaction_confirmed_at_est").alias("transaction_date"),
    )
    auth = txns.select(
        F.col("source_transaction_id").alias("transaction_original"),
        F.col("transaction_uuid").alias("auth_transaction_uuid"),
    )
    with_posted = left_join(disputes, posted, ["posted_transaction_uuid"], policy)
    return left_join(with_posted, auth, ["transaction_original"], policy, hot_in=auth)


_DISPUTE_KEYS = ("dispute_transaction_uuid", "posted_transaction_uuid", "auth_transaction_uuid")


def dispute_chain(txns: DataFrame, log: DataFrame, policy: SkewPolicy) -> DataFrame:
    """Disputes, posted transaction, authorisation, and the log entries for any of the three."""
    entries = log.select(
        F.col("transaction_uuid").alias("log_transaction_uuid"),
        "reason_for_dispute",
        "workflow_stage",
        "billing_error_status_resolution",
    )
    chained = disputes_to_auth(txns, policy)
    return any_key_join(chained, _DISPUTE_KEYS, entries, "log_transaction_uuid", policy)


def dispute_tally(
    txns: DataFrame, log: DataFrame, policy: SkewPolicy, auths: DataFrame | None = None
) -> DataFrame:
    """Per authorisation: rows of :func:`dispute_chain`, and those that are fraudulent, as counts.

    ``auths`` are the transaction rows to look at as authorisations, all if not given.

    The log is counted per transaction: all entries, those granted to the borrower, and of these the ones naming
    unauthorized use. With x the entries of a dispute and its posted transaction and e those of the authorisation, a
    chain row counts max(x + e, 1), which is x + e, and one more if both are 0. Over the n disputes of an original id
    that is sum(x) + n * e, plus the number of disputes without entries if e is 0. All of it is linear but for e, so
    sums per original id go to the authorisations that name it, and there meet the authorisation's own log entries
    in one grouping (:func:`united`). Where the authorisation is itself the posted or disputing transaction, its
    entries are in x already; what they would add again is taken off.

    An original id hands out its sums and, to each of its disputes and posted transactions that has entries, what is to
    be taken off, in one table keyed by (original id, whom it is for). An authorisation asks once, for the sums; what
    is to be taken off meets those that got an answer in a grouping by (authorisation, original id).
    """
    entry = _log_measures(log)
    entries = united([(log, entry)], ["id"])
    disputes = txns.where((F.col("transaction_type") == fv.TYPE_DISPUTE) & F.col("source_transaction_id").isNotNull()).select(
        F.col("source_transaction_id").alias("posted"),
        F.col("transaction_uuid").alias("dispute"),
        F.coalesce(F.col("dispute_reason") == fv.DISPUTE_FRAUDULENT, F.lit(False)).alias("fraudulent"),
    )
    own = entries.select(F.col("id").alias("dispute"), *[F.col(c).alias(f"{c}_dispute") for c in _LOG_MEASURES])
    theirs = entries.select(F.col("id").alias("posted"), *[F.col(c).alias(f"{c}_posted") for c in _LOG_MEASURES])
    posted = txns.select(F.col("transaction_uuid").alias("posted"), F.col("original_id").alias("original")).where(
        F.col("posted").isNotNull() & F.col("original").isNotNull()
    )
    # The second join is on the key of the first and needs no further exchange of these rows.
    rows = left_join(disputes, own, ["dispute"], policy).join(posted, "posted").join(theirs, "posted", "left")

    def of_both(part: str) -> Column:
        """Counts of the dispute and the posted transaction, once if they are the same."""
        again = F.when(F.col("posted").eqNullSafe(F.col("dispute")), 0).otherwise(F.coalesce(f"{part}_posted", F.lit(0)))
        return F.coalesce(f"{part}_dispute", F.lit(0)) + again

    def told(whom: Column, n: int, x: Column, silent: Column, signals: Column) -> Column:
        sums = {"n": F.lit(n), "n_f": F.col("fraudulent").cast("bigint") * n, "x": x, "n_silent": silent, "signals": signals}
        kind = F.lit(_FOR_ALL if n else _FOR_ITSELF).alias("kind")
        return F.struct(kind, whom.alias("whom"), *[value.cast("bigint").alias(name) for name, value in sums.items()])

    def signals_of(count) -> Column:
        return F.when(F.col("fraudulent"), count("granted")).otherwise(count("unauthorized"))

    def taken_off(part: str) -> Column:
        return told(F.col(part), 0, F.col(f"entries_{part}"), F.lit(0), signals_of(lambda c: F.col(f"{c}_{part}")))

    x, apart = of_both("entries"), ~F.col("posted").eqNullSafe(F.col("dispute"))
    messages = F.array(
        told(F.lit(""), 1, x, x == 0, signals_of(of_both)),
        F.when(F.col("entries_posted") > 0, taken_off("posted")),
        F.when((F.col("entries_dispute") > 0) & apart, taken_off("dispute")),
    )
    # A message that is null unfolds to a row without ``whom`` and goes.
    handed = rows.select("original", F.inline(messages))
    keys = ("original", "kind", "whom")
    sums = united([(handed, {c: F.col(c) for c in (*keys, *_CHAIN_MEASURES)})], keys)
    # Told apart by a sum, which no filter below the grouping can test: both then read the same shuffled rows.
    for_all = sums.where("n > 0").drop("kind", "whom")
    asking = (
        (txns if auths is None else auths)
        .select(F.col("source_transaction_id").alias("original"), F.col("transaction_uuid").alias("id"))
        .dropna()
    )
    # The sums are grouped by more than the original id, so an exchange lies right below either side of the join.
    answered = asking.join(for_all, "original")
    off = {"x": "x_off", "signals": "signals_off"}
    to_take = {"id": F.col("whom"), "original": F.col("original")} | {off.get(c, c): F.col(c) for c in _CHAIN_MEASURES}
    asked = {c: F.col(c) for c in ("id", "original", *_CHAIN_MEASURES)} | {"n_asked": F.lit(1).cast("bigint")}
    told_all = united([(answered, asked), (sums.where("n = 0"), to_take)], ["id", "original"]).where("n_asked IS NOT NULL")
    own_sums = {c: F.col(c) for c in ("id", *_CHAIN_MEASURES)} | {
        c: F.col(c) - F.col("n_asked") * F.coalesce(c_off, F.lit(0)) for c, c_off in off.items()
    }
    # Entries of ids that no dispute leads to come along and are dropped: they have no answer.
    met = united([(told_all, own_sums), (log, entry)], ["id"]).where("n IS NOT NULL")
    e, granted, unauthorized = (F.coalesce(c, F.lit(0)) for c in _LOG_MEASURES)
    return met.select(
        F.col("id").alias("transaction_uuid"),
        (F.col("x") + F.col("n") * e + F.when(e == 0, F.col("n_silent")).otherwise(0)).alias(N_ALL),
        (F.col("signals") + F.col("n_f") * granted + (F.col("n") - F.col("n_f")) * unauthorized).alias(N_FRAUD),
    )


_LOG_MEASURES = ("entries", "granted", "unauthorized")
_CHAIN_MEASURES = ("n", "n_f", "x", "n_silent", "signals")
_FOR_ALL, _FOR_ITSELF = 0, 1


def _log_measures(log: DataFrame) -> dict[str, Column]:
    """What an entry of the disputes log adds to its transaction's counts."""
    granted = (F.col("workflow_stage") == fv.STAGE_RESOLUTION) & (
        F.col("billing_error_status_resolution") == fv.RESOLVED_FOR_BORROWER
    )
    unauthorized = granted & F.upper("reason_for_dispute").like(fv.REASON_UNAUTHORIZED_PATTERN)
    count = {"entries": F.lit(True), "granted": granted, "unauthorized": unauthorized}
    return {"id": F.col("transaction_uuid")} | {c: F.coalesce(p, F.lit(False)).cast("bigint") for c, p in count.items()}


def sms_outcome(executions: DataFrame, log: DataFrame, steps: DataFrame, params: ReportParams) -> DataFrame:
    """One row per execution of the SMS flow: the deciding step, four reply flags and the log entry.

    The deciding step has the lowest priority number (an allow-list or confirmed-fraud reply), then the
    earliest time, then the smallest remaining values. Steps and log entries are each reduced to one row
    per execution before they are joined, so executions with many of both do not multiply, and an
    execution with very many steps is reduced before it meets an exchange.
    """
    created = F.col("created_at_est")
    flow = first_event(
        executions.where(
            (F.col("flow_id") == params.sms_flow_id)
            & (created >= day_literal(params.sms_since, executions.schema["created_at_est"].dataType))
        ),
        ["execution_id"],
        ["created_at_est"],
    ).withColumnRenamed("execution_status", "execution_status_sms")

    left_from = F.col("transitioned_from")
    decided = (*fv.SMS_STEPS_ALLOW, *fv.SMS_STEPS_CONFIRMED_FRAUD)
    step_rows = steps.select(
        "execution_id",
        F.when(left_from.isin(*decided), 0).otherwise(1).alias("priority"),
        F.col("created_at_est").alias("step_created_at_est"),
        "execution_step_name",
        "transitioned_from",
        "transitioned_to",
    )
    deciding = first_event(step_rows, ["execution_id"], ["priority", "step_created_at_est", "execution_step_name"])
    entry = first_event(
        log.select(
            F.col("event_id").alias("execution_id"),
            "consumer_uuid",
            "source_uuid",
            F.col("transactionamount").alias("amount"),
            F.col("cardname").alias("card_name"),
        ).where(F.col("execution_id").isNotNull()),
        ["execution_id"],
        ["source_uuid"],
    )
    joined = flow.join(deciding, "execution_id", "left").join(entry, "execution_id", "left")

    def left_at(*groups: tuple[str, ...]) -> Column:
        return left_from.isin(*[step for group in groups for step in group])

    replied = left_at(fv.SMS_STEPS_ALLOW, fv.SMS_STEPS_LOCK_BY_RULE, fv.SMS_STEPS_CONFIRMED_FRAUD)
    flags = {
        "is_not_fraud_sms": left_at(fv.SMS_STEPS_ALLOW),
        "is_fraud_sms": left_at(fv.SMS_STEPS_LOCK_BY_RULE, fv.SMS_STEPS_LOCK, fv.SMS_STEPS_CONFIRMED_FRAUD),
        "is_no_reply_sms": ~replied & (F.col("execution_status_sms") == fv.SMS_STATUS_ENDED),
        "has_unrecognized_sms": left_at(fv.SMS_STEPS_UNRECOGNIZED),
    }
    return joined.select(
        "execution_id",
        "created_at_est",
        "step_created_at_est",
        (F.col("step_created_at_est") + F.expr("INTERVAL 2 DAYS")).alias("allowlist_window"),
        "consumer_uuid",
        "source_uuid",
        "amount",
        "card_name",
        "execution_step_name",
        "transitioned_from",
        "transitioned_to",
        *[F.coalesce(flag, F.lit(False)).alias(name) for name, flag in flags.items()],
        "execution_status_sms",
        F.coalesce("priority", F.lit(1)).alias("priority"),
    )


def tally(df: DataFrame, key: str, is_fraud: Column, as_key: str) -> DataFrame:
    """Rows and fraud rows per key, added up map-side."""
    return (
        df.where(F.col(key).isNotNull())
        .select(F.col(key).alias(as_key), F.coalesce(is_fraud, F.lit(False)).cast("bigint").alias("fraud"))
        .groupBy(as_key)
        .agg(F.count(F.lit(1)).alias(N_ALL), F.sum("fraud").alias(N_FRAUD))
    )


def fraud_signals(
    txns: DataFrame,
    status_events: DataFrame,
    disputes: DataFrame,
    reissues: DataFrame,
    sms: DataFrame,
    policy: SkewPolicy,
) -> DataFrame:
    """``txns`` plus one boolean per fraud signal, ``is_fraud`` and ``n_fraud_rows``.

    ``disputes``, ``reissues``: the counts of :func:`dispute_tally` and :func:`cancel_tally`; ``sms``:
    the rows of :func:`sms_outcome`. A transaction joined row by row to its account states, disputes,
    card cancellations and SMS flows would multiply by the product of their numbers. ``n_fraud_rows`` is
    how many rows of that product show a signal, worked out from counts: with n rows and f fraud rows on
    each side it is prod(n) - prod(n - f), or prod(n) if the authorisation itself is a signal. A side
    without rows counts as one row without a signal.
    """
    latest = tally(
        status_events.where(F.col("is_latest")),
        "product_account_uuid",
        F.col("status_reason_code").isin(*fv.STATUS_CODES_FRAUD),
        "product_account_uuid",
    )
    replies = tally(sms, "source_uuid", F.col("is_fraud_sms"), "source_transaction_id")
    # Both sides of the transaction id meet in one grouping. Accounts may be hot, and most transactions have no source
    # transaction.
    def renamed(name: str, counts: DataFrame) -> DataFrame:
        return counts.withColumnsRenamed({N_ALL: f"{name}_rows", N_FRAUD: f"{name}_fraud"})

    def side(name: str, counts: DataFrame, key: str) -> tuple[DataFrame, dict[str, Column]]:
        return counts, {key: F.col(key), f"{name}_rows": F.col(N_ALL), f"{name}_fraud": F.col(N_FRAUD)}

    sides = ("dispute", "card", "status", "sms")
    of_txn = united([side("dispute", disputes, "transaction_uuid"), side("card", reissues, "transaction_uuid")], ["transaction_uuid"])
    # The transactions are shuffled once per key. What a later shuffle need not carry is used up before: the rejection
    # reason in its flag, all columns in the number that spreads rows with a null key, the source transaction first of
    # the keys.
    rejected = F.coalesce(
        ~F.col("purchase_auth_rejection_reason").isin(*fv.REJECTIONS_BY_FRAUD_RULES), F.lit(False)
    )
    keys = ("source_transaction_id", "product_account_uuid", "transaction_uuid")
    apart = F.when(any_null(keys), spread(txns.columns, policy.salts)).otherwise(0)
    joined = txns.withColumns({"auth_signal": rejected, _SPREAD: apart})
    for key, counts in zip(keys, (renamed("sms", replies), renamed("status", latest), of_txn)):
        joined = left_join(joined, counts, [key], policy, spread_by=[_SPREAD])

    def product(columns: list[Column]) -> Column:
        """Exact up to 38 digits; a larger one raises an error or, if ANSI mode is off, is null."""
        return reduce(lambda a, b: (a * b).cast("decimal(38,0)"), [c.cast("decimal(38,0)") for c in columns])

    rows = {n: F.coalesce(f"{n}_rows", F.lit(1)) for n in sides}
    fraud_rows = {n: F.coalesce(f"{n}_fraud", F.lit(0)) for n in sides}
    every_row = product(list(rows.values()))
    silent_rows = product([rows[n] - fraud_rows[n] for n in sides])
    return joined.select(
        *txns.columns,
        "auth_signal",
        *[(fraud_rows[n] > 0).alias(f"{n}_signal") for n in sides],
        F.when(F.col("auth_signal"), every_row).otherwise(every_row - silent_rows).cast("decimal(38,0)").alias("n_fraud_rows"),
    ).withColumn("is_fraud", F.col("n_fraud_rows") > 0)
