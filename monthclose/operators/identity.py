"""From contact to account: phone numbers, profiles, merged tickets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthclose import fixed_values as fv
from monthclose.functions.text import normalize_phone
from monthclose.operators.sketches import KeptSketch
from monthclose.operators.skew import filter_by_key, left_join
from monthclose.params import SkewPolicy

N_ROWS = "n_rows"


def _calls_of_tickets(calls: DataFrame) -> DataFrame:
    return calls.groupBy("call_id", "ticket_id").agg(F.count(F.lit(1)).alias("n_calls"))


def _numbers_of_tickets(comments: DataFrame) -> DataFrame:
    """Distinct numbers per ticket; two spellings of one number count twice."""
    return (
        comments.where(F.col("call_from_number").isNotNull())
        .select("ticket_id", "call_from_number")
        .distinct()
        .select("ticket_id", normalize_phone(F.col("call_from_number")).alias("user_phone"))
        .groupBy("ticket_id", "user_phone")
        .agg(F.count(F.lit(1)).alias("n_numbers"))
    )


def identity_rows(
    calls: DataFrame, comments: DataFrame, profiles: DataFrame, policy: SkewPolicy
) -> DataFrame:
    """Distinct (call_id, ticket_id, user_phone, consumer_uuid) with the number of rows of each.

    ``n_rows`` says how often the combination occurs if calls, the numbers on their ticket and the
    profiles with that number are joined row by row; repeats are counted instead of carried along.
    """
    profile_rows = profiles.select("consumer_uuid", F.col("phone").alias("user_phone"))
    owners = profile_rows.distinct()
    with_number = left_join(_calls_of_tickets(calls), _numbers_of_tickets(comments), ["ticket_id"], policy, hot_in=comments)
    with_owner = left_join(with_number, owners, ["user_phone"], policy, hot_in=profile_rows)
    return with_owner.groupBy("call_id", "ticket_id", "user_phone", "consumer_uuid").agg(
        F.sum(F.col("n_calls") * F.coalesce("n_numbers", F.lit(1))).alias(N_ROWS)
    )


def identity_consumers(
    calls: DataFrame,
    comments: DataFrame,
    profiles: DataFrame,
    policy: SkewPolicy,
    hot_tickets: KeptSketch | None = None,
    hot_phones: KeptSketch | None = None,
) -> DataFrame:
    """Distinct (call_id, consumer_uuid) with the number of identity rows of each.

    Consumers are added up per ticket before calls are met, so a ticket with many numbers of one consumer is one row.
    Hot tickets and phone numbers are looked for in the tables unless sketches of them are kept.
    """
    profile_rows = profiles.select("consumer_uuid", F.col("phone").alias("user_phone"))
    owned = left_join(
        _numbers_of_tickets(comments), profile_rows.distinct(), ["user_phone"], policy, hot_in=hot_phones or profile_rows
    )
    contacts = owned.groupBy("ticket_id", "consumer_uuid").agg(F.sum("n_numbers").alias("n_contacts"))
    met = left_join(_calls_of_tickets(calls), contacts, ["ticket_id"], policy, hot_in=hot_tickets or comments)
    return met.groupBy("call_id", "consumer_uuid").agg(
        F.sum(F.col("n_calls") * F.coalesce("n_contacts", F.lit(1))).alias(N_ROWS)
    )


def identity_counts(
    calls: DataFrame, comments: DataFrame, profiles: DataFrame, policy: SkewPolicy
) -> DataFrame:
    """Number of identity rows per call_id, without forming them.

    Owners are counted per number, then contacts per ticket, then identities per call: every join meets one
    row per key, however many consumers share a number.
    """
    owners = (
        profiles.select("consumer_uuid", F.col("phone").alias("user_phone"))
        .distinct()
        .groupBy("user_phone")
        .agg(F.count(F.lit(1)).alias("n_owners"))
    )
    contacts = (
        left_join(_numbers_of_tickets(comments), owners, ["user_phone"], policy)
        .groupBy("ticket_id")
        .agg(F.sum(F.col("n_numbers") * F.coalesce("n_owners", F.lit(1))).alias("n_contacts"))
    )
    return (
        left_join(_calls_of_tickets(calls), contacts, ["ticket_id"], policy)
        .groupBy("call_id")
        .agg(F.sum(F.col("n_calls") * F.coalesce("n_contacts", F.lit(1))).alias(N_ROWS))
    )


def repeat_rows(df: DataFrame, times: str, order: Sequence[Column] | None = None) -> DataFrame:
    """Each row ``times`` times over, in ``order`` if given; the count column is dropped.

    Two unfoldings, blocks and rows of a block, keep the arrays behind them short for any count. Between them the
    blocks are dealt out anew (by their values and number, or by the order's range partitioner), so the copies of
    one row are written by many tasks.
    """
    block, left_over = 4096, "__rows"
    count = F.col(times)
    blocks = df.withColumn(left_over, F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1, F.lit(block).cast("bigint"))))
    blocks = blocks.repartition(*df.columns, left_over) if order is None else blocks.orderBy(*order, left_over)
    in_block = F.least(count - F.col(left_over), F.lit(block).cast("bigint"))
    return blocks.withColumn(left_over, F.explode(F.array_repeat(F.lit(0), in_block.cast("int")))).drop(times, left_over)


def contact_identity(
    calls: DataFrame, comments: DataFrame, profiles: DataFrame, policy: SkewPolicy
) -> DataFrame:
    """call_id, ticket_id, phone and consumer of every call; fans out over numbers and profiles."""
    return repeat_rows(identity_rows(calls, comments, profiles, policy), N_ROWS)


def exclude_merged(tickets: DataFrame, tags: DataFrame, policy: SkewPolicy, prefilter: bool = False) -> DataFrame:
    """Rows whose ticket was not closed by merging it into another one; ``prefilter`` if they are few beside all tags."""
    merged = tags.where(F.col("tag_name") == fv.TAG_MERGED)
    return filter_by_key(tickets, merged, ["ticket_id"], policy, anti=True, prefilter=prefilter)
