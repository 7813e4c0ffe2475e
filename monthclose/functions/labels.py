"""Classifying expressions: ageing buckets, programmes, channels, directions and call predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from monthclose import fixed_values as fv
from monthclose.params import Program


def dpd_bucket(days_past_due: Column) -> Column:
    """Ageing bucket; null counts as current, a negative number as an error."""
    bucket = F.when(days_past_due.isNull() | (days_past_due == 0), fv.BUCKET_CURRENT)
    for label, first, last in fv.AGEING_BUCKETS:
        inside = days_past_due >= first if last is None else days_past_due.between(first, last)
        bucket = bucket.when(inside, label)
    return bucket.otherwise(fv.BUCKET_ERROR)


def program_of(brand_id: Column, program: Program, other: str = fv.OTHER_PROGRAM_IN_CASES) -> Column:
    return F.when(brand_id.isin(*program.brand_ids), program.comb_name).otherwise(other)


def channel_of(via_channel: Column) -> Column:
    return (
        F.when(via_channel.isin(*fv.CHANNELS_CHAT), "chat")
        .when(via_channel.isin(*fv.CHANNELS_EMAIL), "email")
        .otherwise(via_channel)
    )


def not_support_signature(signature: Column) -> Column:
    """No signature of our own support desk; null if there is no signature at all."""
    return ~signature.like(fv.SUPPORT_SIGNATURE_PATTERN)


def email_direction(signature: Column, role: Column) -> Column:
    from_customer = (not_support_signature(signature) | signature.isNull()) & ~role.isin(*fv.STAFF_ROLES)
    return F.when(from_customer, "inbound").otherwise("outbound")


def is_inbound(direction: Column | None = None) -> Column:
    return (F.col("call_direction") if direction is None else direction) == "inbound"


def inbound_agent_call(exclude_ivr_abandoned: bool = True) -> Column:
    """Inbound calls meant for an agent, within business hours, tests and overflow left out."""
    reason, ivr, completion = F.col("custom_reason_code"), F.col("ivr_action"), F.col("call_completion_status")
    conditions = [
        is_inbound(),
        reason.isNull() | (reason != fv.REASON_TESTING),
        ~F.col("is_overflowed"),
        ivr.isNull() | (ivr == fv.IVR_GROUP),
        ~F.col("is_call_outside_business_hours"),
    ]
    if exclude_ivr_abandoned:
        conditions.append(completion.isNull() | (completion != fv.ABANDONED_IN_IVR))
    predicate = conditions[0]
    for condition in conditions[1:]:
        predicate = predicate & condition
    return predicate


def handled_call() -> Column:
    return (
        inbound_agent_call(exclude_ivr_abandoned=False)
        & F.col("call_completion_status").isin(*fv.HANDLED_STATUSES)
        & ~F.col("has_customer_requested_voicemail")
    )


def abandoned_call() -> Column:
    return (
        inbound_agent_call(exclude_ivr_abandoned=False)
        & F.col("call_completion_status").isin(*fv.ABANDONED_STATUSES)
        & ~F.col("has_customer_requested_voicemail")
    )
