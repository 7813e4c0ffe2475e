import datetime as dt

import pytest
from pyspark.sql import functions as F

from monthclose import fixed_values as fv
from monthclose.functions import dates, labels, text
from monthclose.params import Program, ReportParams

MARCH = dt.date(2024, 3, 15)
PARAMS = ReportParams(MARCH)


def values(df):
    return [r[0] for r in df.collect()]


@pytest.mark.parametrize(
    "as_of, low, high",
    [
        (dt.date(2024, 3, 31), dt.date(2024, 2, 1), dt.date(2024, 3, 1)),
        (dt.date(2024, 1, 1), dt.date(2023, 12, 1), dt.date(2024, 1, 1)),
        (dt.date(2023, 12, 31), dt.date(2023, 11, 1), dt.date(2023, 12, 1)),
    ],
)
def test_prior_month_bounds(as_of, low, high):
    assert dates.prior_month_bounds(as_of) == (low, high)


MONTH_EDGES = [
    ("before", "2024-01-31 23:59:59.999999"),
    ("first", "2024-02-01 00:00:00"),
    ("last", "2024-02-29 23:59:59.999999"),
    ("after", "2024-03-01 00:00:00"),
    ("year before", "2023-02-10 12:00:00"),
    ("null", None),
]


def test_prior_month_edges(table):
    df = table("id string, t timestamp_ntz", *MONTH_EDGES)
    assert values(dates.prior_month(df, "t", MARCH)) == ["first", "last"]
    assert values(dates.prior_month(df, "t", MARCH, "month_number")) == ["first", "last", "year before"]


def test_month_number_finds_nothing_in_january(table):
    df = table("id string, t timestamp_ntz", ("december", "2023-12-10 00:00:00"))
    assert values(dates.prior_month(df, "t", dt.date(2024, 1, 15))) == ["december"]
    assert values(dates.prior_month(df, "t", dt.date(2024, 1, 15), "month_number")) == []


def test_prior_month_of_first_filled_column(table):
    df = table(
        "id string, a timestamp_ntz, b timestamp_ntz",
        ("a in, b out", "2024-02-05 00:00:00", "2024-05-01 00:00:00"),
        ("a out, b in", "2024-05-01 00:00:00", "2024-02-05 00:00:00"),
        ("only b in", None, "2024-02-05 00:00:00"),
        ("only b out", None, "2024-05-01 00:00:00"),
        ("none", None, None),
    )
    assert values(dates.prior_month(df, ["a", "b"], MARCH)) == ["a in, b out", "only b in"]
    assert values(dates.prior_month(df, ["a", "b"], MARCH, "month_number")) == ["a in, b out", "only b in"]
    assert values(dates.since(df, ["a", "b"], dt.date(2024, 4, 1))) == ["a out, b in", "only b out"]


def test_date_columns_are_compared_as_dates(table):
    df = table("id string, d date", ("in", "2024-02-29"), ("out", "2024-03-01"))
    assert values(dates.prior_month(df, "d", MARCH)) == ["in"]
    assert values(dates.month_end_snapshot(df, "d", MARCH)) == ["in"]
    assert dates.since(df, "d", None) is df


def test_text_dates_are_refused(table):
    with pytest.raises(TypeError):
        dates.prior_month(table("d string", ("2024-02-01",)), "d", MARCH)


def test_unknown_month_rule():
    with pytest.raises(ValueError):
        ReportParams(MARCH, month_rule="fiscal")


def test_day_distance_counts_midnights(table):
    df = table(
        "a timestamp_ntz, b timestamp_ntz",
        ("2024-02-01 23:59:00", "2024-02-02 00:01:00"),
        ("2024-02-01 00:00:00", "2024-02-01 23:59:00"),
        ("2024-02-05 00:00:00", "2024-02-02 23:00:00"),
    )
    assert values(df.select(dates.day_distance(F.col("a"), F.col("b")))) == [1, 0, -3]


def test_local_time_across_the_autumn_change(table):
    df = table(
        "t timestamp_ntz",
        ("2024-02-10 03:00:00",),
        ("2024-11-03 05:30:00",),
        ("2024-11-03 06:30:00",),
    )
    assert values(df.select(dates.to_local(F.col("t"), PARAMS))) == [
        dt.datetime(2024, 2, 9, 22, 0),
        dt.datetime(2024, 11, 3, 1, 30),
        dt.datetime(2024, 11, 3, 1, 30),
    ]
    assert values(df.select(dates.local_date(F.col("t"), PARAMS)))[0] == dt.date(2024, 2, 9)


def test_calendar_parts(table):
    df = table("t timestamp_ntz", ("2024-02-11 10:00:00",))
    row = df.select(dates.year_month(F.col("t")), dates.week_start(F.to_date("t"))).first()
    assert tuple(row) == ("2024-02", dt.date(2024, 2, 5))


def test_delinquent_since(table):
    df = table("n int", (1,), (60,), (None,))
    assert values(df.select(dates.delinquent_since(F.col("n"), MARCH))) == [
        dt.date(2024, 2, 28),
        dt.date(2023, 12, 31),
        None,
    ]


def test_normalize_phone(table):
    df = table(
        "p string",
        ("+1 (212) 555-1234",),
        ("12125551234",),
        ("2125551234",),
        ("22125551234",),
        ("withheld",),
        (None,),
    )
    assert values(df.select(text.normalize_phone(F.col("p")))) == [
        "2125551234",
        "2125551234",
        "2125551234",
        "22125551234",
        "",
        None,
    ]


def test_to_bool(table):
    df = table("p string", ("TRUE",), ("False",), ("true",), ("maybe",), (None,))
    assert values(df.select(text.to_bool(F.col("p")))) == [True, False, True, None, None]


def test_blank_to_null(table):
    df = table("p string", ("",), ("x",), (None,))
    assert values(df.select(text.blank_to_null(F.col("p")))) == [None, "x", None]


def test_dpd_bucket(table):
    days = [None, 0, 1, 29, 30, 59, 60, 89, 90, 119, 120, 149, 150, 179, 180, 4000, -1]
    df = table("n int", *[(d,) for d in days])
    letters = [b[0] for b in values(df.select(labels.dpd_bucket(F.col("n"))))]
    assert "".join(letters) == "AABBCCDDEEFFGGHHe"


def test_program_and_channel(table):
    program = Program()
    df = table("b string, v string", (program.brand_ids[0], "chat"), ("1", "web"), (None, "api"))
    assert values(df.select(labels.program_of(F.col("b"), program))) == [
        program.comb_name,
        fv.OTHER_PROGRAM_IN_CASES,
        fv.OTHER_PROGRAM_IN_CASES,
    ]
    assert values(df.select(labels.channel_of(F.col("v")))) == ["chat", "email", "api"]


def test_email_direction(table):
    support = f"Your {fv.SUPPORT_SIGNATURE_PATTERN.strip('%')} team"
    df = table(
        "s string, r string",
        (None, "end-user"),
        ("Regards", "end-user"),
        (support, "end-user"),
        ("Regards", "agent"),
        ("Regards", None),
    )
    assert values(df.select(labels.email_direction(F.col("s"), F.col("r")))) == [
        "inbound",
        "inbound",
        "outbound",
        "outbound",
        "outbound",
    ]


GOOD_CALL = {
    "call_direction": "inbound",
    "custom_reason_code": None,
    "is_overflowed": False,
    "ivr_action": None,
    "is_call_outside_business_hours": False,
    "call_completion_status": None,
}


@pytest.mark.parametrize(
    "change, offered",
    [
        ({}, True),
        ({"call_direction": "outbound"}, False),
        ({"call_direction": None}, None),
        ({"custom_reason_code": fv.REASON_TESTING}, False),
        ({"custom_reason_code": "billing"}, True),
        ({"is_overflowed": True}, False),
        ({"is_overflowed": None}, None),
        ({"ivr_action": "group"}, True),
        ({"ivr_action": "voicemail"}, False),
        ({"is_call_outside_business_hours": True}, False),
        ({"call_completion_status": "abandoned_in_ivr"}, False),
        ({"call_completion_status": "completed"}, True),
    ],
)
def test_inbound_agent_call(table, change, offered):
    call = {**GOOD_CALL, **change}
    schema = ", ".join(f"{k} {'boolean' if k.startswith('is_') else 'string'}" for k in call)
    df = table(schema, tuple(call.values()))
    assert values(df.select(labels.inbound_agent_call())) == [offered]
    if "call_completion_status" in change:
        assert values(df.select(labels.inbound_agent_call(exclude_ivr_abandoned=False))) == [True]
