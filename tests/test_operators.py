import datetime as dt
import random
from collections import Counter

import pytest
from conftest import bag
from pyspark.sql import functions as F

from monthclose import fixed_values as fv
from monthclose.operators import calls, dedup, fraud, identity, joins, skew, tagged, tickets
from monthclose.params import ReportParams, SkewPolicy

# Everything with more than a tenth of the table counts as hot; no key has more than all rows.
EAGER = SkewPolicy(share=0.1, salts=3)
NEVER = SkewPolicy(share=1.0)
POLICIES = pytest.mark.parametrize("policy", [EAGER, NEVER], ids=["hot keys split", "no hot keys"])


# First and latest


def test_first_event_ties_nulls_and_single_rows(table):
    df = table(
        "k string, t timestamp_ntz, v int",
        ("a", "2024-01-02 00:00:00", 1),
        ("a", "2024-01-01 00:00:00", 9),
        ("a", "2024-01-01 00:00:00", 5),
        ("a", None, 0),
        ("b", None, 3),
        (None, "2024-01-01 00:00:00", 7),
        (None, "2024-01-03 00:00:00", 8),
    )
    first = dedup.first_event(df, ["k"], ["t"]).select("k", "v")
    assert bag(first) == Counter([("a", 5), ("b", 3), (None, 7)])
    latest = dedup.latest_event(df, ["k"], ["t"]).select("k", "v")
    assert bag(latest) == Counter([("a", 0), ("b", 3), (None, 8)])


def test_first_event_keeps_one_row_per_key(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") % 5).alias("t"), "id")
    kept = dedup.first_event(df, ["k"], ["t"])
    assert kept.count() == 7
    assert sorted(r.id for r in kept.collect()) == [0, 5, 10, 15, 20, 25, 30]


def test_with_volume(table):
    df = table("k string", ("a",), ("a",), ("b",))
    assert bag(dedup.with_volume(df)) == Counter([(3,)])
    assert bag(dedup.with_volume(df, ["k"])) == Counter([("a", 2), ("b", 1)])


# Left join under skew


def _skewed(table):
    left = table(
        "k string, g string, l int",
        *[("hot", "x", i) for i in range(8)],
        *[(None, "x", i) for i in range(6)],
        ("cold", "x", 1),
        ("cold", None, 2),
        ("alone", "x", 1),
    )
    right = table("k string, g string, r int", *[("hot", "x", i) for i in range(9)], ("cold", "x", 1), (None, "x", 1))
    return left, right


@POLICIES
def test_left_join_equals_plain_left_join(table, policy):
    left, right = _skewed(table)
    wanted = bag(left.join(right, ["k", "g"], "left"))
    assert bag(skew.left_join(left, right, ["k", "g"], policy)) == wanted
    assert bag(skew.left_join(left, right, ["k", "g"], policy, hot_in=right)) == wanted


def test_left_join_refuses_ambiguous_columns(table):
    left, right = _skewed(table)
    with pytest.raises(ValueError, match="column g"):
        skew.left_join(left, right, ["k"], NEVER)


def test_left_join_splits_a_hot_key(table):
    left, right = _skewed(table)
    hot = right.where("k = 'hot' AND g = 'x'").select(F.xxhash64("k", "g")).first()[0]
    assert skew.hot_keys(right, ["k", "g"], SkewPolicy(share=0.2)) == [hot]
    assert skew.hot_keys(right, ["k", "g"], NEVER) == []
    assert skew.hot_keys(right.limit(0), ["k", "g"], EAGER) == []


def test_share_follows_the_shuffle_partitions():
    assert SkewPolicy().share_of(50) == 1 / 200
    assert SkewPolicy(share=0.3).share_of(50) == 0.3


def test_plan_of_a_hot_key_holds_the_salt(table):
    left, right = _skewed(table)
    plan = skew.left_join(left, right, ["k", "g"], EAGER, hot_in=right)._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan and "__hot" in plan


def test_outdated_list_of_hot_keys_loses_no_left_row(table):
    """The key was hot in an earlier state of the right table and has left it since."""
    left = table("k string, l int", ("gone", 1), ("gone", 2), ("here", 3))
    earlier = table("k string, r int", *[("gone", i) for i in range(9)], ("here", 1))
    now = table("k string, r int", ("here", 1))
    joined = skew.left_join(left, now, ["k"], EAGER, hot_in=earlier)
    assert bag(joined) == Counter({("gone", 1, None): 1, ("gone", 2, None): 1, ("here", 3, 1): 1})


@POLICIES
def test_full_outer_join_equals_the_plain_one(table, policy):
    left, right = _skewed(table)
    assert bag(skew.full_outer_join(left, right, ["k", "g"], policy, hot_in=right)) == bag(
        left.join(right, ["k", "g"], "full_outer")
    )


def test_hot_left_key_missing_from_a_salt_leaves_no_trace(table):
    """More salts than right rows: some copies of the left row meet nothing and must vanish."""
    left = table("k string, l int", ("hot", 1), ("hot", 2))
    right = table("k string, r int", *[("hot", i) for i in range(3)])
    policy = SkewPolicy(share=0.1, salts=50)
    joined = skew.left_join(left, right, ["k"], policy, hot_in=right)
    assert bag(joined) == Counter({("hot", i, j): 1 for i in (1, 2) for j in range(3)})


def test_null_keys_are_spread_over_partitions(spark):
    """The salt must be part of the hash key on both sides, and null keys must not meet in one partition."""
    left = spark.range(4000).select(F.when(F.col("id") < 0, F.lit("x")).alias("k"), "id")
    right = spark.range(10).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("r"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.left_join(left, right, ["k"], NEVER)
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).select("count(1)").collect()]
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and all("__salt" in line for line in exchanges)
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_filter_by_key(table):
    left, right = _skewed(table)
    for anti, how in ((False, "left_semi"), (True, "left_anti")):
        wanted = bag(left.join(right, ["k", "g"], how))
        assert bag(skew.filter_by_key(left, right, ["k", "g"], EAGER, anti)) == wanted


def test_semi_and_anti_make_the_whole(table):
    left, right = _skewed(table)
    kept = skew.filter_by_key(left, right, ["k"], EAGER)
    dropped = skew.filter_by_key(left, right, ["k"], EAGER, anti=True)
    assert bag(kept) + bag(dropped) == bag(left)


SPLIT_EAGERLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def split_eagerly(spark):
    for key, value in SPLIT_EAGERLY.items():
        spark.conf.set(key, value)
    yield
    for key in SPLIT_EAGERLY:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


JOINS = {
    "left join": lambda left, right: skew.left_join(left, right, ["k"], NEVER),
    "semi join": lambda left, right: skew.filter_by_key(left, right, ["k"], NEVER),
    "anti join": lambda left, right: skew.filter_by_key(left, right, ["k"], NEVER, anti=True),
}


@pytest.mark.parametrize("join", JOINS)
def test_aqe_splits_a_hot_left_key_against_an_aggregate(spark, split_eagerly, join):
    """A third of the left rows has one key, and the right side is grouped by the key already."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    left = spark.range(60000).repartition(8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    right = spark.range(3000).select(key.alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = JOINS[join](left, right)
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


# Any of several keys


@POLICIES
def test_any_key_join_against_brute_force(table, policy):
    left_rows = [
        ("a", "b", "c", 1),
        ("a", "a", "a", 2),
        ("b", "x", None, 3),
        ("x", "y", "z", 4),
        (None, None, None, 5),
        ("a", "b", "c", 1),
    ]
    right_rows = [("a", 10), ("b", 20), ("b", 21), ("c", 30), (None, 99)]
    wanted = Counter()
    for row in left_rows:
        matches = [r for r in right_rows if r[0] is not None and r[0] in row[:3]]
        for key, value in matches or [(None, None)]:
            wanted[(*row, key, value)] += 1
    left = table("k1 string, k2 string, k3 string, n int", *left_rows)
    right = table("rk string, v int", *right_rows)
    joined = joins.any_key_join(left, ["k1", "k2", "k3"], right, "rk", policy)
    assert Counter(tuple(r) for r in joined.select("k1", "k2", "k3", "n", "rk", "v").collect()) == wanted


@POLICIES
def test_any_key_join_at_random(table, policy):
    rng = random.Random(11)
    letters = [*"abcdef", None]
    left_rows = [(rng.choice(letters), rng.choice(letters), rng.choice(letters), i % 30) for i in range(120)]
    right_rows = [(rng.choice([*"abcxyz", None]), i) for i in range(25)]
    wanted = Counter()
    for row in left_rows:
        matches = [r for r in right_rows if r[0] is not None and r[0] in row[:3]]
        for key, value in matches or [(None, None)]:
            wanted[(*row, key, value)] += 1
    left = table("k1 string, k2 string, k3 string, n int", *left_rows)
    joined = joins.any_key_join(left, ["k1", "k2", "k3"], table("rk string, v int", *right_rows), "rk", policy)
    assert Counter(tuple(r) for r in joined.select("k1", "k2", "k3", "n", "rk", "v").collect()) == wanted


def test_any_key_join_has_no_nested_loop(table):
    left = table("k1 string, k2 string", ("a", "b"))
    right = table("rk string", ("a",))
    plan = joins.any_key_join(left, ["k1", "k2"], right, "rk", NEVER)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


# Days apart


def test_near_day_join_edges(table):
    cards = table("c string, seen timestamp_ntz", ("k", "2024-01-10 00:01:00"), (None, "2024-01-10 00:00:00"))
    txns = table(
        "c string, made timestamp_ntz, id int",
        ("k", "2024-01-06 23:59:00", -4),
        ("k", "2024-01-07 00:00:00", -3),
        ("k", "2024-01-09 23:59:00", -1),
        ("k", "2024-01-10 23:59:00", 0),
        ("k", "2024-01-11 00:00:00", 1),
        (None, "2024-01-10 00:00:00", 99),
    )
    near = joins.near_day_join(cards, txns, "c", "seen", "made", 3)
    assert sorted(r.id for r in near.collect()) == [-3, -1, 0]


# Repeats


def test_repeat_rows(table):
    df = table("k string, n bigint", ("a", 1), ("b", 3), ("c", 4096), ("d", 4097), ("e", 10000))
    repeated = identity.repeat_rows(df, "n")
    assert repeated.columns == ["k"]
    assert dict(repeated.groupBy("k").count().collect()) == {"a": 1, "b": 3, "c": 4096, "d": 4097, "e": 10000}


# Interval in force

INTERVALS = [
    ("k", "2024-01-01 00:00:00", "2024-01-10 00:00:00", 1),
    ("k", "2024-01-05 00:00:00", "2024-01-08 00:00:00", 2),
    ("k", "2024-01-10 00:00:00", None, 3),
    ("k", "2024-01-12 00:00:00", "2024-01-20 00:00:00", 4),
    ("m", "2024-01-01 00:00:00", "2024-01-03 00:00:00", 5),
    ("m", "2024-01-01 00:00:00", "2024-01-03 00:00:00", 6),
    (None, "2024-01-01 00:00:00", None, 7),
    ("m", None, None, 8),
]
FACTS = [
    ("k", t, i)
    for i, t in enumerate(
        [
            "2023-12-31 23:59:59",
            "2024-01-01 00:00:00",
            "2024-01-06 12:00:00",
            "2024-01-09 23:59:59",
            "2024-01-10 00:00:00",
            "2024-01-15 00:00:00",
            None,
        ]
    )
]
FACTS += [("m", "2024-01-02 00:00:00", 20), ("m", "2024-01-03 00:00:00", 21), ("m", "2024-01-02 00:00:00", 20)]
FACTS += [(None, "2024-01-02 00:00:00", 30), ("z", "2024-01-02 00:00:00", 40)]


def _brute_force(facts, intervals):
    wanted = Counter()
    for key, at, fact in facts:
        covering = [
            (end or "9999", start, value)
            for k, start, end, value in intervals
            if key is not None and k == key and at is not None and start is not None and start <= at < (end or "9999")
        ]
        wanted[(fact, max(covering)[2] if covering else None)] += 1
    return wanted


def _in_force(table, facts, intervals, policy):
    return joins.interval_in_force(
        table("k string, at timestamp_ntz, fact int", *facts),
        table("k string, s timestamp_ntz, e timestamp_ntz, rate int", *intervals),
        key="k",
        at="at",
        start="s",
        end="e",
        values=["rate"],
        policy=policy,
    ).select("fact", "rate")


@POLICIES
def test_interval_in_force(table, policy):
    assert bag(_in_force(table, FACTS, INTERVALS, policy)) == _brute_force(FACTS, INTERVALS)


@POLICIES
def test_interval_in_force_of_a_hot_key(table, policy):
    """One key with overlapping intervals over many days: every hour needs what started before it."""
    start = dt.datetime(2024, 1, 1)
    facts = [("hot", str(start + dt.timedelta(minutes=37 * i)), i) for i in range(300)]
    intervals = [
        (
            "hot",
            str(start + dt.timedelta(hours=7 * i)),
            None if i == 17 else str(start + dt.timedelta(hours=7 * i + 5 + (i * 13) % 40)),
            i,
        )
        for i in range(25)
    ]
    assert bag(_in_force(table, facts, intervals, policy)) == _brute_force(facts, intervals)


@POLICIES
def test_interval_in_force_at_random(table, policy):
    """Many keys with random intervals and facts, on few distinct times so that ends and starts collide."""
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1)

    def moment():
        return str(start + dt.timedelta(hours=rng.randrange(60), minutes=30 * rng.randrange(2)))

    facts, intervals = [], []
    for key in range(40):
        facts += [(f"k{key}", moment(), 100 * key + i) for i in range(rng.randrange(12))]
        for i in range(rng.randrange(6)):
            begin, end = sorted([moment(), moment()])
            intervals.append((f"k{key}", begin, None if rng.random() < 0.2 else end, i))
    assert bag(_in_force(table, facts, intervals, policy)) == _brute_force(facts, intervals)


# Identity


@POLICIES
def test_contact_identity(table, policy):
    calls_df = table(
        "call_id string, ticket_id string",
        ("c1", "t1"),
        ("c2", "t2"),
        (None, "t3"),
        ("c4", "t4"),
        ("c1", "t1"),
    )
    comments = table(
        "ticket_id string, call_from_number string",
        ("t1", "+1 (212) 555-0001"),
        ("t1", "+1 (212) 555-0001"),
        ("t1", "2125550002"),
        ("t2", None),
        ("t3", "2125550003"),
        ("t4", "12125550009"),
    )
    profiles = table(
        "consumer_uuid string, phone string",
        ("p1", "2125550001"),
        ("p1", "2125550001"),
        ("p2", "2125550001"),
        ("p3", "2125550003"),
        ("p0", None),
    )
    found = identity.contact_identity(calls_df, comments, profiles, policy)
    got = Counter(tuple(r) for r in found.select("call_id", "ticket_id", "user_phone", "consumer_uuid").collect())
    assert got == Counter(
        {
            ("c1", "t1", "2125550001", "p1"): 2,
            ("c1", "t1", "2125550001", "p2"): 2,
            ("c1", "t1", "2125550002", None): 2,
            ("c2", "t2", None, None): 1,
            (None, "t3", "2125550003", "p3"): 1,
            ("c4", "t4", "2125550009", None): 1,
        }
    )
    counts = identity.identity_counts(calls_df, comments, profiles, policy)
    assert bag(counts) == Counter([("c1", 6), ("c2", 1), (None, 1), ("c4", 1)])


def test_exclude_merged(table):
    rows = table("ticket_id string, n int", ("t1", 1), ("t2", 2), (None, 3))
    tags = table("ticket_id string, tag_name string", ("t1", fv.TAG_MERGED), ("t1", fv.TAG_MERGED), ("t2", "spam"))
    assert bag(identity.exclude_merged(rows, tags, EAGER).select("n")) == Counter([(2,), (3,)])


def test_time_line_of_one_key_is_spread(spark, monkeypatch):
    """One line holds all rows, each at a time of its own: no task of the second pass sees more than a segment."""
    start = "timestamp_ntz'2020-01-01 00:00:00'"
    at = F.expr(f"{start} + make_dt_interval(0, 3 * cast(id AS int))")
    facts = spark.range(12000).select(F.lit("hot").alias("k"), at.alias("at"), F.col("id").alias("fact"))
    begin = F.expr(f"{start} + make_dt_interval(0, 30 * cast(id AS int))")
    ends = F.expr(f"{start} + make_dt_interval(0, 30 * cast(id AS int) + 45)")
    intervals = spark.range(1000).select(F.lit("hot").alias("k"), begin.alias("s"), ends.alias("e"), F.col("id").alias("rate"))
    # The first interval outlasts many segments in which nothing starts after it ends.
    intervals = intervals.where("rate % 100 < 20").unionByName(
        spark.sql("SELECT 'hot' AS k, timestamp_ntz'2019-06-01 00:00:00' AS s, timestamp_ntz'2023-01-01 00:00:00' AS e, -1L AS rate")
    )
    found = joins.interval_in_force(facts, intervals, "k", "at", "s", "e", ["rate"], NEVER)
    wanted = Counter()
    rows = intervals.collect()
    for f in facts.collect():
        covering = [(r.e, r.s, r.rate) for r in rows if r.s <= f["at"] < r.e]
        wanted[(f.fact, max(covering)[2] if covering else None)] += 1
    assert bag(found.select("fact", "rate")) == wanted
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("__segment" in line.split("], [")[1] for line in windows) == 1
    per_segment = facts.groupBy(F.date_trunc("month", "at")).count().agg(F.max("count")).first()[0]
    assert per_segment < 12000 / 40


def test_united_adds_up_tables_by_key(table):
    a = table("k string, x bigint", ("p", 1), ("p", 2), (None, 5), ("q", 3))
    b = table("id string, y bigint", ("p", 10), ("r", None), ("r", 7))
    rows = tagged.united([(a, {"k": F.col("k"), "x": F.col("x")}), (b, {"k": F.col("id"), "y": F.col("y") * 2})], ["k"])
    assert bag(rows) == Counter({("p", 3, 20): 1, ("q", 3, None): 1, ("r", None, 14): 1})
    most = tagged.united([(a, {"k": F.col("k"), "x": F.col("x")})], ["k"], F.max)
    assert bag(most) == Counter({("p", 2): 1, ("q", 3): 1})


def _hash_exchanges(spark, df) -> int:
    """Of the plan without broadcasts, before it runs."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_united_takes_one_exchange_however_many_tables(spark, table):
    parts = [(table("k string, x bigint", ("p", n)), {"k": F.col("k"), f"x{n}": F.col("x")}) for n in range(4)]
    assert _hash_exchanges(spark, tagged.united(parts, ["k"])) == 1


# Calls

_CALL_SCHEMA = (
    "call_id string, call_direction string, custom_reason_code string, is_overflowed boolean, ivr_action string, "
    "is_call_outside_business_hours boolean, call_completion_status string, "
    "has_customer_requested_voicemail boolean, call_wait_time_seconds bigint, call_talk_time_seconds bigint, "
    "call_hold_time_seconds bigint, call_wrap_up_time_seconds bigint"
)


def _call(call_id, direction="inbound", status="completed", wait=10, talk=60, hold=0, wrap=5, voicemail=False):
    return (call_id, direction, None, False, "group", False, status, voicemail, wait, talk, hold, wrap)


def _figures(df):
    return {r.statistic: r.num for r in df.collect()}


def test_call_funnel(table):
    df = table(
        _CALL_SCHEMA,
        _call("a", wait=10),
        _call("a", wait=10),
        _call("b", wait=30, talk=0),
        _call("c", status="not_answered", wait=10, talk=None),
        _call("d", status="abandoned_in_ivr", wait=500, hold=None),
        _call("e", direction="outbound", wait=900),
        _call("f", voicemail=True, wait=130, talk=30, wrap=1),
        _call(None, wait=50),
    )
    assert _figures(calls.call_funnel(df)) == {
        fv.CALLS_OFFERED: 4.0,
        fv.CALLS_HANDLED: 2.0,
        fv.CALLS_ABANDONED: 1.0,
        fv.CALLS_OUTBOUND: 1.0,
        fv.AVG_SPEED_OF_ANSWER: (10 + 30 + 130 + 50) / 4,
        fv.AVG_HANDLE_TIME: round((65 + 65 + 65 + 31) / 4, 2),
    }
    mean = _figures(calls.call_funnel(df, distinct_wait=False))[fv.AVG_SPEED_OF_ANSWER]
    assert mean == pytest.approx((10 + 10 + 30 + 10 + 130 + 50) / 6)


def test_flags_are_folded_without_expanding(table):
    df = table("id string, a boolean, b boolean, x bigint", ("p", True, None, 1), ("p", False, False, 2), ("q", None, True, 4), (None, True, True, 8))
    folded = calls.fold_flags(df, ["id"], ["a", "b"], F.sum("x").alias("x"))
    # Columns by name: a, b, id, x.
    assert bag(folded) == Counter({(True, False, "p", 3): 1, (False, True, "q", 4): 1, (False, False, None, 8): 1})
    for figures in (calls.call_funnel(table(_CALL_SCHEMA, _call("a"))), calls.sla_ratio(table(_CALL_SCHEMA, _call("a")))):
        assert "Expand" not in figures._jdf.queryExecution().executedPlan().toString()


def test_call_funnel_without_calls(table):
    figures = _figures(calls.call_funnel(table(_CALL_SCHEMA, _call("a")).where("call_id = 'z'")))
    counted = (fv.CALLS_OFFERED, fv.CALLS_HANDLED, fv.CALLS_ABANDONED, fv.CALLS_OUTBOUND)
    assert figures == {c: 0.0 for c in counted} | {fv.AVG_SPEED_OF_ANSWER: None, fv.AVG_HANDLE_TIME: None}


def test_sla_ratio(table):
    df = table(_CALL_SCHEMA, _call("a", wait=120), _call("b", wait=121), _call("c", wait=None), _call("d", wait=0))
    figures = [tuple(r) for r in calls.sla_ratio(df).collect()]
    assert figures == [(fv.CALL_RESPONSE_IN_TIME, 0.5), *fv.MANUAL_SERVICE_LEVELS]


def test_sla_ratio_without_calls(table):
    df = table(_CALL_SCHEMA, _call("a", direction="outbound"))
    assert calls.sla_ratio(df, manual=()).collect()[0].num is None


# Tickets


def test_merged_resolution(spark, table):
    params = ReportParams(dt.date(2024, 3, 15))
    schema = "ticket_id string, custom_imprint_uuid string, custom_does_contact_have_account_with_imprint string, ids string"
    all_tickets = (
        table(
            schema,
            ("own", "c", None, '["m1"]'),
            ("through", "c", "yes", '["m1","m2","m3"]'),
            ("empty", "c", None, "[]"),
            ("null", "c", None, None),
            ("blank", "", None, '["m1"]'),
            ("nobody", None, None, '["m1"]'),
            ("no account", "c", fv.NO_ACCOUNT_NEEDED, '["m1"]'),
            ("unsolved", "c", None, '["m3"]'),
        )
        .withColumn("merged_ticket_ids", F.from_json("ids", "array<string>"))
        .drop("ids")
    )
    history = table(
        "ticket_id string, field_name string, field_value string, updated_at timestamp_ntz",
        ("own", "status", "solved", "2024-02-01 03:00:00"),
        ("own", "status", "open", "2024-02-20 12:00:00"),
        ("m1", "status", "solved", "2024-02-10 12:00:00"),
        ("m1", "status", "solved", "2024-02-11 12:00:00"),
        ("m2", "status", "solved", "2024-02-05 12:00:00"),
        ("m3", "priority", "solved", "2024-02-25 12:00:00"),
    )
    solved = tickets.merged_resolution(all_tickets, all_tickets, history, params)
    assert {r.ticket_id: r.solve_date for r in solved.collect()} == {
        "own": dt.date(2024, 1, 31),
        "through": dt.date(2024, 2, 11),
        "empty": None,
        "null": None,
        "blank": None,
        "nobody": None,
        "no account": None,
        "unsolved": None,
    }
    pairs = tickets.merged_pairs(all_tickets).where("ticket_id = 'through'")
    assert [tuple(r) for r in pairs.orderBy("array_index").collect()] == [
        ("through", 0, "m1"),
        ("through", 1, "m2"),
        ("through", 2, "m3"),
    ]


def test_unknown_solve_time_counts_as_latest(table):
    history = table(
        "ticket_id string, field_name string, field_value string, updated_at timestamp_ntz",
        ("t", "status", "solved", "2024-02-10 12:00:00"),
        ("t", "status", "solved", None),
    )
    found = tickets.latest_solve_dates(history, ReportParams(dt.date(2024, 3, 15)))
    assert [tuple(r) for r in found.collect()] == [("t", None)]


# Fraud


def _sms(table, steps, log=(), status="ended"):
    params = ReportParams(dt.date(2025, 3, 15))
    executions = table(
        "execution_id string, flow_id string, execution_status string, created_at_est timestamp_ntz",
        ("x", fv.SMS_FLOW_ID, status, "2025-02-01 10:00:00"),
        ("early", fv.SMS_FLOW_ID, status, "2024-09-30 23:59:59"),
        ("other", "F2", status, "2025-02-01 10:00:00"),
    )
    step_rows = table(
        "execution_id string, execution_step_name string, transitioned_from string, transitioned_to string, "
        "created_at_est timestamp_ntz",
        *[("x", name, left_from, "end", at) for name, left_from, at in steps],
    )
    log_rows = table(
        "event_id string, consumer_uuid string, source_uuid string, cardname string, transactionamount int", *log
    )
    return fraud.sms_outcome(executions, log_rows, step_rows, params).collect()


FLAGS = ("is_not_fraud_sms", "is_fraud_sms", "is_no_reply_sms", "has_unrecognized_sms", "priority")


@pytest.mark.parametrize(
    "left_from, status, flags",
    [
        (fv.SMS_STEPS_ALLOW[0], "ended", (True, False, False, False, 0)),
        (fv.SMS_STEPS_CONFIRMED_FRAUD[1], "ended", (False, True, False, False, 0)),
        (fv.SMS_STEPS_LOCK_BY_RULE[0], "ended", (False, True, False, False, 1)),
        (fv.SMS_STEPS_LOCK[0], "ended", (False, True, True, False, 1)),
        (fv.SMS_STEPS_UNRECOGNIZED[0], "active", (False, False, False, True, 1)),
        ("Trigger", "ended", (False, False, True, False, 1)),
        (None, "ended", (False, False, False, False, 1)),
    ],
)
def test_sms_reply_flags(table, left_from, status, flags):
    rows = _sms(table, [("s", left_from, "2025-02-01 10:01:00")], status=status)
    assert [tuple(r[f] for f in FLAGS) for r in rows] == [flags]


def test_sms_deciding_step(table):
    rows = _sms(
        table,
        [
            ("s1", "Trigger", "2025-02-01 10:00:00"),
            ("s3", fv.SMS_STEPS_ALLOW[0], "2025-02-01 10:09:00"),
            ("s2", fv.SMS_STEPS_CONFIRMED_FRAUD[0], "2025-02-01 10:05:00"),
            ("s1", fv.SMS_STEPS_CONFIRMED_FRAUD[0], "2025-02-01 10:05:00"),
        ],
        log=[("x", "c", "t2", "card", 5), ("x", "c", "t1", "card", 5)],
    )
    assert [(r.execution_step_name, r.source_uuid, r.allowlist_window) for r in rows] == [
        ("s1", "t1", dt.datetime(2025, 2, 3, 10, 5))
    ]


def test_sms_without_steps_or_log(table):
    rows = _sms(table, [])
    assert [tuple(r[f] for f in FLAGS) for r in rows] == [(False, False, False, False, 1)]


def _signals(table, policy=NEVER, **changes):
    given = {
        "txns": [("t1", "s1", "a1", None, 100)],
        "status": [],
        "disputes": [],
        "cards": [],
        "sms": [],
        **changes,
    }
    sides = "transaction_uuid string, n_all bigint, n_fraud bigint"
    return fraud.fraud_signals(
        table(
            "transaction_uuid string, source_transaction_id string, product_account_uuid string, "
            "purchase_auth_rejection_reason string, amount int",
            *given["txns"],
        ),
        table("product_account_uuid string, status_reason_code string, is_latest boolean", *given["status"]),
        table(sides, *given["disputes"]),
        table(sides, *given["cards"]),
        table("source_uuid string, is_fraud_sms boolean", *given["sms"]),
        policy,
    )


@pytest.mark.parametrize(
    "changes, n_fraud_rows",
    [
        ({}, 0),
        ({"txns": [("t1", "s1", "a1", fv.REJECTIONS_BY_FRAUD_RULES[0], 1)]}, 0),
        ({"txns": [("t1", "s1", "a1", "insufficient_funds", 1)]}, 1),
        ({"status": [("a1", "ID_THEFT", True)]}, 1),
        ({"status": [("a1", "ID_THEFT", False)]}, 0),
        ({"status": [("a1", None, True), ("a1", "FIRST_PARTY_FRAUD", True)]}, 1),
        ({"disputes": [("t1", 2, 1)]}, 1),
        ({"cards": [("t1", 3, 3)]}, 3),
        ({"sms": [("s1", True)]}, 1),
        ({"sms": [("s1", False)]}, 0),
        ({"cards": [("t1", 2, 1)], "disputes": [("t1", 3, 1)]}, 4),
        ({"txns": [("t1", None, "a1", "insufficient_funds", 1)], "cards": [("t1", 2, 0)]}, 2),
    ],
)
def test_fraud_signals(table, changes, n_fraud_rows):
    rows = _signals(table, **changes).collect()
    assert [r.n_fraud_rows for r in rows] == [n_fraud_rows]
    assert [r.is_fraud for r in rows] == [n_fraud_rows > 0]


def test_fraud_rows_beyond_a_bigint(table):
    """Four sides of 100,000 rows each, and one without a signal less on every side."""
    n = 100_000
    accounts = [("a1", "ID_THEFT", True)]
    rows = _signals(table, disputes=[("t1", n, n - 1)], cards=[("t1", n, n - 1)], status=accounts)
    one = rows.select("n_fraud_rows").first()[0]
    assert int(one) == n * n  # an account with a signal alone makes every row one
    sides = "transaction_uuid string, n_all bigint, n_fraud bigint"
    txns = table("transaction_uuid string, source_transaction_id string, product_account_uuid string, purchase_auth_rejection_reason string, amount int", ("t1", "s1", "a1", None, 1))
    events = table("product_account_uuid string, status_reason_code string, is_latest boolean", ("a1", "x", True)).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("i")
    sms = table("source_uuid string, is_fraud_sms boolean", ("s1", False)).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("i")
    wide = fraud.fraud_signals(txns, events, table(sides, ("t1", n, 1)), table(sides, ("t1", n, 0)), sms, NEVER)
    assert int(wide.first().n_fraud_rows) == n**4 - (n - 1) * n**3 and n**4 > 2**63


def test_dispute_tally_at_random(spark):
    """Ids that are disputes, posted transactions and authorisations at once, repeated and null."""
    rng = random.Random(5)
    ids = ["a", "b", "c", "d", None]
    txns = [
        (rng.choice(ids), rng.choice(ids), rng.choice(ids), rng.choice([fv.TYPE_DISPUTE, "other"]), rng.choice([fv.DISPUTE_FRAUDULENT, "x", None]))
        for _ in range(60)
    ]
    log = [
        (rng.choice(ids), rng.choice(["Unauthorized use", "late"]), fv.STAGE_RESOLUTION, rng.choice([fv.RESOLVED_FOR_BORROWER, "no"]))
        for _ in range(7)
    ]
    names = "transaction_uuid source_transaction_id original_id transaction_type dispute_reason".split()
    df = spark.createDataFrame(txns, ", ".join(f"{n} string" for n in names)).withColumns({c: F.lit(None).cast("string") for c in _CHAIN_REST})
    entries = spark.createDataFrame(log, "transaction_uuid string, reason_for_dispute string, workflow_stage string, billing_error_status_resolution string")
    chain = fraud.dispute_chain(df, entries, NEVER).where("auth_transaction_uuid IS NOT NULL")
    granted = (F.col("workflow_stage") == fv.STAGE_RESOLUTION) & (F.col("billing_error_status_resolution") == fv.RESOLVED_FOR_BORROWER)
    said = (F.col("dispute_reason") == fv.DISPUTE_FRAUDULENT) | F.upper("reason_for_dispute").like(fv.REASON_UNAUTHORIZED_PATTERN)
    wanted = chain.groupBy(F.col("auth_transaction_uuid").alias("transaction_uuid")).agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if(said & granted).alias("n_fraud")
    )
    assert wanted.count() > 0
    assert bag(fraud.dispute_tally(df, entries, NEVER)) == bag(wanted)


def _shuffled_rows(spark, df) -> int:
    """Rows written to exchanges while ``df`` is collected without broadcasts; reused exchanges count once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = df.select("*")
        df.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    def written(node) -> int:
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return written(node.executedPlan())
        if name in ("ShuffleQueryStage", "ResultQueryStage"):
            return written(node.plan())
        if name == "ReusedExchange":
            return 0
        here = node.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
        return here + sum(written(node.children().apply(i)) for i in range(node.children().size()))

    return written(df._jdf.queryExecution().executedPlan())


def test_an_authorisation_is_shuffled_once_to_ask(spark):
    """Of n transactions with few disputes, n go to be looked up as posted and n to ask, and little else."""
    n = 2000
    text = F.col("id").cast("string")
    txn = spark.range(n).select(
        text.alias("transaction_uuid"),
        (F.col("id") + 1).cast("string").alias("source_transaction_id"),
        text.alias("original_id"),
        F.when(F.col("id") % 100 == 0, F.lit(fv.TYPE_DISPUTE)).otherwise("x").alias("transaction_type"),
        F.lit(fv.DISPUTE_FRAUDULENT).alias("dispute_reason"),
    )
    log = spark.range(0, n, 50).select(
        text.alias("transaction_uuid"),
        *[F.lit(v).alias(c) for c, v in (("reason_for_dispute", "x"), ("workflow_stage", fv.STAGE_RESOLUTION))],
        F.lit(fv.RESOLVED_FOR_BORROWER).alias("billing_error_status_resolution"),
    )
    tallied = fraud.dispute_tally(txn, log, NEVER)
    assert bag(tallied) == Counter({(1, 1, str(i)): 1 for i in range(0, n, 100)})
    assert 2 * n <= _shuffled_rows(spark, tallied) < 2.5 * n


def test_a_cancellation_is_not_shuffled_once_per_candidate_day(spark):
    start = F.lit("2024-01-01").cast("date")
    n = 1000
    cards = spark.range(n).select(
        F.col("id").cast("string").alias("card_uuid"),
        F.lit(fv.CARD_CANCELED).alias("card_status"),
        F.lit("LOST").alias("cancel_reason"),
        F.date_add(start, (F.col("id") % 400).cast("int")).cast("timestamp_ntz").alias("last_ingest_at_est"),
    )
    txns = cards.limit(5).select(
        F.col("card_uuid").alias("transaction_uuid"), "card_uuid", F.col("last_ingest_at_est").alias("created_at_est")
    )
    tallied = fraud.cancel_tally(cards, txns, NEVER)
    assert bag(tallied) == Counter({(1, 1, str(i)): 1 for i in range(5)})
    assert n <= _shuffled_rows(spark, tallied) < 3 * n


@pytest.mark.parametrize("days", [0, 1, 3, 10])
def test_cancel_tally_at_random(spark, days):
    """Repeated and null cards, ids, days and reasons, around the first day of all blocks."""
    rng = random.Random(days)
    some_day = lambda: rng.choice([None, *[dt.datetime(1969, 12, 20) + dt.timedelta(hours=rng.randrange(24 * 30)) for _ in range(9)]])
    card = lambda: rng.choice(["k", "l", "", None])
    cards = spark.createDataFrame(
        [(card(), "a", rng.choice([fv.CARD_CANCELED, "x", None]), "p", rng.choice(["LOST", "EXPIRED", None]), some_day()) for _ in range(80)],
        "card_uuid string, product_account_uuid string, card_status string, card_type string, cancel_reason string, last_ingest_at_est timestamp_ntz",
    )
    txns = spark.createDataFrame(
        [(rng.choice(["t", "u", "", None]), card(), some_day()) for _ in range(40)],
        "transaction_uuid string, card_uuid string, created_at_est timestamp_ntz",
    )
    wanted = fraud.cancel_near_txn(cards, txns, days).groupBy("transaction_uuid").agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if(F.col("cancel_reason") == "LOST").alias("n_fraud")
    )
    assert wanted.count() > 1
    assert bag(fraud.cancel_tally(cards, txns, NEVER, days)) == bag(wanted)


def test_transactions_shed_what_later_joins_do_not_need(table):
    """The text of the rejection reason is never shuffled, the source transaction once."""
    wanted = _signals(table).select("transaction_uuid", "product_account_uuid", "is_fraud")
    carried = []

    def visit(node):
        children = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join" and node.joinType().toString() == "LeftOuter":
            carried.append(children[0].output().mkString(" "))
        for child in children:
            visit(child)

    visit(wanted._jdf.queryExecution().optimizedPlan())
    assert len(carried) == 3
    assert not any("purchase_auth_rejection_reason" in columns for columns in carried)
    assert sum("source_transaction_id" in columns for columns in carried) == 1


_CHAIN_REST = (
    "dispute_explanation consumer_uuid transaction_pending_at_est updated_at_est transaction_status purchase_method "
    "purchase_category purchase_category_code merchant_name purchase_merchant_name amount auth_user_uuid "
    "transaction_confirmed_at_est"
).split()


@POLICIES
def test_dispute_tally_counts_the_chain(spark, table, policy):
    txn = spark.range(60).select(
        F.concat(F.lit("t"), F.col("id") % 17).alias("transaction_uuid"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), (F.col("id") * 3) % 17)).alias("source_transaction_id"),
        F.concat(F.lit("t"), (F.col("id") * 7) % 17).alias("original_id"),
        F.when(F.col("id") % 3 == 0, F.lit("DISPUTE")).otherwise(F.lit("PURCHASE")).alias("transaction_type"),
        F.when(F.col("id") % 2 == 0, F.lit("FRAUDULENT")).alias("dispute_reason"),
        *[
            F.lit(None).cast("string").alias(c)
            for c in (
                "dispute_explanation consumer_uuid transaction_pending_at_est updated_at_est transaction_status "
                "purchase_method purchase_category purchase_category_code merchant_name purchase_merchant_name "
                "amount auth_user_uuid transaction_confirmed_at_est"
            ).split()
        ],
    )
    log = spark.range(40).select(
        F.concat(F.lit("t"), F.col("id") % 11).alias("transaction_uuid"),
        F.when(F.col("id") % 3 == 0, F.lit("Unauthorized")).alias("reason_for_dispute"),
        F.when(F.col("id") % 4 > 0, F.lit("Resolution")).alias("workflow_stage"),
        F.when(F.col("id") % 5 > 0, F.lit("Borrower favor")).alias("billing_error_status_resolution"),
    )
    chain = fraud.dispute_chain(txn, log, policy).where(F.col("auth_transaction_uuid").isNotNull())
    said = (F.col("dispute_reason") == "FRAUDULENT") | F.upper("reason_for_dispute").like("%UNAUTHORIZED%")
    granted = (F.col("workflow_stage") == "Resolution") & (F.col("billing_error_status_resolution") == "Borrower favor")
    wanted = chain.groupBy(F.col("auth_transaction_uuid").alias("transaction_uuid")).agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if(said & granted).alias("n_fraud")
    )
    assert bag(fraud.dispute_tally(txn, log, policy)) == bag(wanted)
    assert wanted.where("n_fraud > 0").count() > 0


def test_cancel_tally_counts_the_pairs(spark):
    start = F.lit("2024-01-01").cast("date")
    cards = spark.range(200).select(
        F.concat(F.lit("k"), F.col("id") % 3).alias("card_uuid"),
        F.lit("a").alias("product_account_uuid"),
        F.when(F.col("id") % 4 > 0, F.lit(fv.CARD_CANCELED)).otherwise(F.lit("ACTIVE")).alias("card_status"),
        F.lit("PHYSICAL").alias("card_type"),
        F.when(F.col("id") % 2 == 0, F.lit("LOST")).alias("cancel_reason"),
        F.date_add(start, (F.col("id") % 29).cast("int")).cast("timestamp_ntz").alias("last_ingest_at_est"),
    )
    txns = spark.range(150).select(
        F.concat(F.lit("t"), F.col("id") % 40).alias("transaction_uuid"),
        F.concat(F.lit("k"), F.col("id") % 5).alias("card_uuid"),
        F.date_add(start, (F.col("id") % 31).cast("int")).cast("timestamp_ntz").alias("created_at_est"),
    )
    pairs = fraud.cancel_near_txn(cards, txns)
    wanted = pairs.groupBy("transaction_uuid").agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if(F.col("cancel_reason") == "LOST").alias("n_fraud")
    )
    assert bag(fraud.cancel_tally(cards, txns, EAGER)) == bag(wanted)
    assert pairs.where("date_diff > 0 OR date_diff < -3").count() == 0


def test_distinct_in_order_takes_one_exchange(spark):
    rows = [(n % 40 if n % 9 else None, "ab"[n % 2], n % 3) for n in range(500)]
    df = spark.createDataFrame(rows, "t int, name string, part int")
    order = [F.col("t").desc_nulls_first(), F.col("name").asc_nulls_last(), F.col("part").asc_nulls_last()]
    found = dedup.distinct_in_order(df, order)
    want = sorted(set(rows), key=lambda r: (r[0] is not None, -(r[0] or 0), r[1], r[2]))
    assert [tuple(r) for r in found.collect()] == want
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange ") == 1 and "Exchange rangepartitioning" in plan
    assert dedup.distinct_in_order(df.where("part > 5"), order).count() == 0
