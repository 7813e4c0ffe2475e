import datetime as dt
import random

import pytest
from conftest import bag
from pyspark.sql import functions as F

from monthclose.operators import skew, tickets
from monthclose.operators.prefilter import key_bits, maybe_in
from monthclose.params import ReportParams, SkewPolicy

POLICY = SkewPolicy(share=0.1, salts=3)


@pytest.mark.parametrize("bits", [1 << 15, 1 << 18, 1 << 25])
def test_no_wanted_row_is_lost(spark, bits):
    wanted = spark.range(0, 30000, 37).select(F.concat(F.lit("k"), "id").alias("k"))
    rows = spark.range(30000).select(F.concat(F.lit("k"), "id").alias("k"), "id", F.lit("own").alias("p"))
    kept = {r.id for r in maybe_in(rows, ["k"], key_bits([(wanted, ["k"])], bits), bits).select("id").collect()}
    asked = set(range(0, 30000, 37))
    assert asked <= kept
    # 811 keys in 32,768 bits let about 2.4 % of the others pass, in more bits hardly any.
    assert len(kept - asked) < (1500 if bits == 1 << 15 else 200)


def test_null_empty_and_repeated_keys(table):
    rows = table("a string, b int, n int", ("x", 1, 1), ("x", 1, 2), ("x", None, 3), (None, 1, 4), ("", 1, 5), ("y", 1, 6))
    asked = table("a string, b int", ("x", 1), ("x", 1), (None, 1), ("x", None), ("", 1))
    field = key_bits([(asked, ["a", "b"])])
    assert sorted(r.n for r in maybe_in(rows, ["a", "b"], field).collect()) == [1, 2, 5]
    assert maybe_in(rows, ["a", "b"], field).columns == rows.columns
    assert maybe_in(rows, ["a"], key_bits([(asked.where("false"), ["a"])])).count() == 0
    with pytest.raises(ValueError):
        key_bits([(asked, ["a"])], 1000)


@pytest.mark.parametrize("anti", [False, True])
def test_filter_by_key_with_and_without(spark, anti):
    rnd = random.Random(5)
    draw = [(rnd.choice(["a", "b", "c", "d", "e", None]), i) for i in range(200)]
    rows = spark.createDataFrame(draw, "k string, n int")
    keys = spark.createDataFrame([("a",), ("a",), ("c",), (None,), ("z",)], "k string")
    plain = skew.filter_by_key(rows, keys, ["k"], POLICY, anti)
    assert bag(skew.filter_by_key(rows, keys, ["k"], POLICY, anti, prefilter=True)) == bag(plain)
    assert plain.count() == sum((k in ("a", "c")) != anti for k, _ in draw)


def _tables(spark, folder):
    """2,000 tickets of which each absorbs the fifth next one; 50,000 entries, one in three of them 'solved'."""
    spark.range(2000).selectExpr(
        "concat('t', id) AS ticket_id", "id % 100 = 0 AS asked", "concat('c', id) AS custom_imprint_uuid",
        "cast(null AS string) AS custom_does_contact_have_account_with_imprint",
        "array(concat('t', id + 5)) AS merged_ticket_ids",
    ).write.parquet(f"{folder}/tickets")
    spark.range(50000).selectExpr(
        "concat('t', id % 2500) AS ticket_id", "'status' AS field_name", "if(id % 2500 % 3 = 0, 'solved', 'open') AS field_value",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id AS int)) AS updated_at",
    ).write.parquet(f"{folder}/history")
    return spark.read.parquet(f"{folder}/tickets"), spark.read.parquet(f"{folder}/history")


def _shuffled(plan):
    """Rows written to exchanges in the final plan; the field itself, whose size is fixed, is made beside it."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _shuffled(plan.executedPlan())
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        return _shuffled(plan.plan())
    own = 0
    if plan.getClass().getSimpleName() == "ShuffleExchangeExec":
        own = plan.metrics().get("shuffleRecordsWritten").get().value()
    children = plan.children()
    return own + sum(_shuffled(children.apply(i)) for i in range(children.size()))


def test_merged_resolution_thins_out_the_history_before_the_shuffle(spark, tmp_path):
    every, history = _tables(spark, tmp_path)
    params = ReportParams(dt.date(2024, 3, 15), skew=POLICY)
    few = every.where("asked")
    rows, shuffled = {}, {}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for prefilter in (False, True):
            found = tickets.merged_resolution(few, every, history, params, prefilter)
            rows[prefilter] = bag(found.select("ticket_id", "solve_date"))
            found.collect()
            shuffled[prefilter] = _shuffled(found._jdf.queryExecution().executedPlan())
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert ("getbit" in plan) == prefilter
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert rows[True] == rows[False]
    assert sum(rows[True].values()) == 20
    assert sum(n for (_, day), n in rows[True].items() if day is not None) > 5
    assert shuffled[True] < shuffled[False] / 5
