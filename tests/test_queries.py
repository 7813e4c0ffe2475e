"""Every registered query against its SQL, and what the plans must and must not hold."""

import os
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as registered
from checks.catalog import all_checks
from checks.compare import compare, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = {name: query for name, query in registered.queries().items() if name in all_checks()}
SQL = {name: text for name, text in registered.oracle_sql().items() if name in QUERIES}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    return oracle(SF_DIR)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    rows, difference = compare(QUERIES[name](spark, SF_DIR), duck, SQL[name])
    assert difference == ""


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    spark.conf.set(keys[0], "10485760")
    spark.conf.unset(keys[1])


BANNED = re.compile(r"NestedLoopJoin|CartesianProduct|BatchEvalPython|ArrowEvalPython|InPandas|InArrow|CollectLimit")


def single_partition_below(plan: str, operators: tuple[str, ...]) -> list[str]:
    """Operators of the plan that read from an exchange into one partition, with at most a sort in between."""
    found, above = [], ""
    for line in plan.splitlines():
        node = line.lstrip(" :+-*()0123456789")
        if "Exchange SinglePartition" in line and above.startswith(operators):
            found.append(above)
        if not node.startswith(("Sort ", "InputAdapter", "WholeStageCodegen", "Project")):
            above = node
    return found


def test_a_global_window_is_found(spark):
    window = Window.orderBy("id")
    plan = spark.range(9).withColumn("n", F.row_number().over(window))._jdf.queryExecution().executedPlan().toString()
    assert single_partition_below(plan, ("Window",))


@pytest.mark.parametrize("name", QUERIES)
def test_plan_without_broadcast(spark, no_broadcast, name):
    """What the plan looks like when no side is small: equi joins only, nothing in Python, nothing collected."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not BANNED.findall(plan)
    for line in plan.splitlines():
        # The brands of the programme and the few hot keys are the sides broadcast regardless of Spark's size check.
        assert "BroadcastHashJoin" not in line or "brand_id" in line or "__hot" in plan
    # One partition only for the handful of rows of a global aggregate: a global window or sort would pass its
    # rows through it.
    assert not single_partition_below(plan, ("Window", "WindowGroupLimit", "SortMergeJoin"))


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["dpd_bucket", "n_accounts", "amount"]
    assert df.count() >= 3
