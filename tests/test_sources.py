"""Source registration, the reports over Parquet tables, and what reaches the scans."""

import datetime as dt
import os
import re
from dataclasses import replace

import pytest
from conftest import bag
from pyspark.sql import functions as F

from checks.catalog import EVENTS, ORDERS
from checks.driver_views import VIEWS, driver_sources
from monthclose import ReportParams, Sources, plans
from monthclose.operators import skew
from monthclose.operators.sketches import KeptSketch, sketch_parts, write_sketches
from monthclose.params import SkewPolicy
from monthclose.sources.registry import SchemaMismatch, bucket_keys, store_bucketed, write_report, written_volumes

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
needs_driver_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")
ON_EVENTS = {
    "sla",
    "disputes",
    "calls",
    "complaints_tier1",
    "complaints_tier2",
    "correspondence",
    "fraud_cases",
    "call_kpis",
    "opt_outs",
}


def test_missing_column_fails_at_registration(table):
    with pytest.raises(SchemaMismatch, match="user_signature"):
        Sources({"users": table("user_id string", ("u",))})


def test_unreadable_type_fails_at_registration(table):
    with pytest.raises(SchemaMismatch, match="updated_at_est"):
        Sources(
            {"hardpull": table("application_uuid string, mla_flag boolean, updated_at_est string", ("a", True, "x"))}
        )


def test_unknown_and_unregistered_tables(table):
    with pytest.raises(KeyError):
        Sources({"weather": table("t string", ("x",))})
    with pytest.raises(KeyError):
        Sources().get("users")


def test_names_types_and_extra_columns(table):
    df = table(
        "USER_ID bigint, User_Signature string, shoe_size int",
        (7, None, 43),
    )
    users = Sources({"users": df})["users"]
    assert users.dtypes == [("user_id", "string"), ("user_signature", "string")]
    assert [tuple(r) for r in users.collect()] == [("7", None)]


def test_text_booleans_and_json_arrays(table):
    values = ("t", "b", "web", "2024-02-01 00:00:00", "True", "c", '["m1","m2"]', None, "i", "s", "r", "tier_1")
    names = (
        "ticket_id brand_id via_channel ticket_created_at custom_complaint custom_imprint_uuid merged_ticket_ids "
        "custom_does_contact_have_account_with_imprint custom_issue_summary custom_complaint_summary "
        "custom_complaint_resolution custom_criticality"
    ).split()
    schema = ", ".join(f"{n} {'timestamp_ntz' if n == 'ticket_created_at' else 'string'}" for n in names)
    row = Sources({"tickets": table(schema, values)})["tickets"].first()
    assert row.custom_complaint is True and row.merged_ticket_ids == ["m1", "m2"]


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The report tables as Parquet, and the sources reading them."""
    folder = tmp_path_factory.mktemp("landed")
    driver = driver_sources(spark, SF_DIR)
    paths = {}
    for name in VIEWS:
        paths[name] = str(folder / name)
        driver[name].write.parquet(paths[name])
    return Sources.from_parquet(spark, paths)


@needs_driver_tables
@pytest.mark.parametrize("name", plans.REPORTS)
def test_reports_over_parquet_with_every_key_hot(spark, landed, name):
    """Landed tables give the rows the views give, and treating all repeated keys as hot changes nothing."""
    params = EVENTS if name in ON_EVENTS else ORDERS
    eager = replace(params, skew=SkewPolicy(share=0.001, salts=3))
    report = plans.REPORTS[name]
    assert bag(report(landed, eager)) == bag(report(driver_sources(spark, SF_DIR), params))


@needs_driver_tables
@pytest.mark.parametrize("name", plans.REPORTS)
def test_month_of_another_year(landed, name):
    """The calendar month is part of what the bare month number selects."""
    if name in ("sla", "call_kpis", "portfolio", "correspondence"):
        pytest.skip("figures, not events of the month")
    params = replace(EVENTS if name in ON_EVENTS else ORDERS, cutover=None)
    report = plans.REPORTS[name]
    calendar = report(landed, params)
    by_number = report(landed, replace(params, month_rule="month_number"))
    if name in ("id_theft", "bankruptcy", "charge_off", "scra", "collections", "mla", "transactions"):
        # One row per account or transaction, which may be another one if earlier years count too.
        key = calendar.columns[0]
        assert calendar.count() > 0
        assert calendar.select(key).exceptAll(by_number.select(key)).count() == 0
        return
    assert not bag(calendar) - bag(by_number)


SORT_KEYS = {
    "applications": ("application_submitted_at_est", "application_status", False),
    "calls": ("call_timestamp", None, True),
    "transactions": ("transaction_confirmed_at_est", None, True),
}


@needs_driver_tables
@pytest.mark.parametrize("name", SORT_KEYS)
def test_order_of_rows(landed, name):
    first, second, descending = SORT_KEYS[name]
    rows = plans.REPORTS[name](landed, EVENTS if name in ON_EVENTS else ORDERS).collect()
    keys = [(r[first], r[second]) if second else r[first] for r in rows]
    assert len(set(keys)) > 5 and keys == sorted(keys, reverse=descending)


def _scans(df):
    """Columns and pushed filters of every scan."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    return [re.search(r"parquet \[([^\]]*)\].*PushedFilters: \[(.*?)\], ReadSchema", line).groups() for line in scans]


PUSHED = [
    ("bankruptcy", "started_at_est", ("GreaterThanOrEqual(started_at_est", "LessThan(started_at_est", "EqualTo(status_reason")),
    ("applications", "application_submitted_at_est", ("LessThan(application_submitted_at_est", "EqualTo(merchant_combname")),
    ("mla", "updated_at_est", ("GreaterThanOrEqual(updated_at_est", "LessThan(updated_at_est", "EqualTo(mla_flag")),
    ("credit_refunds", "created_at_est", ("GreaterThanOrEqual(created_at_est", "EqualTo(transaction_type")),
    ("transactions", "transaction_confirmed_at_est", ("LessThan(transaction_confirmed_at_est", "EqualTo(transaction_status")),
    ("opt_outs", "time_at_est", ("GreaterThanOrEqual(time_at_est", "LessThan(time_at_est")),
    ("call_kpis", "call_created_at", ("In(brand_id", "LessThan(call_created_at", "LessThan(ticket_created_at")),
    ("sla", "call_created_at", ("In(brand_id", "GreaterThanOrEqual(call_created_at", "IsNotNull(custom_reason_code")),
    ("collections", "activity_date", ("EqualTo(activity_date", "GreaterThan(days_past_due")),
    ("portfolio", "total_balance", ("EqualTo(activity_date",)),
]


@needs_driver_tables
@pytest.mark.parametrize("name, column, filters", PUSHED, ids=[p[0] for p in PUSHED])
def test_month_and_literals_reach_the_scan(landed, name, column, filters):
    params = EVENTS if name in ON_EVENTS else ORDERS
    scans = [pushed for columns, pushed in _scans(plans.REPORTS[name](landed, params)) if column in columns]
    assert any(all(f in pushed for f in filters) for pushed in scans), scans


@needs_driver_tables
def test_scans_read_needed_columns_only(landed):
    ((columns, _),) = _scans(plans.REPORTS["credit_refunds"](landed, ORDERS))
    assert len(columns.split(",")) == 7


@needs_driver_tables
def test_first_event_is_limited_below_the_exchange(landed):
    plan = plans.REPORTS["bankruptcy"](landed, ORDERS)._jdf.queryExecution().executedPlan().toString()
    final, _, partial = plan.partition("Exchange hashpartitioning")
    assert "WindowGroupLimit" in final and "WindowGroupLimit" in partial


@needs_driver_tables
def test_call_figures_take_one_scan(landed):
    assert len(_scans(plans.REPORTS["call_kpis"](landed, EVENTS))) == 1
    assert len(_scans(plans.REPORTS["sla"](landed, EVENTS))) == 1


@needs_driver_tables
def test_write_report_replaces_its_month_only(spark, landed, tmp_path):
    path = str(tmp_path / "out")
    may, june = ORDERS, replace(ORDERS, as_of=dt.date(1998, 7, 15), cutover=None)
    report = plans.REPORTS["charge_off"]
    write_report(report(landed, may), path, may)
    write_report(report(landed, june), path, june)
    write_report(report(landed, may), path, may)
    stored = spark.read.parquet(path).groupBy("report_month").agg(F.count(F.lit(1))).collect()
    assert dict(map(tuple, stored)) == {
        dt.date(1998, 5, 1): report(landed, may).count(),
        dt.date(1998, 6, 1): report(landed, june).count(),
    }


def test_write_report_counts_rows_and_sizes_files(spark, table, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.range(1000).repartition(40).selectExpr("id", "sha2(cast(id AS string), 256) AS v")
    assert write_report(rows, path, ORDERS, rows_per_file=300) == 1000
    files = [f for f in os.listdir(f"{path}/report_month=1998-05-01") if f.endswith(".parquet")]
    assert 4 <= len(files) < 10
    later = replace(ORDERS, as_of=dt.date(1999, 1, 15))
    assert write_report(rows.where("id < 5"), path, later) == 5
    volumes = {(dt.date(1998, 5, 1), ORDERS.as_of, 1000), (dt.date(1998, 12, 1), later.as_of, 5)}
    assert set(map(tuple, written_volumes(spark, path).collect())) == volumes
    assert spark.read.parquet(path).count() == 1005
    # A month that has no rows any more loses those it had; the other stays.
    assert write_report(rows.where("id < 0"), path, ORDERS) == 0
    stored = spark.read.parquet(path).groupBy("report_month").count().collect()
    assert [tuple(r) for r in stored] == [(dt.date(1998, 12, 1), 5)]


def test_from_catalog(spark, table):
    table("user_id string, user_signature string", ("u", None)).createOrReplaceTempView("people")
    assert Sources.from_catalog(spark, {"users": "people"})["users"].count() == 1


def test_default_parameters():
    params = ReportParams(dt.date(2025, 12, 3))
    assert params.cutover == dt.date(2025, 10, 10) and params.month_rule == "calendar"


def _calls_by_month(spark, hot, months):
    key = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat(F.lit("k"), F.col("id")))
    key = F.when(F.col("id") % 50 == 1, F.lit(None)).otherwise(key)
    return spark.range(600).select(key.alias("call_id"), F.concat(F.lit("m"), F.col("id") % months).alias("month"))


def test_kept_sketches_are_merged_and_replaced_part_by_part(spark, tmp_path):
    policy = SkewPolicy(share=0.2)
    path = f"{tmp_path}/sketches"
    rows = _calls_by_month(spark, "hot", 4)
    write_sketches(sketch_parts(rows, ["call_id"], F.col("month")), path)
    kept = KeptSketch.read(spark, path)
    assert kept.parts.count() == 4
    assert skew.hot_keys(kept, ["call_id"], policy) == skew.hot_keys(rows, ["call_id"], policy) != []
    assert kept.top(1)[1] == rows.where("call_id IS NOT NULL").count()
    # One month is loaded anew: its sketch alone is made, the hot key of the others stays.
    again = spark.range(900).select(F.lit("new").alias("call_id"), F.lit("m1").alias("month"))
    write_sketches(sketch_parts(again, ["call_id"], F.col("month")), path)
    kept = KeptSketch.read(spark, path)
    whole = rows.where("month <> 'm1'").unionByName(again)
    assert kept.parts.count() == 4
    assert skew.hot_keys(kept, ["call_id"], SkewPolicy(share=0.1)) == skew.hot_keys(whole, ["call_id"], SkewPolicy(share=0.1))
    assert skew.hot_keys(KeptSketch(kept.parts.where("n < 0")), ["call_id"], policy) == []


def test_sketch_of_an_unknown_column_is_refused(table):
    sources = Sources()
    with pytest.raises(KeyError):
        sources.keep("accounts", ["shoe_size"], None)
    assert sources.kept("accounts", ["consumer_uuid"]) is None


@needs_driver_tables
@pytest.mark.parametrize("name", ["calls", "correspondence", "disputes", "fraud_cases"])
def test_reports_with_kept_sketches_read_no_table_while_they_are_built(spark, monkeypatch, name):
    """All hot keys come from kept sketches; rows are the same."""
    params = replace(EVENTS, skew=SkewPolicy(share=0.001, salts=3))
    plain = bag(plans.REPORTS[name](driver_sources(spark, SF_DIR), params))
    sources = driver_sources(spark, SF_DIR)
    tables = {
        "accounts": [["consumer_uuid"], ["consumer_uuid", "merchant_combname"]],
        "contact_calls": [["call_id"]],
        "ticket_comments": [["ticket_id"]],
        "profiles": [["phone"]],
    }
    for table, every in tables.items():
        for keys in every:
            sources.keep(table, keys, KeptSketch(sketch_parts(sources[table], keys)))
    asked, hot_keys = [], skew.hot_keys

    def watched(side, *args):
        assert isinstance(side, KeptSketch)
        asked.append(hot_keys(side, *args))
        return asked[-1]

    monkeypatch.setattr(skew, "hot_keys", watched)
    report = plans.REPORTS[name](sources, params)
    assert asked and any(asked)
    assert bag(report) == plain


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@needs_driver_tables
@pytest.mark.parametrize("name", ["bankruptcy", "charge_off", "id_theft", "scra"])
def test_bucketed_sources_are_joined_without_an_exchange(spark, tmp_path, no_broadcast, name):
    tables = driver_sources(spark, SF_DIR)
    key = ["product_account_uuid"]
    names = {}
    for table in ("accounts", "status_events"):
        store_bucketed(tables[table], f"bucketed_{table}", key, 4, f"{tmp_path}/{table}")
        names[table] = f"bucketed_{table}"
    try:
        sources = Sources.from_catalog(spark, names)
        params = sources.clustered(ORDERS)
        assert params.skew.clustered == {tuple(key)}
        report = plans.REPORTS[name](sources, params)
        assert _exchanges(report) == 0 < _exchanges(plans.REPORTS[name](tables, ORDERS))
        assert bag(report) == bag(plans.REPORTS[name](tables, ORDERS))
    finally:
        for table in names.values():
            spark.sql(f"DROP TABLE {table}")


def test_one_bucketed_table_keeps_the_salts(spark, table, tmp_path):
    users = table("user_id string, user_signature string", ("u", "s"))
    store_bucketed(users, "bucketed_users", ["user_id"], 2, f"{tmp_path}/users")
    try:
        assert bucket_keys(spark, "bucketed_users") == ("user_id",)
        assert Sources.from_catalog(spark, {"users": "bucketed_users"}).clustered(ORDERS) == ORDERS
    finally:
        spark.sql("DROP TABLE bucketed_users")


def test_clustered_joins_equal_the_salted_ones(table, no_broadcast):
    left = table("k string, v int", ("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 3), ("z", 4))
    right = table("k string, w int", ("a", 10), ("a", 11), (None, 12), ("b", 13), ("y", 14))
    plain, clustered = SkewPolicy(), SkewPolicy(clustered=frozenset({("k",)}))
    for join in (
        lambda p: skew.left_join(left, right, ["k"], p),
        lambda p: skew.full_outer_join(left, right, ["k"], p),
        lambda p: skew.filter_by_key(left, right, ["k"], p),
        lambda p: skew.filter_by_key(left, right, ["k"], p, anti=True),
    ):
        assert bag(join(clustered)) == bag(join(plain))
