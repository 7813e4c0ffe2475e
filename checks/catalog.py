"""Registered queries: name, Spark builder, and the SQL that must give the same rows."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import report_sql as sql
from checks.driver_views import driver_sources
from monthclose import plans
from monthclose.operators.sketches import KeptSketch, hashed, sketch_parts
from monthclose.params import ReportParams, SkewPolicy
from monthclose.session import shared_folder
from monthclose.sources.registry import Sources, write_report, written_volumes
from monthclose.sources.schemas import SCHEMAS

ORDERS = ReportParams(
    as_of=dt.date(1998, 6, 15), cutover=dt.date(1998, 5, 10), sms_since=dt.date(2024, 1, 5)
)
EVENTS = ReportParams(
    as_of=dt.date(2024, 2, 15), cutover=dt.date(2024, 1, 10), sms_since=dt.date(2024, 1, 5)
)
HOT = SkewPolicy(share=0.001, salts=3)


@dataclass(frozen=True)
class Check:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles: the two engines name their decimal types differently."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _report(name: str, params: ReportParams, **options):
    return lambda spark, sf_dir: plain(plans.REPORTS[name](driver_sources(spark, sf_dir), params, **options))


#: Tables and keys whose hot keys reports look for.
SKETCHED = {
    "accounts": [["consumer_uuid"], ["consumer_uuid", "merchant_combname"]],
    "contact_calls": [["call_id"]],
    "ticket_comments": [["ticket_id"]],
    "profiles": [["phone"]],
}


def _with_kept_sketches(name: str, params: ReportParams):
    """The report with hot keys merged from sketches, eight parts per table, as they would be kept."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = driver_sources(spark, sf_dir)
        sources = Sources({table: tables[table] for table in SCHEMAS})
        for table, every in SKETCHED.items():
            for keys in every:
                part = F.pmod(hashed(sources[table].columns), F.lit(8))
                sources.keep(table, keys, KeptSketch(sketch_parts(sources[table], keys, part)))
        return plain(plans.REPORTS[name](sources, params))

    return build


def _written(name: str, *months: ReportParams):
    """A report of several months written, the first of them twice, and read back with the volumes beside it."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"
        for params in (*months, months[0]):
            write_report(plans.REPORTS[name](driver_sources(spark, sf_dir), params), path, params)
        volumes = written_volumes(spark, path).select("report_month", "n_rows")
        return plain(spark.read.parquet(path).join(volumes, "report_month"))

    return build


def _written_sql(*months: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT *, DATE '{month}' AS report_month, count(*) OVER () AS n_rows FROM ({rows})" for month, rows in months
    )


REPORTS: dict[str, Check] = {
    "report_id_theft": Check(_report("id_theft", ORDERS), sql.ID_THEFT),
    "report_sla": Check(_report("sla", EVENTS), sql.SLA),
    "report_applications": Check(_report("applications", ORDERS), sql.APPLICATIONS),
    "report_bankruptcy": Check(_report("bankruptcy", ORDERS), sql.BANKRUPTCY),
    "report_bankruptcy_month_number": Check(
        _report("bankruptcy", replace(ORDERS, month_rule="month_number", cutover=None)), sql.BANKRUPTCY_MONTH_NUMBER
    ),
    "report_disputes": Check(_report("disputes", EVENTS), sql.DISPUTES),
    "report_disputes_deduped": Check(_report("disputes", EVENTS, dedupe=True), sql.DISPUTES_DEDUPED),
    "report_calls": Check(_report("calls", EVENTS), sql.CALLS),
    "report_charge_off": Check(_report("charge_off", ORDERS), sql.CHARGE_OFF),
    "report_collections": Check(_report("collections", ORDERS), sql.COLLECTIONS),
    "report_complaints_tier1": Check(_report("complaints_tier1", EVENTS), sql.COMPLAINTS_TIER1),
    "report_complaints_tier2": Check(_report("complaints_tier2", EVENTS), sql.COMPLAINTS_TIER2),
    "report_credit_refunds": Check(_report("credit_refunds", ORDERS), sql.CREDIT_REFUNDS),
    "report_portfolio": Check(_report("portfolio", ORDERS), sql.PORTFOLIO),
    "report_portfolio_single_rows": Check(
        _report("portfolio", ORDERS, one_row_per_txn=True, last_snapshot=True),
        sql.portfolio_sql(one_row_per_txn=True, last_snapshot=True),
    ),
    "report_correspondence": Check(_report("correspondence", EVENTS), sql.CORRESPONDENCE),
    "report_correspondence_grouped": Check(
        _report("correspondence", EVENTS, grouped=True), sql.correspondence_sql(grouped=True)
    ),
    "report_fraud_cases": Check(_report("fraud_cases", EVENTS), sql.FRAUD_CASES),
    "report_call_kpis": Check(_report("call_kpis", EVENTS), sql.CALL_KPIS),
    "report_call_kpis_true_mean": Check(_report("call_kpis", EVENTS, distinct_wait=False), sql.kpi_sql("")),
    "report_mla": Check(_report("mla", ORDERS), sql.MLA),
    "report_opt_outs": Check(_report("opt_outs", EVENTS), sql.OPT_OUTS),
    "report_scra": Check(_report("scra", ORDERS), sql.SCRA),
    "report_transactions": Check(_report("transactions", ORDERS), sql.TRANSACTIONS),
    "report_bankruptcy_written": Check(
        _written("bankruptcy", ORDERS, replace(ORDERS, as_of=dt.date(1998, 7, 15))),
        _written_sql(("1998-05-01", sql.BANKRUPTCY), ("1998-06-01", sql.BANKRUPTCY_JUNE)),
    ),
    # The same rows when keys of the driver tables count as hot: the salted plans run.
    "report_calls_hot_keys": Check(_report("calls", replace(EVENTS, skew=HOT)), sql.CALLS),
    "report_calls_kept_sketches": Check(_with_kept_sketches("calls", replace(EVENTS, skew=HOT)), sql.CALLS),
    "report_transactions_hot_keys": Check(_report("transactions", replace(ORDERS, skew=HOT)), sql.TRANSACTIONS),
}


def all_checks() -> dict[str, Check]:
    from checks.operator_checks import OPERATORS

    return {**REPORTS, **OPERATORS}
