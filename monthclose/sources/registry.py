"""Named source tables, checked against their schema when they are registered."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthclose.functions.text import to_bool
from monthclose.operators.sketches import KeptSketch
from monthclose.params import ReportParams
from monthclose.sources.schemas import SCHEMAS


class SchemaMismatch(ValueError):
    """A source table lacks a column, or holds one that cannot be read as the declared type."""


def _conform_column(table: str, found: T.StructField, wanted: T.StructField) -> Column:
    """The column as declared. A column that already fits is passed through, which keeps it pushable."""
    column = F.col(f"`{found.name}`")
    have, want = found.dataType, wanted.dataType
    if have == want:
        return column.alias(wanted.name)
    have_text = isinstance(have, (T.StringType, T.VarcharType, T.CharType))
    have_time = isinstance(have, (T.DateType, T.TimestampType, T.TimestampNTZType))
    if isinstance(want, T.BooleanType) and (have_text or isinstance(have, T.IntegralType)):
        converted = to_bool(column)
    elif isinstance(want, T.ArrayType) and have_text:
        converted = F.from_json(column, want)
    elif isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        converted = column.cast(want)
    elif isinstance(want, T.StringType) and isinstance(have, (T.StringType, T.VarcharType, T.CharType, T.IntegralType)):
        converted = column.cast(want)
    elif isinstance(want, (T.DateType, T.TimestampNTZType)) and have_time:
        converted = column.cast(want)
    elif isinstance(want, T.NumericType) and isinstance(have, T.NumericType):
        converted = column.cast(want)
    else:
        raise SchemaMismatch(
            f"{table}.{found.name} is {have.simpleString()} and cannot be read as {want.simpleString()}"
        )
    return converted.alias(wanted.name)


def conform(table: str, df: DataFrame) -> DataFrame:
    """``df`` with exactly the declared columns of ``table``; names match regardless of case."""
    found = {f.name.lower(): f for f in df.schema.fields}
    wanted = SCHEMAS[table]
    missing = [f.name for f in wanted.fields if f.name.lower() not in found]
    if missing:
        raise SchemaMismatch(f"table {table!r} lacks {', '.join(missing)}")
    return df.select(*[_conform_column(table, found[f.name.lower()], f) for f in wanted.fields])


class Sources:
    """The tables reports read, by name."""

    def __init__(self, tables: Mapping[str, DataFrame] | None = None):
        self._tables: dict[str, DataFrame] = {}
        self._sketches: dict[tuple[str, tuple[str, ...]], KeptSketch] = {}
        self._buckets: dict[str, tuple[str, ...]] = {}
        for name, df in (tables or {}).items():
            self.register(name, df)

    def register(self, name: str, df: DataFrame) -> Sources:
        if name not in SCHEMAS:
            raise KeyError(f"unknown source table {name!r}")
        self._tables[name] = conform(name, df)
        return self

    def get(self, name: str) -> DataFrame:
        if name not in self._tables:
            raise KeyError(f"source table {name!r} is not registered")
        return self._tables[name]

    __getitem__ = get

    def keep(self, name: str, keys: Sequence[str], sketch: KeptSketch) -> Sources:
        """Have hot keys of a table taken from a sketch kept beside it; ``keys`` in the order they were sketched in."""
        unknown = set(keys) - set(SCHEMAS[name].fieldNames())
        if unknown:
            raise KeyError(f"table {name!r} has no column {', '.join(sorted(unknown))}")
        self._sketches[name, tuple(keys)] = sketch
        return self

    def kept(self, name: str, keys: Sequence[str]) -> KeptSketch | None:
        return self._sketches.get((name, tuple(keys)))

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str]) -> Sources:
        """Tables of the session catalog, given as {source name: catalog name}."""
        sources = cls({source: spark.table(table) for source, table in names.items()})
        for source, table in names.items():
            keys = bucket_keys(spark, table)
            if keys:
                sources._buckets[source] = keys
        return sources

    def clustered(self, params: ReportParams) -> ReportParams:
        """``params`` for reports over these tables: joins on keys that two or more tables are bucketed by keep the
        buckets. With one table bucketed alone the other side would lose its protection against hot keys."""
        stored = Counter(self._buckets.values())
        shared = frozenset(keys for keys, n in stored.items() if n > 1)
        return replace(params, skew=replace(params.skew, clustered=params.skew.clustered | shared))

    @classmethod
    def from_parquet(cls, spark: SparkSession, paths: Mapping[str, str]) -> Sources:
        """Parquet tables, given as {source name: path}."""
        return cls({source: spark.read.parquet(path) for source, path in paths.items()})


def bucket_keys(spark: SparkSession, table: str) -> tuple[str, ...]:
    """The columns a catalog table is bucketed by, in lower case; none if it is not."""
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    listed = described.get("Bucket Columns", "").strip("[]")
    return tuple(c.strip().strip("`").lower() for c in listed.split(",") if c.strip())


def store_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> None:
    """Store a source as a catalog table dealt into buckets by ``keys`` and sorted within them.

    Rows are dealt out before they are written, so each bucket is one file and not one per task. Tables that are joined
    need the same number of buckets. A key that holds much of a table makes its bucket as large: leave such tables
    unbucketed, their joins are salted."""
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
    (writer.option("path", path) if path else writer).mode("overwrite").saveAsTable(table)


def write_report(report: DataFrame, path: str, params: ReportParams, rows_per_file: int = 5_000_000) -> int:
    """Write a report as Parquet into the folder of its month; returns the number of rows, counted while writing.

    The month's folder is replaced whole, also by a report without rows; other months are left alone. Files are as
    large as ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` says, small partitions joined and large ones split, and
    hold ``rows_per_file`` rows at most. Beside the months, in ``_volumes`` (which readers of ``path`` pass over), one
    row per month says when it was reported for and how many rows it has; it is written after the rows, and
    :func:`written_volumes` reads it.
    """
    month = reported_first(params)
    counted = Observation()
    rows = report.observe(counted, F.count(F.lit(1)).alias("n_rows")).hint("rebalance")
    rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/report_month={month}")
    n_rows = counted.get["n_rows"]
    volume = report.sparkSession.createDataFrame([(params.as_of, n_rows)], "as_of date, n_rows long")
    volume.coalesce(1).write.mode("overwrite").parquet(f"{path}/_volumes/report_month={month}")
    return n_rows


def reported_first(params: ReportParams) -> dt.date:
    """First day of the month a report is for."""
    return (params.as_of.replace(day=1) - dt.timedelta(days=1)).replace(day=1)


def written_volumes(spark: SparkSession, path: str) -> DataFrame:
    """report_month, as_of and n_rows of every month written to ``path``, without reading a report."""
    return spark.read.parquet(f"{path}/_volumes").select("report_month", "as_of", "n_rows")
