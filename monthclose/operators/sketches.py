"""Sketches of the most frequent keys, kept beside a table and merged when a report asks for hot keys.

A sketch of a part of a table (a month, a load) is a few kilobytes, however many rows the part has. Sketches of parts
can be combined, so when a part is added or replaced only its own sketch is made anew, and no report has to read a
table's history to learn which keys are hot. A list of hot keys only decides how rows are spread: joins are exact with
any list, an outdated one too.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Distinct keys a kept sketch follows; with it, keys of more than about 1 / ITEMS of the rows are never missed.
ITEMS = 65_536
PART = "part"


def hashed(keys: Sequence[str]) -> Column:
    """What sketches count and joins compare with the list: one number for the values of ``keys``, in their order."""
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def sketch_parts(df: DataFrame, keys: Sequence[str], part: Column | None = None, items: int = ITEMS) -> DataFrame:
    """part, n, sketch: one row per value of ``part`` (one in all, if not given). Rows with a null key do not count."""
    rows = df.select((F.lit("") if part is None else part).cast("string").alias(PART), *keys).dropna(subset=list(keys))
    counted = rows.select(F.coalesce(PART, F.lit("")).alias(PART), hashed(keys).alias("h"))
    return counted.groupBy(PART).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k_accumulate(h, {items})").alias("sketch")
    )


def write_sketches(parts: DataFrame, path: str) -> None:
    """Keep the sketches of :func:`sketch_parts`; parts not among them are left as they are."""
    (
        parts.repartition(1)  # one small row per part
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PART)
        .parquet(path)
    )


@dataclass(frozen=True)
class KeptSketch:
    """The sketches of a table's parts for one set of keys."""

    parts: DataFrame
    items: int = ITEMS

    @classmethod
    def read(cls, spark: SparkSession, path: str, items: int = ITEMS) -> KeptSketch:
        return cls(spark.read.parquet(path), items)

    def top(self, most: int) -> tuple[list[tuple[int, int]], int]:
        """The ``most`` most frequent hashes of the whole table with their counts, and the number of rows."""
        # Grouped, though by nothing: a global aggregate would ask empty partitions for a sketch, which they have none of.
        merged = self.parts.groupBy(F.lit("all")).agg(
            F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {self.items}), {most})").alias("top"),
            F.sum("n").alias("n"),
        ).first()
        return ([(r[0], r[1]) for r in merged["top"]], merged["n"]) if merged else ([], 0)
