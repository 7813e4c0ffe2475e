"""Tagged-union aggregation: several tables united under one key and added up by a single grouping.

Where tables only contribute numbers to a key, joining their groupings one after the other costs an exchange per table
and join. United, with nulls for the measures a table does not have, they meet in one grouping that is combined
map-side, so a hot key costs each task one row and no key ever meets another's rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keyed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a null (or NaN) key, as ``dropna`` leaves them.

    Spelled as plain tests, which the optimizer knows to hold from there on: it adds none of its own to one of several
    branches that read the same rows, and they share a shuffle."""
    tests = [F.col(k).isNotNull() for k in keys]
    tests += [~F.isnan(k) for k in keys if rows.schema[k].dataType.typeName() in ("float", "double")]
    return rows.where(reduce(Column.__and__, tests))


def united(tables: Sequence[tuple[DataFrame, Mapping[str, Column]]], keys: Sequence[str], how=F.sum) -> DataFrame:
    """``keys`` and one column per measure: ``how`` over the rows of all tables that give the measure.

    Each table comes with its columns by name, the keys among them. Rows with a null key are left out. A key that no
    table gives a measure for has null there (``F.sum`` and ``F.max`` skip nulls)."""
    parts = [_keyed(df.select(*[column.alias(name) for name, column in columns.items()]), keys) for df, columns in tables]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    measures = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[how(c).alias(c) for c in measures])
