"""Compare a registered query with its SQL, row for row, whatever the order of rows and columns."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return repr(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, str]:
    """Number of rows of ``df``, and what differs ('' if nothing does)."""
    result = con.execute(sql)
    sql_columns = [d[0] for d in result.description]
    wanted = rows_of(sql_columns, result.fetchall())
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(sql_columns):
        return sum(found.values()), f"columns {sorted(df.columns)} against {sorted(sql_columns)}"
    missing, extra = wanted - found, found - wanted
    if missing or extra:
        return (
            sum(found.values()),
            f"{sum(missing.values())} rows missing, e.g. {list(missing)[:2]}; "
            f"{sum(extra.values())} too many, e.g. {list(extra)[:2]}",
        )
    return sum(found.values()), ""
