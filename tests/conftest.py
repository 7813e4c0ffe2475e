import datetime as dt
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from monthclose.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def table(spark):
    """A DataFrame from (schema text, rows); times may be given as text."""

    def make(schema: str, *rows):
        names = [c.split()[0] for c in schema.split(",")]
        kinds = [c.split()[1] for c in schema.split(",")]

        def value(kind, v):
            if kind == "timestamp_ntz" and isinstance(v, str):
                return dt.datetime.fromisoformat(v)
            if kind == "date" and isinstance(v, str):
                return dt.date.fromisoformat(v)
            return v

        typed = [tuple(value(k, v) for k, v in zip(kinds, row, strict=True)) for row in rows]
        return spark.createDataFrame(typed, ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))

    return make


def bag(df) -> Counter:
    """Rows with their multiplicity, columns by name."""
    order = sorted(df.columns)
    return Counter(tuple(r) for r in df.select(*order).collect())
