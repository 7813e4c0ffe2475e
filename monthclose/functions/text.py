"""Text normalisers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def normalize_phone(text: Column) -> Column:
    """Digits only; a leading country code 1 is dropped from eleven-digit numbers."""
    number = digits(text)
    return F.regexp_replace(number, "^1([0-9]{10})$", "$1")


def to_bool(flag: Column) -> Column:
    """Boolean from a boolean or its text form; unreadable text becomes null instead of failing the job."""
    return flag.try_cast("boolean")


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
