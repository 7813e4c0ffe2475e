"""Bit filters: rows of a large table whose key cannot occur elsewhere go before anything is shuffled.

The keys asked for set bits of one field by their hash. The field is a scalar subquery, and a row stays if the bit of
its own key is set, a test of two built-in functions right above the scan. No wanted row is ever lost. Others may stay
by clash of hashes, so a join or semi join must follow. The field takes ``bits / 8`` bytes, 4 MB as it comes, whatever
the tables hold; with a million distinct keys 3 % of the unwanted keys pass, with ten million a quarter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25


def _position(keys: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def key_bits(asked: Sequence[tuple[DataFrame, Sequence[str]]], bits: int = BITS) -> Column:
    """The field of all keys of the tables in ``asked``, an array of ``bits / 64`` numbers; null keys set no bit.

    Keys are folded into words map-side, so at most ``bits / 64`` rows a task are shuffled; the last step gathers
    that many in all.
    """
    if bits < 64 or bits % 64:
        raise ValueError("bits must be a multiple of 64")
    places = reduce(
        DataFrame.unionByName, [df.select(*keys).dropna().select(_position(keys, bits).alias("p")) for df, keys in asked]
    )
    ones = places.select(
        F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p % 64 AS int))").alias("value")
    )
    zeros = places.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.expr("0L").alias("value"))
    words = ones.unionByName(zeros).groupBy("word").agg(F.bit_or("value").alias("value"))
    return words.agg(F.sort_array(F.collect_list(F.struct("word", "value"))).alias("w")).select("w.value").scalar()


def maybe_in(rows: DataFrame, keys: Sequence[str], field: Column, bits: int = BITS) -> DataFrame:
    """Rows whose key may be one of those ``field`` was made from by the same ``bits``; rows with a null key go."""
    at = _position(keys, bits)
    word = F.get(field, F.shiftright(at, 6).cast("int"))
    return rows.dropna(subset=list(keys)).where(F.getbit(word, (at % 64).cast("int")) == 1)
