"""Equi joins that stay balanced when a key is null or hot."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthclose.operators.prefilter import key_bits, maybe_in
from monthclose.operators.sketches import KeptSketch, hashed
from monthclose.params import SkewPolicy

_N = "__n"
_HOT = "__hot"
_SALT = "__salt"
_FOUND = "__found"


def hot_keys(side: DataFrame | KeptSketch, keys: Sequence[str], policy: SkewPolicy) -> list[int]:
    """Hashes of the keys that hold more than the policy's share of all rows; rows with a null key do not count.

    A table is read for it in one job: a sketch of the most frequent hashes, built map-side and merged, of which one
    row comes back. Of a :class:`KeptSketch` only the kept rows are read.
    There can be no more than ``1 / share``, so the list is small however large the data is. Whatever uses it is
    exact with any list of keys, also an outdated one; the list only decides how rows are spread.
    """
    session = (side.parts if isinstance(side, KeptSketch) else side).sparkSession
    share = policy.share_of(int(session.conf.get("spark.sql.shuffle.partitions")))
    most = min(math.ceil(1 / share), 50_000)
    if isinstance(side, KeptSketch):
        top, total = side.top(min(most, side.items))
    else:
        counted = side.select(*keys).dropna().select(hashed(keys).alias("h"))
        top, total = counted.agg(
            F.expr(f"approx_top_k(h, {most}, {min(8 * most, 1_000_000)})"), F.count(F.lit(1))
        ).first()
    return sorted(item for item, count in top or () if count > total * share)


def spread(columns: Sequence[str], parts: int) -> Column:
    """Part number from the row's own values: a retried task puts each row where it was before."""
    listed = ", ".join(f"`{c}`" for c in columns)
    return F.expr(f"cast(pmod(xxhash64({listed}), {parts}) AS int)")


def any_null(columns: Sequence[str]) -> Column:
    return F.expr(" OR ".join(f"`{c}` IS NULL" for c in columns))


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    policy: SkewPolicy,
    hot_in: DataFrame | KeptSketch | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Left outer join on the columns ``on``, exact whatever the distribution of keys.

    * Left rows with a null key match nothing; they are spread over ``salts`` partitions instead of
      meeting in one, by the values of ``spread_by``, all columns if not given. Columns named there are carried
      through the joins before this one, also if nothing else needs them.
    * A hot key on the left is split by AQE's skew join, which can split the left side of a left join.
      It needs an exchange right below each side; the salt in the join key sees to that even where
      ``right`` is the result of an aggregation by the same key.
    * A hot key on the right cannot be split by AQE. Hot keys are looked for in ``hot_in``, the table
      ``right`` is made from, or its kept sketch. Their right rows are salted. Left rows whose key is hot and does occur in
      ``right`` (looked up in the same query) are copied once per salt; as they have matches, the
      null-extended copies, from a salt that drew no row, are all spurious and are removed. All other left
      rows meet no salted row and stay single, so a list that is out of date loses nothing.
    * Keys the policy calls clustered are joined in the buckets they are stored in, without exchange or salt.
    """
    on = list(on)
    shared = (set(left.columns) & set(right.columns)) - set(on)
    if shared:
        raise ValueError(f"both sides have a column {', '.join(sorted(shared))}")
    if tuple(on) in policy.clustered:
        # Rows with a null key have no match; put aside, they need not be dealt out and do not undo the buckets.
        matched = left.where(~any_null(on)).join(right, on, "left")
        return matched.unionByName(left.where(any_null(on)), allowMissingColumns=True)
    null_salt = F.when(any_null(on), spread(spread_by or left.columns, policy.salts) + 1).otherwise(0)
    # Always 0, but computed: the optimizer would turn a literal into a filter and hash on ``on`` alone. Known not to be
    # null, or a test for it would be pushed far down into ``right`` and keep it from sharing shuffles with its like.
    no_salt = F.coalesce(spread(on, 1), F.lit(0))
    hot = hot_keys(hot_in, on, policy) if hot_in is not None else []
    if not hot:
        salted = left.withColumn(_SALT, null_salt)
        return salted.join(right.withColumn(_SALT, no_salt), [*on, _SALT], "left").drop(_SALT)

    is_hot = hashed(on).isin(hot)
    # As many rows as there are hot keys, but for clashes of 64-bit hashes.
    present = right.where(is_hot).select(*on).dropna().distinct().withColumn(_HOT, F.lit(True))
    salted_right = right.withColumns(
        {_SALT: F.when(is_hot, spread(right.columns, policy.salts)).otherwise(no_salt), _FOUND: F.lit(True)}
    )
    all_salts = F.sequence(F.lit(0), F.lit(policy.salts - 1))
    marked = left.join(F.broadcast(present), on, "left").withColumn(_HOT, F.coalesce(_HOT, F.lit(False)))
    salted_left = marked.withColumn(_SALT, F.explode(F.when(F.col(_HOT), all_salts).otherwise(F.array(null_salt))))
    joined = salted_left.join(salted_right, [*on, _SALT], "left")
    return joined.where(~F.col(_HOT) | F.col(_FOUND)).drop(_HOT, _SALT, _FOUND)


def full_outer_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    policy: SkewPolicy,
    hot_in: DataFrame | KeptSketch | None = None,
) -> DataFrame:
    """Full outer join on the columns ``on``: the left join, and the right rows whose key does not occur on the left.

    AQE never splits a full outer join; both parts can be split, and null keys are spread in both.
    """
    matched = left_join(left, right, on, policy, hot_in)
    alone = filter_by_key(right, left, on, policy, anti=True)
    return matched.unionByName(alone, allowMissingColumns=True)


def filter_by_key(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    policy: SkewPolicy,
    anti: bool = False,
    prefilter: bool = False,
) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right`` (semi join), or does not (anti join).

    The keys of ``right`` are made distinct map-side first, so repeated keys there cost nothing. The salt
    puts an exchange below both sides, which lets AQE split a hot key on the left; null keys, which only
    an anti join keeps, are spread.

    ``prefilter`` is for a large table against few keys: a bit filter of the right keys thins out the left rows
    of a semi join before they are shuffled, one of the left keys the right rows of an anti join. The other side is
    read once more for it. Clustered keys need none, as nothing is shuffled.
    """
    on = list(on)
    if prefilter and tuple(on) not in policy.clustered:
        if anti:
            right = maybe_in(right, on, key_bits([(left, on)]))
        else:
            left = maybe_in(left, on, key_bits([(right, on)]))
    keys = right.select(*on).dropna().distinct()
    if tuple(on) in policy.clustered:
        kept = left.where(~any_null(on)).join(keys, on, "left_anti" if anti else "left_semi").select(*left.columns)
        return kept.unionByName(left.where(any_null(on))) if anti else kept
    keys = keys.withColumn(_SALT, spread(on, 1))
    null_salt = F.when(any_null(on), spread(left.columns, policy.salts) + 1).otherwise(0)
    salted = left.withColumn(_SALT, null_salt)
    return salted.join(keys, [*on, _SALT], "left_anti" if anti else "left_semi").select(*left.columns)
