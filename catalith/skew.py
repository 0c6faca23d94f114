"""Joins that survive a key holding a large share of the rows.

An aggregate is safe by itself, because Spark combines it map-side before the
shuffle. A join is not: every row of one key meets in one task.

Between two tables of rows, adaptive execution splits an overfull partition of
either side of an inner join, and of the left side of a left, semi or anti join,
whatever the key, NULL included. It looks at real partition sizes, so nothing is
counted beforehand. It can only do so if both sides are shuffled for the join.

A side that was grouped by the join key just before is already in place and is
not shuffled again; then the rows of a hot key cannot be split. For that case the
keys are salted here, each by as many salts as its row count asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that one task may take. The list of keys above it, the only
# thing broadcast, has at most one entry for so many rows of the table.
ROWS_PER_TASK = 1_000_000
# Rows with a NULL key match nothing, so any number of salts is right for them.
NULL_SALTS = 1 << 20


def hot_keys(rows: DataFrame, key: list[str], target: int | None = None) -> DataFrame:
    """(key, _salts) of each key with more than `target` rows, one salt for each `target` rows begun."""
    target = target or ROWS_PER_TASK
    return counted_hot_keys(rows.select(*key).groupBy(*key).agg(F.count(F.lit(1)).alias("_n")), key, "_n", target)


def counted_hot_keys(counts: DataFrame, key: list[str], n: str, target: int | None = None) -> DataFrame:
    """The same from counts at hand."""
    target = target or ROWS_PER_TASK
    salts = F.ceil(F.col(n) / F.lit(target)).cast("bigint")
    return counts.where(F.col(n) > target).select(*key, salts.alias("_salts"))


def _any_null(key: list[str]) -> Column:
    test = F.lit(False)
    for k in key:
        test = test | F.col(k).isNull()
    return test


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: list[str],
    how: str = "inner",
    spread_by: list[str] | None = None,
    grouped: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join on `key` in which a hot key of `left` does not end up in one task.

    `how` is inner, left, left_semi or left_anti. With `grouped`, `right` holds
    one row per key and comes from grouping by it: hot keys of `left` are salted
    and their single row of `right` is copied to each salt. `spread_by` names
    left columns that tell the rows of one key apart; the salt is a hash of
    them, never a random number, so a task repeated after an executor loss sends
    each row to the same place. `hot` gives the hot keys where they are known.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join cannot keep the meaning of a {how!r} join")
    if not grouped:
        return left.join(right, key, how)
    hot = F.broadcast(hot_keys(left, key) if hot is None else hot)
    spread = F.xxhash64(*(spread_by or [c for c in left.columns if c not in key] or key))
    salts = F.when(_any_null(key), F.lit(NULL_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_left = left.join(hot, key, "left").withColumn("_salt", F.pmod(spread, salts)).drop("_salts")
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)) - 1)
    salted_right = right.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return salted_left.join(salted_right, [*key, "_salt"], how).drop("_salt")


def first_place(order: list[str]) -> Column:
    """Aggregate: the smallest value of the ordering columns in the group, as a struct; NULL comes first.

    Of a single column the plain minimum is taken, as that of structs is found by sorting the rows.
    """
    if len(order) > 1:
        return F.min(F.struct(*order))
    least = F.when(F.count(order[0]) == F.count(F.lit(1)), F.min(order[0]))
    return F.struct(least.alias(order[0]))
