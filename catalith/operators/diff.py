"""Comparing a new snapshot with the published one, and the guards on the result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.text import blank
from catalith.issues import as_issues, key_text
from catalith.specs import TableSpec

# Defaults of the mass-delete guard.
MASS_DELETE_FRACTION = 0.25
MASS_DELETE_MIN_COUNT = 20


def content_changed(old: Column, new: Column, content: list[str]) -> Column:
    """Some compared column differs; NULL equals NULL and array order counts."""
    same = F.lit(True)
    for c in content:
        same = same & old[c].eqNullSafe(new[c])
    return ~same


def snapshot_diff(new: DataFrame, cur: DataFrame, key: list[str], content: list[str]) -> DataFrame:
    """Rows that differ: (op, key columns, old struct, new struct). No-ops are dropped.

    The key is unique on both sides, so no task gets a hot key. Both sides are
    hash-partitioned on the key once; a published table bucketed on the key
    skips even that. Old rows keep every stored column, the history needs them.
    """
    cur_side = cur.select(*key, F.struct(*cur.columns).alias("old"))
    new_side = new.select(*key, F.struct(*new.columns).alias("new"))
    joined = new_side.join(cur_side, key, "full_outer")
    op = (
        F.when(F.col("old").isNull(), F.lit("insert"))
        .when(F.col("new").isNull(), F.lit("delete"))
        .when(content_changed(F.col("old"), F.col("new"), content), F.lit("update"))
    )
    return joined.withColumn("op", op).where(F.col("op").isNotNull()).select("op", *key, "old", "new")


def diff_relation(spec: TableSpec, new: DataFrame, cur: DataFrame) -> DataFrame:
    return snapshot_diff(new, cur, list(spec.key), list(spec.content))


def diff_summary(changes: dict[str, DataFrame]) -> DataFrame:
    """(table, op, n) over all relations."""
    frames = [df.select(F.lit(name).alias("table"), "op") for name, df in changes.items()]
    return reduce(DataFrame.union, frames).groupBy("table", "op").agg(F.count(F.lit(1)).alias("n"))


def reason_discipline(changes: DataFrame, key: list[str], object_type: str, reason: str = "update_reason") -> DataFrame:
    """An insert explains nothing, an update says why, a delete is free."""
    text = F.col("new")[reason]
    problem = F.when((F.col("op") == "insert") & text.isNotNull(), F.lit("reason on insert")).when(
        (F.col("op") == "update") & blank(text), F.lit("update without reason")
    )
    bad = changes.withColumn("_p", problem).where(F.col("_p").isNotNull())
    return as_issues(bad, "reason_discipline", object_type, key_text(*key), F.col("_p"), wave=3)


def check_guard_knobs(fraction: float, min_count: int) -> None:
    if isinstance(fraction, bool) or not isinstance(fraction, (int, float)) or not 0 <= fraction <= 1:
        raise ValueError(f"mass-delete fraction must be a number from 0 to 1, got {fraction!r}")
    if isinstance(min_count, bool) or not isinstance(min_count, int) or min_count < 0:
        raise ValueError(f"mass-delete minimum must be a whole number of at least 0, got {min_count!r}")


def mass_delete_guard(
    changes: list[DataFrame],
    state: list[DataFrame],
    fraction: float = MASS_DELETE_FRACTION,
    min_count: int = MASS_DELETE_MIN_COUNT,
) -> DataFrame:
    """One row: deletes and current rows over all relations, and whether that is too many.

    Exactly the fraction, and fewer deletes than the minimum, pass.
    """
    check_guard_knobs(fraction, min_count)
    zero = F.lit(0).cast("bigint")
    frames = [c.agg(F.count_if(F.col("op") == "delete").alias("d")).select("d", zero.alias("c")) for c in changes]
    frames += [s.agg(F.count(F.lit(1)).alias("c")).select(zero.alias("d"), "c") for s in state]
    totals = reduce(DataFrame.union, frames).agg(F.sum("d").alias("deletes"), F.sum("c").alias("current_rows"))
    too_many = (F.col("deletes") >= min_count) & (F.col("deletes") > F.col("current_rows") * F.lit(float(fraction)))
    return totals.withColumn("violation", too_many)


def relation_counts(relations: dict[str, DataFrame]) -> DataFrame:
    """Row count of every relation in one frame."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n") for name, df in relations.items()
    ]
    return reduce(DataFrame.union, frames)
