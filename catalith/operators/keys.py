"""Uniqueness rules.

All follow one pattern: aggregate per key first (combined map-side), keep only
the groups that offend, and join those back to the rows over split hot keys.
No window sorts a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.text import blank
from catalith.issues import as_issues, key_text
from catalith.skew import counted_hot_keys, first_place, spread_join


def mark_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Add `first_place` (struct of the order columns) and `is_first` to every row.

    `order` must tell the rows of one key apart.
    """
    firsts = df.groupBy(*key).agg(first_place(order).alias("first_place"))
    return spread_join(df, firsts, key, "inner", spread_by=order, grouped=True).withColumn(
        "is_first", F.struct(*order) == F.col("first_place")
    )


def later_occurrences(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Rows that repeat a key seen earlier, with `first_place`. Clean keys never meet the join."""
    repeated = (
        df.groupBy(*key)
        .agg(first_place(order).alias("first_place"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
    )
    # A key of very many rows is a repeated one, so it need not be counted again.
    hot = counted_hot_keys(repeated, key, "_n")
    rows = spread_join(df, repeated.drop("_n"), key, "inner", spread_by=order, grouped=True, hot=hot)
    return rows.where(F.struct(*order) > F.col("first_place"))


def first_wins_dedup(
    df: DataFrame, key: list[str], order: list[str], object_type: str
) -> tuple[DataFrame, DataFrame]:
    """Keep the first row of each key; every later one is an issue naming both places."""
    marked = mark_first(df, key, order)
    kept = marked.where("is_first").drop("is_first", "first_place")
    later = marked.where(~F.col("is_first"))
    here = key_text(*order)
    first = key_text(*[F.col("first_place")[c] for c in order])
    return kept, as_issues(
        later, "first_wins_dedup", object_type, key_text(*key), F.concat(here, F.lit(" after "), first), wave=1
    )


def namespaces_disjoint(a: DataFrame, a_id: str, b: DataFrame, b_id: str, object_type: str) -> DataFrame:
    """Ids of `a` that are also ids of `b`."""
    left = a.select(F.col(a_id).alias("_id"))
    right = b.select(F.col(b_id).alias("_id"))
    both = left.join(right, "_id", "left_semi")
    return as_issues(both, "namespaces_disjoint", object_type, F.col("_id"), F.col("_id"), wave=1)


def unique_address(df: DataFrame, address: list[str], row_key: list[str], object_type: str) -> DataFrame:
    """At most one row per composite address; later rows (by key) name the first."""
    later = later_occurrences(df.select(*dict.fromkeys([*address, *row_key])), address, row_key)
    first = key_text(*[F.col("first_place")[c] for c in row_key])
    return as_issues(later, "unique_address", object_type, key_text(*row_key), F.concat(F.lit("same as "), first))


def unordered_pair(a: str, b: str) -> tuple[Column, Column]:
    return F.least(a, b).alias("_low"), F.greatest(a, b).alias("_high")


def unordered_pair_unique(df: DataFrame, a: str, b: str, name: str, order: list[str], object_type: str) -> DataFrame:
    """(a, b, name) and (b, a, name) are the same key."""
    pairs = df.select(*dict.fromkeys([a, b, name, *order]), *unordered_pair(a, b))
    later = later_occurrences(pairs, ["_low", "_high", name], order)
    first = key_text(*[F.col("first_place")[c] for c in order])
    return as_issues(
        later, "unordered_pair_unique", object_type, key_text(*order), F.concat(F.lit("same as "), first)
    )


def disambiguation_required(
    df: DataFrame, group: list[str], text: str, row_key: list[str], object_type: str
) -> DataFrame:
    """In a group of several rows each row must say when to use it."""
    several = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    silent = df.where(blank(F.col(text))).select(*dict.fromkeys([*group, *row_key]))
    rows = spread_join(silent, several, group, "inner", spread_by=row_key, grouped=True)
    return as_issues(
        rows, "disambiguation_required", object_type, key_text(*row_key),
        F.concat(F.col("n_rows").cast("string"), F.lit(" rows share "), key_text(*group)),
    )


def once_per_parent(df: DataFrame, parent: list[str], child: str, order: list[str], object_type: str) -> DataFrame:
    """A child may be listed once per parent; later listings are issues."""
    later = later_occurrences(df.select(*dict.fromkeys([*parent, child, *order])), [*parent, child], order)
    return as_issues(later, "once_per_parent", object_type, key_text(*parent, *order), F.col(child).cast("string"), wave=1)
