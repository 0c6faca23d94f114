"""Referential checks: anti joins, spread over tasks where many rows share one reference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.paths import RESERVED_CONCEPT, labels, leading, level_count, subpath
from catalith.issues import as_issues
from catalith.skew import spread_join


def ids(*spaces: tuple[DataFrame, str]) -> DataFrame:
    """All ids of several relations in one column `_ref`; an anti join needs no distinct."""
    frames = [df.select(F.col(c).alias("_ref")) for df, c in spaces]
    return reduce(DataFrame.union, frames)


def unresolved(child: DataFrame, reference: Column, key: Column, known: DataFrame) -> DataFrame:
    """(object_key, _ref) for every non-NULL reference without a match in `known._ref`."""
    refs = child.select(key.cast("string").alias("object_key"), reference.alias("_ref")).where(
        F.col("_ref").isNotNull()
    )
    return spread_join(refs, known, ["_ref"], "left_anti", spread_by=["object_key"])


def case_hint(missing: DataFrame, known: DataFrame) -> DataFrame:
    """Add `hint`: the known id that differs from the missing one only by case.

    Several candidates give the smallest, so the result does not depend on
    row order. The distinct missing ids are matched first, which keeps the
    join small however often one of them is used.
    """
    wanted = missing.select("_ref").distinct().withColumn("_low", F.lower("_ref"))
    candidates = known.groupBy(F.lower("_ref").alias("_low")).agg(F.min("_ref").alias("hint"))
    hints = wanted.join(candidates, "_low").select("_ref", "hint")
    return spread_join(missing, hints, ["_ref"], "left", spread_by=["object_key"])


def orphan_references(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, object_type: str, key: Column, hints: bool = False
) -> DataFrame:
    """Rows whose reference names no parent row. A NULL reference is no orphan."""
    known = ids((parent, pk))
    missing = unresolved(child, F.col(fk), key, known)
    hint = F.lit(None)
    if hints:
        missing, hint = case_hint(missing, known), F.col("hint")
    return as_issues(missing, "orphan_references", object_type, F.col("object_key"), F.col("_ref"), hint)


def orphan_edges(edges: list[tuple[DataFrame, str, Column, str, DataFrame, str]]) -> DataFrame:
    """Orphans of many references in one anti join, with case hints.

    Each edge is (child, foreign key, object key, object type, parent, parent
    key). References and known ids carry the name of their id space, so every
    relation is shuffled once for all its edges.
    """
    refs, known, spaces = [], [], {}
    for child, fk, key, object_type, parent, pk in edges:
        space = F.lit(pk)
        refs.append(
            child.select(
                F.lit(object_type).alias("object_type"), key.cast("string").alias("object_key"),
                space.alias("_space"), F.col(fk).alias("_ref"),
            ).where(F.col("_ref").isNotNull())
        )
        if pk not in spaces:
            spaces[pk] = True
            known.append(parent.select(space.alias("_space"), F.col(pk).alias("_ref")))
    all_refs, all_known = reduce(DataFrame.union, refs), reduce(DataFrame.union, known)
    missing = spread_join(all_refs, all_known, ["_space", "_ref"], "left_anti", spread_by=["object_type", "object_key"])
    wanted = missing.select("_space", "_ref").distinct().withColumn("_low", F.lower("_ref"))
    candidates = all_known.groupBy("_space", F.lower("_ref").alias("_low")).agg(F.min("_ref").alias("hint"))
    hints = wanted.join(candidates, ["_space", "_low"]).select("_space", "_ref", "hint")
    hinted = spread_join(missing, hints, ["_space", "_ref"], "left", spread_by=["object_type", "object_key"])
    return hinted.select(
        F.lit(2).alias("wave"), F.lit("orphan_references").alias("rule"), "object_type", "object_key",
        F.col("_ref").alias("detail"), "hint",
    )


def optional_reference(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, object_type: str, key: Column
) -> DataFrame:
    """A pointer may be absent, but one that is there must resolve."""
    missing = unresolved(child, F.col(fk), key, ids((parent, pk)))
    return as_issues(missing, "optional_reference", object_type, F.col("object_key"), F.col("_ref"))


def array_reference(
    df: DataFrame, arr: str, key: Column, spaces: list[tuple[DataFrame, str]], object_type: str
) -> DataFrame:
    """Every entry of the list must be an id of one of the spaces."""
    entries = df.select(key.alias("_key"), F.explode(arr).alias("_entry"))
    missing = unresolved(entries, F.col("_entry"), F.col("_key"), ids(*spaces))
    return as_issues(missing, "array_reference", object_type, F.col("object_key"), F.col("_ref"))


def anchor_reference(concepts: DataFrame, concept_id: str, spaces: list[tuple[DataFrame, str]]) -> DataFrame:
    """The labels before `concept` name an object of the kind their number implies.

    `spaces` lists the relations for 1, 2, 3, ... labels. Malformed ids belong
    to another rule and are left out.
    """
    parts = labels(concept_id)
    n = F.size(parts)
    anchors = concepts.where((n >= 3) & (F.element_at(parts, -2) == RESERVED_CONCEPT)).select(
        F.col(concept_id).alias("object_key"),
        subpath(concept_id, 0, -2).alias("_ref"),
        (level_count(concept_id) - 2).alias("_depth"),
    )
    known = reduce(
        DataFrame.union,
        [df.select(F.col(c).alias("_ref"), F.lit(i).alias("_depth")) for i, (df, c) in enumerate(spaces, 1)],
    )
    missing = spread_join(anchors, known, ["_ref", "_depth"], "left_anti", spread_by=["object_key"])
    detail = F.when(F.col("_depth") > len(spaces), F.concat(F.lit("too deep: "), "_ref")).otherwise(F.col("_ref"))
    return as_issues(missing, "anchor_reference", "concepts", F.col("object_key"), detail)


def prefix_redundancy(df: DataFrame, id_col: str, parent: str, n: int, object_type: str) -> DataFrame:
    """The stored parent must equal the leading labels of the id."""
    bad = df.where(~leading(id_col, n).eqNullSafe(F.col(parent)))
    return as_issues(bad, "prefix_redundancy", object_type, F.col(id_col), F.col(parent))
