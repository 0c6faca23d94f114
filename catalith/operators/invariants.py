"""Stored-row invariants as data-quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.paths import RESERVED_CONCEPT, labels, leaf
from catalith.functions.text import blank
from catalith.issues import as_issues, check_rows, key_text


def leaf_name(df: DataFrame, id_col: str, name: str, object_type: str) -> DataFrame:
    """The name equals the last label of the id."""
    bad = df.where(leaf(id_col) != F.col(name))
    return as_issues(bad, "leaf_name", object_type, F.col(id_col), F.col(name))


def lowercase_identity(df: DataFrame, cols: list[str], object_type: str, key: Column) -> DataFrame:
    checks = [("lowercase_identity", F.col(c) != F.lower(c), F.concat(F.lit(c + "="), F.col(c))) for c in cols]
    return check_rows(df, object_type, key, checks, wave=2)


def reason_pairing(df: DataFrame, object_type: str, key: Column) -> DataFrame:
    """A row has no reason exactly when it was never updated."""
    bad = df.where(F.col("update_reason").isNull() != (F.col("insert_ts") == F.col("update_ts")))
    return as_issues(bad, "reason_pairing", object_type, key, F.coalesce("update_reason", F.lit("(none)")))


def validated_pairing(df: DataFrame, object_type: str, key: Column) -> DataFrame:
    """A stamp exists exactly when the row is validated."""
    bad = df.where(F.col("validated") != F.col("validated_ts").isNotNull())
    return as_issues(bad, "validated_pairing", object_type, key, F.col("validated").cast("string"))


def concept_shape(df: DataFrame, concept_id: str) -> DataFrame:
    """3 to 6 labels, the one before the last is `concept`."""
    n = F.size(labels(concept_id))
    ok = n.between(3, 6) & (F.try_element_at(labels(concept_id), F.lit(-2)) == RESERVED_CONCEPT)
    bad = df.where(~F.coalesce(ok, F.lit(False)))
    return as_issues(bad, "concept_shape", "concepts", F.col(concept_id), n.cast("string"))


def not_null(df: DataFrame, cols: list[str], object_type: str, key: Column) -> DataFrame:
    return check_rows(df, object_type, key, [("not_null", F.col(c).isNull(), F.lit(c)) for c in cols], wave=2)


def unique_run_ts(audit: DataFrame, ts: str = "loaded_ts") -> DataFrame:
    """One audit row per run time."""
    many = audit.groupBy(ts).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return as_issues(many, "unique_run_ts", "load_audit", F.col(ts).cast("string"), F.col("n").cast("string"))


def history_key_unique(history: DataFrame, key: list[str], object_type: str, end_ts: str = "end_ts") -> DataFrame:
    many = history.groupBy(*key, end_ts).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return as_issues(many, "history_key_unique", object_type, key_text(*key, end_ts), F.col("n").cast("string"))


def enum_check(df: DataFrame, col: str, allowed: tuple[str, ...], object_type: str, key: Column) -> DataFrame:
    """A value, when there is one, is in a fixed set; case counts."""
    bad = df.where(F.col(col).isNotNull() & ~F.col(col).isin(*allowed))
    return as_issues(bad, "enum_check", object_type, key, F.col(col))


def drop_needs_reason(df: DataFrame, expr: str, notes: str, object_type: str, key: Column) -> DataFrame:
    """A deliberately absent expression must be explained in the notes."""
    bad = df.where(F.col(expr).isNull() & blank(F.col(notes)))
    return as_issues(bad, "drop_needs_reason", object_type, key, F.lit("no notes"))
