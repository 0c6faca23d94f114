"""What expressions depend on. References stay an array in the row wherever a row-local test will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions import expressions as E
from catalith.functions.binding import compute_once
from catalith.functions.paths import leading, parent
from catalith.issues import Check, as_issues, check_rows
from catalith.operators.references import case_hint, ids, unresolved
from catalith.skew import spread_join


def with_references(df: DataFrame, expr: str) -> DataFrame:
    """Add `_refs`, the references of the expression; the text is cut up once per row."""
    return compute_once(df, {"_refs": E.column_references(F.col(expr))})


def column_refs(df: DataFrame, expr: str, key: str) -> DataFrame:
    """One row per reference in text order: (expr_key, pos, ref, n_parts, table_id)."""
    rows = with_references(df, expr)
    exploded = rows.select(F.col(key).alias("expr_key"), F.posexplode("_refs").alias("pos", "ref"))
    return exploded.select(
        "expr_key", "pos", "ref", F.size(F.split("ref", r"\.")).alias("n_parts"), leading("ref", 3).alias("table_id")
    )


def under_qualified(df: DataFrame, expr: str, key: str, object_type: str) -> DataFrame:
    """Expressions with a reference of other than four parts: one issue each."""
    bad = compute_once(df, {"_bad": E.badly_qualified(F.col(expr))}).where(F.size("_bad") > 0)
    return as_issues(bad, "column_refs", object_type, F.col(key), F.array_join("_bad", ","))


def tables_referenced(df: DataFrame, expr: str, into: str = "target_tables_referenced") -> DataFrame:
    return compute_once(df, {into: E.tables_referenced(F.col(expr))})


def refs_resolve(df: DataFrame, expr: str, key: str, columns: DataFrame, column_id: str, object_type: str) -> DataFrame:
    """Referenced columns that are not documented, with a hint when only the case differs."""
    refs = with_references(df, expr).select(F.col(key).alias("_key"), F.explode("_refs").alias("_r"))
    # Columns may be made from fewer rows, which is all that Spark would judge their size by; candidates for hints too.
    known = ids((columns, column_id)).hint("merge")
    missing = case_hint(unresolved(refs, F.col("_r"), F.col("_key"), known), known)
    return as_issues(missing, "refs_resolve", object_type, F.col("object_key"), F.col("_ref"), F.col("hint"))


def endpoint_membership(df: DataFrame, expr: str, a: str, b: str, key: Column) -> DataFrame:
    """A join condition may touch only its two endpoints; one issue per foreign table."""
    foreign = F.array_sort(F.array_except(E.tables_of(F.col("_refs")), F.array(a, b)))
    rows = compute_once(with_references(df, expr).withColumn("_key", key), {"_foreign": foreign})
    exploded = rows.select("_key", F.explode("_foreign").alias("_t"))
    return as_issues(exploded, "endpoint_membership", "table_relationships", F.col("_key"), F.col("_t"))


def endpoint_coverage(df: DataFrame, expr: str, a: str, b: str, key: Column) -> DataFrame:
    """Two different endpoints must both be referenced."""
    missing = F.array_sort(F.array_except(F.array(a, b), E.tables_of(F.col("_refs"))))
    pairs = with_references(df.where(F.col(a) != F.col(b)), expr)
    rows = compute_once(pairs.withColumn("_key", key), {"_m": missing}).where(F.size("_m") > 0)
    return as_issues(rows, "endpoint_coverage", "table_relationships", F.col("_key"), F.array_join("_m", ","))


def no_refs(df: DataFrame, expr: str, key: Column, object_type: str) -> DataFrame:
    """A constant expression relates nothing; NULL is a deliberate drop and no constant."""
    rows = with_references(df, expr).where(F.size("_refs") == 0)
    return as_issues(rows, "no_refs", object_type, key, F.col(expr))


def self_reference(
    df: DataFrame, expr: str, source_column: str, key: str, columns: DataFrame, column_id: str
) -> DataFrame:
    """A mapping may not lean on the source column's own table (documented columns only)."""
    rows = compute_once(with_references(df, expr), {"_own": parent(source_column)})
    own = F.array_distinct(F.filter("_refs", lambda r: F.substring_index(r, ".", 3) == F.col("_own")))
    rows = compute_once(rows, {"_hit": own}).select(F.col(key).alias("object_key"), F.explode("_hit").alias("_ref"))
    # Columns may be made from fewer rows, which is all that Spark would judge their size by.
    known = ids((columns, column_id)).hint("merge")
    real = spread_join(rows, known, ["_ref"], "left_semi", spread_by=["object_key"])
    return as_issues(real, "self_reference", "column_mappings", F.col("object_key"), F.col("_ref"))


def expression_rules(df: DataFrame, expr: str, key: Column, object_type: str, must_be_predicate: bool) -> DataFrame:
    """Determinism, navigation and predicate rules of an expression column in one pass."""
    facts = with_facts(df.where(F.col(expr).isNotNull()), expr, must_be_predicate, references=False)
    return check_rows(facts, object_type, key, expression_checks(expr, must_be_predicate), wave=2)


def with_facts(df: DataFrame, expr: str, must_be_predicate: bool, references: bool = True) -> DataFrame:
    """Add `_volatile`, `_nav` and, if asked, `_refs` and `_bad`, and `_predicate`: the text is cut up once per row."""
    toks = F.col("_toks")
    facts = {"_volatile": E.volatile_tokens(toks), "_nav": E.navigation_of(toks)}
    if references:
        facts |= {"_refs": E.reference_tokens(toks), "_bad": E.badly_qualified_tokens(toks)}
    if must_be_predicate:
        facts["_predicate"] = E.predicate_of(toks)
    return compute_once(compute_once(df, {"_toks": E.tokens(F.col(expr))}), facts).drop("_toks")


def expression_checks(expr: str, must_be_predicate: bool) -> list[Check]:
    """Checks over the columns of `with_facts`; a NULL expression passes them all."""
    checks = [
        ("volatile_functions", F.size("_volatile") > 0, F.array_join("_volatile", ",")),
        ("navigation_kind", F.col("_nav").isNotNull(), F.col("_nav")),
    ]
    if must_be_predicate:
        checks.append(("is_predicate", ~F.col("_predicate"), F.col(expr)))
    return checks


def translate_expression(df: DataFrame, expr: str, key: str, deployments: DataFrame, system: str) -> DataFrame:
    """Expressions in the physical names of one system; NULL text and the missing count if it lacks a table.

    `key` must be unique. The map built per expression holds the tables of that
    one expression.
    """
    there = deployments.where(F.col("system") == system).select(
        "table_id",
        F.concat_ws(".", "physical_database_name", "physical_schema_name", "physical_table_name").alias("physical"),
    )
    base = df.select(F.col(key).alias("expr_key"), F.col(expr).alias("expr"))
    parts = compute_once(base, {"_t": E.tables_referenced(F.col("expr"))}).select(
        "expr_key", F.explode("_t").alias("table_id")
    )
    found = spread_join(parts, there, ["table_id"], "left", spread_by=["expr_key"])
    maps = found.groupBy("expr_key").agg(
        F.map_from_entries(
            F.collect_list(F.when(F.col("physical").isNotNull(), F.struct("table_id", "physical")))
        ).alias("names"),
        F.count_if(F.col("physical").isNull()).alias("n_missing"),
    )
    joined = base.join(maps, "expr_key", "left").withColumn("n_missing", F.coalesce("n_missing", F.lit(0)))
    text = F.when(F.col("names").isNull(), F.col("expr")).otherwise(E.translated(F.col("expr"), F.col("names")))
    return joined.select(
        "expr_key", F.when(F.col("n_missing") == 0, text).alias("physical_expr"), F.col("n_missing").cast("bigint").alias("n_missing")
    )
