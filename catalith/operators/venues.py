"""Where tables live: co-location checks, address lookup and relationship listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.functions.paths import is_under
from catalith.issues import as_issues
from catalith.skew import spread_join
from catalith.specs import FLIPPED_CARDINALITY


def venue_sets(deployments: DataFrame) -> DataFrame:
    """The venues of each table as rows (table_id, system), each pair once.

    Sets are kept as rows, not arrays: that is the form the joins below need,
    and a table deployed very often never becomes one huge value.
    """
    return deployments.select("table_id", "system").distinct()


def shared_venues(rels: DataFrame, a: str, b: str, rel_key: str, deployments: DataFrame) -> DataFrame:
    """(rel_key, system) for every system that holds both endpoints.

    `rel_key` must be unique. The second join also matches on the system, so
    its output is no larger than the first one's.
    """
    ends = rels.select(F.col(rel_key).alias("rel_key"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    return placed_ends(ends, deployments).select("rel_key", "system")


def placed_ends(ends: DataFrame, deployments: DataFrame) -> DataFrame:
    """The rows (rel_key, _a, _b) once for every system that holds both ends."""
    members = venue_sets(deployments)
    at_a = spread_join(ends, members.withColumnRenamed("table_id", "_a"), ["_a"], spread_by=["rel_key"])
    # No distinct on this side: a semi join needs none, and it would keep Spark from splitting a hot key.
    at_b = deployments.select(F.col("table_id").alias("_b"), "system")
    return spread_join(at_a, at_b, ["_b", "system"], "left_semi", spread_by=["rel_key"])


def pair_codeployed(
    rels: DataFrame, a: str, b: str, rel_key: str, deployments: DataFrame, tables: DataFrame
) -> DataFrame:
    """Relationships of documented tables that no single system can run."""
    documented = tables.select(F.col("table_id").alias("_t"))
    ends = rels.select(F.col(rel_key).alias("rel_key"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    for side in ("_a", "_b"):
        ends = spread_join(ends, documented.withColumnRenamed("_t", side), [side], "left_semi", spread_by=["rel_key"])
    runnable = shared_venues(ends, "_a", "_b", "rel_key", deployments).select("rel_key").distinct()
    bad = ends.join(runnable, "rel_key", "left_anti")
    return as_issues(
        bad, "pair_codeployed", "table_relationships", F.col("rel_key"), F.concat_ws(" and ", "_a", "_b")
    )


def documented_parts(exprs: DataFrame, tables_col: str, key: str, tables: DataFrame) -> DataFrame:
    """(expr_key, n_tables, table_id) per documented table of an expression.

    An expression is fully documented if it has `n_tables` rows here.
    """
    parts = exprs.select(
        F.col(key).alias("expr_key"), F.size(tables_col).alias("n_tables"), F.explode(tables_col).alias("table_id")
    )
    return spread_join(parts, tables.select("table_id"), ["table_id"], "left_semi", spread_by=["expr_key"])


def nway_codeployed(
    exprs: DataFrame, tables_col: str, key: str, deployments: DataFrame, tables: DataFrame
) -> DataFrame:
    """Expressions whose tables never meet in one system (relational division).

    `tables_col` holds distinct table ids and `key` is unique. Expressions with
    an undocumented table are reported elsewhere and skipped here.
    """
    parts = documented_parts(exprs, tables_col, key, tables)
    placed = spread_join(parts, venue_sets(deployments), ["table_id"], spread_by=["expr_key"])
    complete = (
        placed.groupBy("expr_key", "system")
        .agg(F.count(F.lit(1)).alias("_have"), F.max("n_tables").alias("_need"))
        .where(F.col("_have") == F.col("_need"))
        .select("expr_key")
        .distinct()
    )
    asked = (
        parts.groupBy("expr_key")
        .agg(F.max("n_tables").alias("n_tables"), F.count(F.lit(1)).alias("_known"))
        .where(F.col("_known") == F.col("n_tables"))
    )
    bad = asked.join(complete, "expr_key", "left_anti")
    return as_issues(
        bad, "nway_codeployed", "column_mappings", F.col("expr_key"),
        F.concat(F.col("n_tables").cast("string"), F.lit(" table(s) share no system")),
    )


def resolve_address(tables: DataFrame, deployments: DataFrame, system: str) -> DataFrame:
    """Physical names of each table in `system`, or the status `not deployed`."""
    there = deployments.where(F.col("system") == system).select(
        "table_id", "physical_database_name", "physical_schema_name", "physical_table_name"
    )
    found = tables.select("table_id").join(there, "table_id", "left")
    status = F.when(F.col("physical_table_name").isNull(), "not deployed").otherwise("ok")
    return found.withColumn("status", status)


def venue_inventory(deployments: DataFrame) -> DataFrame:
    return deployments.groupBy("system", "data_source_id").agg(F.count(F.lit(1)).alias("n_tables"))


def subtree_venues(deployments: DataFrame, top: str) -> DataFrame:
    """Systems that carry anything at or below `top`."""
    return deployments.where(is_under("table_id", top)).select("system").distinct()


def joins_in_venue(rels: DataFrame, a: str, b: str, rel_key: str, deployments: DataFrame) -> DataFrame:
    """(relationship, system) pairs that can run."""
    return shared_venues(rels, a, b, rel_key, deployments)


def relationships_of(rels: DataFrame, table_id: str) -> DataFrame:
    """Relationships that touch a table, told from that table's side.

    A self relationship appears once.
    """
    flip = F.create_map(*[F.lit(x) for pair in FLIPPED_CARDINALITY.items() for x in pair])
    keep = ["relationship_name", "join_condition"]
    forward = rels.where(F.col("table_a_id") == table_id).select(
        F.col("table_a_id").alias("table_id"), F.col("table_b_id").alias("other_table_id"), *keep, "cardinality"
    )
    backward = rels.where((F.col("table_b_id") == table_id) & (F.col("table_a_id") != table_id)).select(
        F.col("table_b_id").alias("table_id"), F.col("table_a_id").alias("other_table_id"), *keep,
        F.try_element_at(flip, F.col("cardinality")).alias("cardinality"),
    )
    return forward.union(backward)
