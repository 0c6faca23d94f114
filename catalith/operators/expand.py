"""Sparse placement entries -> explicit (table, system) rows.

Entries: data_source_id, system, database_name, schemas
(`map<schema, struct<name, tables: map<table, physical>>>`; NULL = everything).
Tables: table_id, data_source_id, schema_name, table_name.
Schemas: data_source_id, schema_name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.functions.paths import label_status
from catalith.issues import key_text
from catalith.skew import spread_join

SOURCE, SCHEMA, TABLE = "data_source_id", "schema_name", "table_name"
SCOPED = ("rule", SOURCE, "system", SCHEMA, TABLE)


def _rows(df: DataFrame, schema: str, table: str) -> DataFrame:
    return df.select(
        "table_id",
        "system",
        SOURCE,
        F.coalesce("database_name", SOURCE).alias("physical_database_name"),
        F.col(schema).alias("physical_schema_name"),
        F.col(table).alias("physical_table_name"),
    )


def expand_bare(entries: DataFrame, tables: DataFrame) -> DataFrame:
    """No map: every documented table under its own names."""
    bare = entries.where(F.col("schemas").isNull()).select(SOURCE, "system", "database_name")
    return _rows(spread_join(tables, bare, [SOURCE], spread_by=["table_id"]), SCHEMA, TABLE)


def schema_requests(entries: DataFrame) -> DataFrame:
    """One row per (entry, schema key), with the wanted physical schema and the table map."""
    return (
        entries.where(F.col("schemas").isNotNull())
        .select(SOURCE, "system", "database_name", F.explode("schemas").alias(SCHEMA, "_want"))
        .select(
            SOURCE, "system", "database_name", SCHEMA,
            F.coalesce("_want.name", SCHEMA).alias("physical_schema"),
            F.col("_want.tables").alias("table_map"),
        )
    )


def table_requests(entries: DataFrame) -> DataFrame:
    """One row per table listed in an exhaustive map."""
    return (
        schema_requests(entries)
        .where(F.col("table_map").isNotNull())
        .select(
            SOURCE, "system", "database_name", SCHEMA, "physical_schema",
            F.explode("table_map").alias(TABLE, "physical_table"),
        )
    )


def expand_schema_rename(entries: DataFrame, tables: DataFrame) -> DataFrame:
    """A schema named without a table map: all its tables, the schema renamed."""
    wanted = schema_requests(entries).where(F.col("table_map").isNull()).drop("table_map")
    joined = spread_join(tables, wanted, [SOURCE, SCHEMA], spread_by=["table_id"])
    return _rows(joined, "physical_schema", TABLE)


def expand_exhaustive_map(entries: DataFrame, tables: DataFrame) -> DataFrame:
    """A table map keeps only the listed tables, under the listed names."""
    wanted = table_requests(entries)
    ok = label_status("physical_table") == "ok"
    joined = spread_join(wanted.where(ok), tables, [SOURCE, SCHEMA, TABLE], spread_by=["system"])
    return _rows(joined, "physical_schema", "physical_table")


def expand_deployments(entries: DataFrame, tables: DataFrame) -> DataFrame:
    return (
        expand_bare(entries, tables)
        .unionByName(expand_schema_rename(entries, tables))
        .unionByName(expand_exhaustive_map(entries, tables))
    )


def _scoped(df: DataFrame, rule: str) -> DataFrame:
    for c in (SCHEMA, TABLE):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df.withColumn("rule", F.lit(rule)).select(*SCOPED)


def zero_expansion(entries: DataFrame, tables: DataFrame, schemas: DataFrame) -> DataFrame:
    """Entries, schema keys and table maps that cannot yield a single row (scoped rows)."""
    bare = entries.where(F.col("schemas").isNull())
    empty_source = spread_join(bare.select(SOURCE, "system"), tables.select(SOURCE), [SOURCE], "left_anti")
    empty_map = entries.where(F.size("schemas") == 0)
    asked = schema_requests(entries)
    known = asked.select(SOURCE, "system", SCHEMA, "table_map").join(schemas, [SOURCE, SCHEMA], "left_semi")
    empty_schema = known.where(F.col("table_map").isNull()).drop("table_map").join(
        tables.select(SOURCE, SCHEMA), [SOURCE, SCHEMA], "left_anti"
    )
    empty_tables = known.where(F.size("table_map") == 0)
    return (
        _scoped(empty_source, "zero_entry")
        .union(_scoped(empty_map, "empty_schemas_map"))
        .union(_scoped(empty_schema, "zero_schema"))
        .union(_scoped(empty_tables, "empty_tables_map"))
    )


def documented_exists(entries: DataFrame, tables: DataFrame, schemas: DataFrame) -> DataFrame:
    """Schema and table keys of the maps that are not documented (scoped rows).

    A table key with an unusable physical name is reported by `physical_names`
    alone.
    """
    asked = schema_requests(entries).select(SOURCE, "system", SCHEMA)
    unknown_schema = spread_join(asked, schemas, [SOURCE, SCHEMA], "left_anti", spread_by=["system"])
    wanted = table_requests(entries).where(label_status("physical_table") == "ok")
    wanted = wanted.join(schemas, [SOURCE, SCHEMA], "left_semi").select(SOURCE, "system", SCHEMA, TABLE)
    unknown_table = spread_join(
        wanted, tables.select(SOURCE, SCHEMA, TABLE), [SOURCE, SCHEMA, TABLE], "left_anti", spread_by=["system"]
    )
    return _scoped(unknown_schema, "unknown_schema").union(_scoped(unknown_table, "unknown_table"))


def physical_names(entries: DataFrame) -> DataFrame:
    """Physical database, schema and table names that are not legal labels (scoped rows)."""

    def illegal(col: str):
        return label_status(col) != "ok"

    databases = entries.where(F.col("database_name").isNotNull() & illegal("database_name"))
    asked = schema_requests(entries)
    return (
        _scoped(databases, "physical_database_name")
        .union(_scoped(asked.where(illegal("physical_schema")), "physical_schema_name"))
        .union(_scoped(table_requests(entries).where(illegal("physical_table")), "physical_table_name"))
    )


def deploys_nowhere(sources: DataFrame, deployments: DataFrame, entries: DataFrame, tables: DataFrame) -> DataFrame:
    """Sources without a single deployment row, with the likelier of two causes."""
    lost = sources.select(SOURCE).join(deployments.select(SOURCE).distinct(), SOURCE, "left_anti")
    has_entry = entries.select(SOURCE).distinct().withColumn("_entry", F.lit(True))
    has_table = tables.select(SOURCE).distinct().withColumn("_table", F.lit(True))
    seen = lost.join(has_entry, SOURCE, "left").join(has_table, SOURCE, "left")
    cause = F.when(F.col("_entry") & F.col("_table").isNull(), "no documented tables").otherwise("no usable entry")
    return seen.select(SOURCE, cause.alias("cause"))


def suppress_cascade(
    scoped: DataFrame, rejected_schemas: DataFrame, rejected_tables: DataFrame, broken_files: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Drop scoped issues whose only cause is a row already rejected: one defect, one issue.

    Rejections carry data_source_id and schema_name (and table_name). Returns
    the issues kept and the sources that had one dropped. Physical-name issues
    are never dropped.
    """
    schema_id = key_text(SOURCE, SCHEMA)
    table_id = key_text(SOURCE, SCHEMA, TABLE)

    def cause(df, kind, key):
        return df.select(F.concat(F.lit(kind + ":"), key).alias("_cause"))

    causes = cause(rejected_schemas, "schema", schema_id)
    for df in (broken_files, rejected_tables):
        causes = causes.union(cause(df, "reduced", schema_id))
    causes = causes.union(cause(broken_files, "broken", schema_id)).union(cause(rejected_tables, "table", table_id))
    for df in (rejected_schemas, rejected_tables, broken_files):
        causes = causes.union(cause(df, "any", F.col(SOURCE)))

    rule = F.col("rule")
    first = (
        F.when(rule == "unknown_table", F.concat(F.lit("table:"), table_id))
        .when(rule == "unknown_schema", F.concat(F.lit("schema:"), schema_id))
        .when(rule == "zero_schema", F.concat(F.lit("reduced:"), schema_id))
        .when(rule == "zero_entry", F.concat(F.lit("any:"), F.col(SOURCE)))
    )
    second = F.when(rule == "unknown_table", F.concat(F.lit("broken:"), schema_id)).when(
        rule == "unknown_schema", F.concat(F.lit("reduced:"), schema_id)
    )
    marked = scoped.withColumns({"_one": first, "_two": second})
    # Semi and anti joins need no distinct causes and leave hot keys, NULL among them, to adaptive execution.
    def met(df: DataFrame, col: str, how: str) -> DataFrame:
        return spread_join(df, causes.withColumnRenamed("_cause", col), [col], how)

    spared = met(marked, "_one", "left_anti")
    kept = met(spared, "_two", "left_anti")
    dropped = met(marked, "_one", "left_semi").select(SOURCE).union(met(spared, "_two", "left_semi").select(SOURCE))
    return kept.select(*SCOPED), dropped.distinct()


def scoped_issues(scoped: DataFrame, wave: int = 1) -> DataFrame:
    """Scoped rows in the shared issue shape."""
    return scoped.select(
        F.lit(wave).alias("wave"), "rule", F.lit("deployments").alias("object_type"),
        key_text(SOURCE, "system").alias("object_key"), key_text(SCHEMA, TABLE).alias("detail"),
        F.lit(None).cast("string").alias("hint"),
    )


def inventory_index(schemas: DataFrame, tables: DataFrame) -> DataFrame:
    """Documented tables per source and schema, empty schemas included."""
    counts = tables.groupBy(SOURCE, SCHEMA).agg(F.count(F.lit(1)).alias("n_tables"))
    return schemas.select(SOURCE, SCHEMA).join(counts, [SOURCE, SCHEMA], "left").fillna(0, ["n_tables"])
