"""The documented columns of delivered tables, gathered from the authored rows of files and shards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder
from catalith.functions.binding import compute_once
from catalith.issues import as_issues, key_text, union_issues
from catalith.sources import documents, files

# The file that documents columns, and the folder of its shards.
COLUMNS_FILE, SHARD_FOLDER, KIND = "columns.yaml", "columns", "columns"
# What a row must state, and of what kind; what it may state.
REQUIRED = {"table_name": "text", "column_name": "text", "data_type": "text", "is_nullable": "bool"}
OPTIONAL = {"is_primary_key": "bool"}


def column_files(found: DataFrame) -> DataFrame:
    """Files that document columns, each once: at any depth, by name or as a shard; `schema` is the top folder, if any."""
    parts = F.col("rel_parts")
    shard = (F.element_at(parts, -1).rlike(r"\.yaml\z")) & (F.size(parts) > 1) & (F.try_element_at(parts, F.lit(-2)) == SHARD_FOLDER)
    wanted = found.where((F.col("file_name") == COLUMNS_FILE) | shard)
    home = F.when(F.size(parts) > 1, F.get(parts, F.lit(0)))
    return wanted.withColumns({"schema": home, "file_type": F.lit(KIND), "data_source": F.lit(None).cast("string")})


def documented_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documentation, issues) of authored rows (rel, schema, row_no, body, kinds, error).

    Documentation: path, schema, table, name, type, nullable, is_pk, place. A row that could
    not be read, lacks a field or has one of another kind is an issue and documents nothing,
    like a row outside a schema folder. Its siblings stand.
    """
    kind = lambda k: F.try_element_at("kinds", F.lit(k))
    text = lambda k: F.try_element_at("body", F.lit(k))
    wrong = [F.when(~kind(k).eqNullSafe(F.lit(want)), F.lit(k)) for k, want in REQUIRED.items()]
    wrong += [F.when(kind(k).isNotNull() & (kind(k) != want), F.lit(k)) for k, want in OPTIONAL.items()]
    problem = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.size("_wrong") > 0, F.concat(F.lit("malformed: "), F.array_join("_wrong", ", ")))
        .when(F.col("schema").isNull(), F.lit("outside a schema folder"))
    )
    judged = compute_once(rows, {"_wrong": F.array_compact(F.array(*wrong))}).withColumn("_problem", problem)
    key = F.concat_ws("#", "rel", F.col("row_no").cast("string"))
    issues = as_issues(judged.where(F.col("_problem").isNotNull()), "documented_rows", "docs", key, F.col("_problem"), wave=1)
    good = judged.where(F.col("_problem").isNull()).select(
        F.col("rel").alias("path"), "schema", text("table_name").alias("table"), text("column_name").alias("name"),
        text("data_type").alias("type"), (text("is_nullable") == "true").alias("nullable"),
        F.coalesce(text("is_primary_key") == "true", F.lit(False)).alias("is_pk"), F.col("row_no").alias("place"),
    )
    return good, issues


def documented_columns(parts: list[DataFrame]) -> DataFrame:
    """Union of single-file and shard rows; a row reached by two readers counts once.

    Rows carry path, schema, table and name (and type, nullable, is_pk, place in the file).
    """
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    place = ["place"] if "place" in rows.columns else []
    return rows.dropDuplicates(["path", "table", "name", *place])


def documentation_issues(docs: DataFrame) -> DataFrame:
    """Columns documented twice, tables in two schemas, and rows outside a schema folder."""
    twice = docs.groupBy("table", "name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    homes = docs.groupBy("table").agg(F.min("schema").alias("low"), F.max("schema").alias("high"))
    return union_issues(
        as_issues(twice, "duplicate_column", "docs", key_text("table", "name"), F.col("n"), wave=1),
        as_issues(
            homes.where(F.col("low") != F.col("high")), "table_in_two_schemas", "docs", F.col("table"),
            F.concat_ws(",", "low", "high"), wave=1,
        ),
        as_issues(docs.where(F.col("schema").isNull()), "docs_outside_schema", "docs", key_text("table", "name"), F.col("path"), wave=1),
    )


def read_documentation(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(documentation, all issues) of the corpus folder of one source. A missing folder fails at once."""
    found = files.scan_files(spark, root, content=False)
    # Only the files that document columns are read.
    picked = files.with_content(column_files(found).select("rel", "file_type", "data_source", "schema"), root)
    rows = stage(documents.read_documents(picked), staging_folder(spark), "documents")
    good, malformed = documented_rows(rows)
    docs = documented_columns([good])
    return docs, malformed.unionByName(documentation_issues(docs))
