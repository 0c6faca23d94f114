"""File trees as DataFrames: walking, classifying and hashing."""

from __future__ import annotations

import itertools
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalith.checkpoints import stage, staging_folder
from catalith.functions import paths
from catalith.functions.binding import compute_once
from catalith.functions.text import sha256_bytes, sha256_text
from catalith.issues import as_issues

# Tasks get this module's functions by value: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTED_AT_ONCE = 10_000
# Which file names mean what, by depth.
REGISTRY_FILE = "systems.yaml"
SOURCES_FOLDER = "sources"
EXTENSION = ".yaml"
EXTENSION_VARIANTS = (".yaml", ".yml")
SOURCE_FILES = {"data_source.yaml": "data_source", "deployments.yaml": "deployments", "concepts.yaml": "concepts"}
SCHEMA_FILES = {
    "schema.yaml": "schema",
    "tables.yaml": "tables",
    "columns.yaml": "columns",
    "table_relationships.yaml": "table_relationships",
    "concepts.yaml": "concepts",
}
SCHEMA_ONLY_SHARDS = ("tables", "columns", "table_relationships")


def _folders_listed(folders: DataFrame, root: str) -> DataFrame:
    """(rel, length, is_folder): what lies directly in each of the folders `rel`, listed inside tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = pafs.FileSystem.from_uri(root)
        for batch in batches:
            for rel in batch.column(0).to_pylist():
                base = f"{top.rstrip('/')}/{rel}".rstrip("/")
                found = fs.get_file_info(pafs.FileSelector(base))
                for lo in range(0, len(found), LISTED_AT_ONCE):
                    part = found[lo : lo + LISTED_AT_ONCE]
                    yield pa.record_batch(
                        [pa.array([f"{rel}/{f.base_name}".lstrip("/") for f in part], pa.string()),
                         pa.array([f.size for f in part], pa.int64()),
                         pa.array([f.type == pafs.FileType.Directory for f in part], pa.bool_())],
                        ["rel", "length", "is_folder"],
                    )

    return folders.select("rel").mapInArrow(run, "rel string, length bigint, is_folder boolean")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file below `root` once, those of zero bytes included: rel, length.

    One round for each level of the tree; a round's folders are dealt out to tasks that list
    them, and what they find is a table before the next round. The driver sees no names. A
    single folder's names are held by one task. A missing root fails at once.
    """
    fs, top = pafs.FileSystem.from_uri(root)
    if fs.get_file_info(top).type != pafs.FileType.Directory:
        raise FileNotFoundError(f"no folder {root}")
    folder = staging_folder(spark)
    level = spark.createDataFrame([("",)], "rel string")
    found = None
    for depth in itertools.count():
        here = stage(_folders_listed(level.repartition("rel"), root), folder, f"level_{depth}")
        files = here.where("not is_folder").select("rel", "length")
        found = files if found is None else found.unionByName(files)
        level = here.where("is_folder").select("rel")
        if level.isEmpty():
            return found


def with_content(files: DataFrame, root: str) -> DataFrame:
    """Adds the bytes of each file, read inside tasks."""
    schema = T.StructType([*files.schema.fields, T.StructField("content", T.BinaryType())])
    at = files.columns.index("rel")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = pafs.FileSystem.from_uri(root)
        for batch in batches:
            # One file at a time: a batch of names may stand for a lot of bytes.
            for i, rel in enumerate(batch.column(at).to_pylist()):
                with fs.open_input_stream(f"{top.rstrip('/')}/{rel}") as f:
                    content = pa.array([f.read()], pa.binary())
                yield pa.record_batch([*batch.slice(i, 1).columns, content], [*batch.schema.names, "content"])

    return files.mapInArrow(run, schema)


def scan_files(spark: SparkSession, root: str, content: bool = True) -> DataFrame:
    """Every file below `root` once: path, rel, length, the parts of its path, and its content if wanted."""
    top = root.rstrip("/") + "/"
    found = list_files(spark, root).withColumn("path", F.concat(F.lit(top), "rel"))
    return path_parts(with_content(found, root) if content else found, "rel")


def path_parts(df: DataFrame, rel: str) -> DataFrame:
    """Add rel_parts (array), file_name, ext and stem for a relative path."""
    name = F.substring_index(rel, "/", -1)
    return df.withColumns(
        {
            "rel_parts": F.split(rel, "/"),
            "file_name": name,
            "ext": F.regexp_extract(name, r".(\.[^.]*)\z", 1),
            "stem": F.regexp_replace(name, r"(?<=.)\.[^.]*\z", ""),
        }
    )


def _pick(names: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), key)


def classify_paths(files: DataFrame, rel: str = "rel") -> DataFrame:
    """Add file_type, data_source, schema, is_shard and problem to each relative path.

    A path has either a type or a problem. Depth and names decide; labels on
    the way must be legal.
    """
    df = files if "rel_parts" in files.columns else path_parts(files, rel)
    p, name = F.col("rel_parts"), F.col("file_name")
    part = lambda i: F.get(p, F.lit(i))  # noqa: E731  part(0) is the top folder
    n = F.size(p) - 1  # labels below the sources folder
    label, second, third = part(1), part(2), part(3)
    source_type, schema_type = _pick(SOURCE_FILES, name), _pick(SCHEMA_FILES, name)
    shape = (
        F.when((n == 0) & (name == REGISTRY_FILE), F.lit("registry"))
        .when(part(0) != SOURCES_FOLDER, F.lit("!outside the sources folder"))
        .when((n >= 2) & (second == paths.RESERVED_MAPPINGS), F.lit("!mappings folder at source level"))
        .when((n == 3) & second.isin(*SCHEMA_ONLY_SHARDS), F.lit("!shard folder at source level"))
        .when((n == 2) & source_type.isNotNull(), F.lit("source"))
        .when((n == 3) & (second == "concepts"), F.lit("source_shard"))
        .when((n == 3) & schema_type.isNotNull(), F.lit("schema"))
        .when(
            (name == "concepts.yaml") & ((n < 2) | (F.element_at(p, -2) != "concepts")),
            F.lit("!concepts file at an unsupported depth"),
        )
        .when((n == 4) & third.isin(*paths.SHARD_FOLDERS), F.lit("schema_shard"))
        .when((n == 4) & (third == paths.RESERVED_MAPPINGS), F.lit("mapping"))
        .otherwise(F.lit("!unrecognised location"))
    )
    df = compute_once(df, {"_shape": shape})
    s = F.col("_shape")
    in_schema = s.isin("schema", "schema_shard", "mapping")
    has_stem = s.isin("source_shard", "schema_shard", "mapping")
    legal = lambda c: paths.label_status(c) == "ok"
    problem = (
        F.when(s.startswith("!"), F.substring(s, F.lit(2), F.length(s)))
        .when((s != "registry") & ~legal(label), F.lit("illegal source label"))
        .when(in_schema & ~legal(second), F.lit("illegal schema label"))
        .when(in_schema & second.isin(paths.RESERVED_CONCEPT, *paths.SHARD_FOLDERS), F.lit("reserved schema name"))
        .when(has_stem & ~legal(F.col("stem")), F.lit("illegal file label"))
    )
    df = compute_once(df, {"problem": problem})
    ok = F.col("problem").isNull()
    file_type = (
        F.when(s == "registry", F.lit("systems"))
        .when(s == "source", source_type)
        .when(s == "source_shard", F.lit("concepts"))
        .when(s == "schema", schema_type)
        .when(s == "schema_shard", third)
        .when(s == "mapping", F.lit("column_mappings"))
    )
    return df.withColumns(
        {
            "file_type": F.when(ok, file_type),
            "data_source": F.when(ok & (s != "registry"), label),
            "schema": F.when(ok & in_schema, second),
            "is_shard": F.coalesce(s.isin("source_shard", "schema_shard"), F.lit(False)),
        }
    ).drop("_shape")


def corpus_files(classified: DataFrame) -> DataFrame:
    return classified.where((F.col("ext") == EXTENSION) & F.col("problem").isNull())


def path_issues(classified: DataFrame) -> DataFrame:
    """Files with the right extension in the wrong place."""
    bad = classified.where((F.col("ext") == EXTENSION) & F.col("problem").isNotNull())
    return as_issues(bad, "classify_paths", "file", F.col("rel"), F.col("problem"), wave=1)


def wrong_extension(files: DataFrame, rel: str = "rel") -> DataFrame:
    """Files that would be read if their extension were spelled right.

    Left alone they would count as absent, and their rows would be deleted.
    """
    parts = files if "ext" in files.columns else path_parts(files, rel)
    odd = parts.where(F.lower("ext").isin(*EXTENSION_VARIANTS) & (F.col("ext") != EXTENSION))
    fixed = F.concat(F.regexp_replace(rel, r"\.[^.]*\z", ""), F.lit(EXTENSION))
    renamed = odd.select(F.col(rel).alias("_found"), fixed.alias("rel"))
    would = classify_paths(renamed).where(F.col("problem").isNull())
    return as_issues(would, "wrong_extension", "file", F.col("_found"), F.col("file_name"), wave=1)


def shard_form_conflict(classified: DataFrame) -> DataFrame:
    """A type authored both as one file and as a folder of shards in the same place."""
    scope = ["file_type", "data_source", "schema"]
    both = (
        classified.where(F.col("file_type").isin(*paths.SHARD_FOLDERS))
        .groupBy(*scope)
        .agg(F.bool_or("is_shard").alias("_folder"), F.bool_or(~F.col("is_shard")).alias("_single"))
        .where(F.col("_folder") & F.col("_single"))
    )
    place = F.concat_ws("/", "data_source", "schema", "file_type")
    return as_issues(both, "shard_form_conflict", "file", place, F.col("file_type"), wave=1)


def content_hash(files: DataFrame, content: str = "content", normalise_newlines: bool = False) -> DataFrame:
    """SHA-256 of the bytes, or of the text with every line ending as a line feed."""
    value = F.col(content)
    if normalise_newlines:
        text = F.decode(value, "UTF-8") if dict(files.dtypes)[content] == "binary" else value
        return files.withColumn("sha256", sha256_text(text))
    return files.withColumn("sha256", sha256_bytes(value))
