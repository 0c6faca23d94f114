"""Delivered CSV tables: `<root>/<schema>/<table>.csv`, every cell as text.

These are curated sets, a few hundred rows each, so one task reads one file
with the standard CSV reader: exact cells of ragged rows, quoted line breaks
and line numbers all survive. Many files spread over many tasks.
"""

from __future__ import annotations

import csv
import hashlib
import io
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.issues import as_issues, union_issues
from catalith.operators.contract import duplicate_stem
from catalith.sources.files import scan_files

# Tasks get this module's functions by value: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUFFIX = ".csv"
CELL_SCHEMA = (
    "path string, schema string, table string, sha256 string, line_no int, cells array<string>,"
    " header array<string>, error string"
)


def delivered_files(spark: SparkSession, root: str) -> DataFrame:
    """Files below the root with their folder (`schema`) and stem (`table`)."""
    files = scan_files(spark, root).withColumn("depth", F.size("rel_parts"))
    return files.select(
        "rel", "ext", "depth", "content",
        F.col("rel").alias("path"), F.get("rel_parts", F.lit(0)).alias("schema"), F.col("stem").alias("table"),
    )


def readable(files: DataFrame, schemas: DataFrame) -> DataFrame:
    """Files in the one right place: a documented schema's folder, lower-case extension."""
    ok = files.where((F.col("ext") == SUFFIX) & (F.col("depth") == 2))
    return ok.join(schemas.select("schema").distinct(), "schema", "left_semi")


def placement_issues(files: DataFrame, schemas: DataFrame) -> DataFrame:
    """CSV files that are misplaced, misnamed or delivered twice, and a delivery without any file."""
    is_csv = F.lower("ext") == SUFFIX
    known = schemas.select("schema").distinct().withColumn("_known", F.lit(True))
    judged = files.where(is_csv).join(known, "schema", "left")
    reason = (
        F.when(F.col("depth") == 1, "not in a schema folder")
        .when(F.col("_known").isNull(), "unknown folder")
        .when(F.col("ext") != SUFFIX, "extension not in lower case")
        .when(F.col("depth") > 2, "nested too deep")
    )
    bad = judged.withColumn("reason", reason).where(F.col("reason").isNotNull())
    good = readable(files, schemas)
    none = good.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 0)
    return union_issues(
        as_issues(bad, "csv_placement", "file", F.col("path"), F.col("reason"), wave=1),
        duplicate_stem(good),
        as_issues(none, "csv_placement", "file", F.lit(""), F.lit("no CSV file at all"), wave=1),
    )


def read_csv_bytes(content: bytes) -> tuple[list[str], list[list[str]]]:
    """Header and rows; a byte-order mark is dropped. ValueError if there is no table in it."""
    try:
        text = bytes(content).decode("utf-8-sig")
        rows = list(csv.reader(io.StringIO(text, newline="")))
    except (UnicodeDecodeError, csv.Error) as e:
        raise ValueError(f"unreadable: {type(e).__name__}") from e
    if not rows:
        raise ValueError("empty file")
    return rows[0], rows[1:]


def scan_contract_csv(files: DataFrame) -> DataFrame:
    """Cells of every data row. The header is line 1; a file without rows gives one row with line 1.

    The hash is of the very bytes that were parsed.
    """
    picked = files.select("path", "schema", "table", "content")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["path", "schema", "table", "sha256", "line_no", "cells", "header", "error"]
        for batch in batches:
            out = []
            for path, schema, table, content in batch.itertuples(index=False):
                digest = hashlib.sha256(bytes(content)).hexdigest()
                try:
                    header, rows = read_csv_bytes(content)
                except ValueError as e:
                    out.append((path, schema, table, digest, 0, None, None, str(e)))
                    continue
                out.append((path, schema, table, digest, 1, header, header, None))
                out += [(path, schema, table, digest, i, row, header, None) for i, row in enumerate(rows, start=2)]
            yield pd.DataFrame(out, columns=columns)

    return picked.mapInPandas(parse, CELL_SCHEMA)


def headers_of(cells: DataFrame) -> DataFrame:
    return cells.where(F.col("line_no") == 1).select("path", "schema", "table", "sha256", "header")


def rows_of(cells: DataFrame) -> DataFrame:
    return cells.where(F.col("line_no") > 1).select("table", "line_no", "cells", "header")


def read_issues(cells: DataFrame) -> DataFrame:
    bad = cells.where(F.col("error").isNotNull())
    return as_issues(bad, "csv_read", "file", F.col("path"), F.col("error"), wave=1)
