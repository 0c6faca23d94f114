"""The load of curated code sets as one job: scan, read, route, judge, reload, ledger.

Everything is judged before anything is written, and a single error refuses the whole
delivery. A dry run judges only, and only it may carry exemptions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder
from catalith.issues import ISSUE_SCHEMA
from catalith.operators import code_sets as K
from catalith.operators.contract import MAX_ROWS_PER_TABLE
from catalith.sources import contract_csv
from catalith.sources.code_sets import CodeSets, shapes_of


@dataclass(frozen=True)
class CodeSetLoad:
    """issues: with severity. routes: one row per table. unused: exemptions that changed nothing. load_id: None if nothing was written."""

    issues: DataFrame
    routes: DataFrame
    unused: DataFrame
    load_id: int | None


def load_delivery(
    store: CodeSets,
    files: DataFrame,
    headers: DataFrame,
    rows: DataFrame,
    live: DataFrame,
    docs: DataFrame,
    run_ts: str,
    exemptions: DataFrame | None = None,
    dry_run: bool = False,
    max_rows: int = MAX_ROWS_PER_TABLE,
    other_issues: DataFrame | None = None,
) -> CodeSetLoad:
    """Judge a delivery and, unless it is a dry run or refused, publish it.

    `other_issues` were found while reading it. headers also carry the file's sha256.
    """
    spark = store.spark
    if exemptions is None:
        exemptions = spark.createDataFrame([], "kind string, table string")
    elif not dry_run and not exemptions.isEmpty():
        raise K.ExemptionsNeedDryRun("exemptions hold on dry runs only")
    folder = staging_folder(spark)
    routes = stage(K.table_hits(K.routing(files, headers, live, docs, exemptions)), folder, "routes")
    issues = K.validate(files, headers, rows, live, docs, exemptions, dry_run, max_rows, routes)
    if other_issues is not None:
        issues = issues.unionByName(other_issues.select(*ISSUE_SCHEMA.names).withColumn("severity", F.lit("error")))
    issues = stage(issues, folder, "issues")
    unused = K.unused(exemptions, routes)
    if dry_run or not issues.where("severity = 'error'").isEmpty():
        return CodeSetLoad(issues, routes, unused, None)
    tables = [r["table"] for r in routes.where("route = 'live'").select("table").collect()]  # one name per table
    load_id = store.reload(rows, headers, shapes_of(live, tables), run_ts)
    return CodeSetLoad(issues, routes, unused, load_id)


def load_files(store: CodeSets, files: DataFrame, live: DataFrame, docs: DataFrame, run_ts: str, **options) -> CodeSetLoad:
    """The same from scanned CSV files (`contract_csv.contract_files`), each read once."""
    folder = staging_folder(store.spark)
    schemas = docs.select("schema").distinct()
    readable = contract_csv.readable(files, schemas)
    cells = stage(contract_csv.scan_contract_csv(readable), folder, "cells")
    found = contract_csv.placement_issues(files, schemas).unionByName(contract_csv.read_issues(cells))
    # Files in two places under one name are told of by the rules themselves.
    found = found.where("rule <> 'duplicate_stem'")
    listed = cells.select("path", "schema", "table").distinct()
    headers = contract_csv.headers_of(cells)
    rows = contract_csv.rows_of(cells)
    return load_delivery(store, listed, headers, rows, live, docs, run_ts, other_issues=found, **options)
