"""Data contracts for delivered CSV tables.

Delivered rows: table, line_no, cells (array of text), header (array of text).
Live columns:   table, ordinal (0-based), name, type, nullable, is_pk.
Documented:     table, schema, name, type, nullable, is_pk.
Files:          path, schema (folder), table (stem).
Rules on cells, and all rules together, are in `code_sets`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.cells import TYPE_VOCABULARY
from catalith.issues import as_issues, key_text, union_issues
from catalith.operators.keys import later_occurrences

# Fixed value: the row limit of a curated table.
MAX_ROWS_PER_TABLE = 1000


def header_equals(headers: DataFrame, live: DataFrame) -> DataFrame:
    """The header must equal the live columns in order; one issue per table.

    Compared position by position, so no column list is gathered in one place.
    """
    asked = headers.select("table", F.posexplode("header").alias("ordinal", "cell"))
    known = live.join(headers.select("table").distinct(), "table", "left_semi").select("table", "ordinal", "name")
    both = asked.join(known, ["table", "ordinal"], "full_outer")
    wrong = both.where(~F.col("cell").eqNullSafe(F.col("name")))
    per_table = wrong.groupBy("table").agg(F.min("ordinal").alias("at"), F.count(F.lit(1)).alias("n"))
    return as_issues(
        per_table, "header_equals", "contract", F.col("table"),
        F.concat(F.col("n").cast("string"), F.lit(" differ from position "), F.col("at").cast("string")), wave=1,
    )


def docs_gate(headers: DataFrame, docs: DataFrame) -> DataFrame:
    """Header cells and documented columns are the same multiset; order is free. One issue per column."""
    cells = headers.select("table", F.explode("header").alias("name"))
    documented = docs.select("table", "name")
    # Cells and columns are made from arrays: Spark sees only the rows these came from, and must not broadcast them.
    known_tables = docs.select("table").distinct().hint("merge")
    undocumented_table = headers.select("table").distinct().join(known_tables, "table", "left_anti")
    checked = cells.join(known_tables, "table", "left_semi")
    repeated = checked.groupBy("table", "name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    undocumented = checked.distinct().join(documented.hint("merge"), ["table", "name"], "left_anti")
    delivered = headers.select("table").distinct()
    absent = documented.distinct().join(delivered.hint("merge"), "table", "left_semi").join(
        cells.distinct().hint("merge"), ["table", "name"], "left_anti"
    )
    key = F.col("table")

    def issue(df: DataFrame, what: str) -> DataFrame:
        name = F.col("name") if "name" in df.columns else F.lit("")
        return as_issues(df, "docs_gate", "contract", key, F.concat(F.lit(what + ":"), name), wave=1)

    return union_issues(
        issue(undocumented_table, "undocumented table"),
        issue(repeated, "repeated"),
        issue(undocumented, "undocumented"),
        issue(absent, "documented but absent"),
    )


def row_guardrail(rows: DataFrame, max_rows: int = MAX_ROWS_PER_TABLE) -> DataFrame:
    many = rows.groupBy("table").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_rows)
    return as_issues(many, "row_guardrail", "contract", F.col("table"), F.col("n").cast("string"), wave=1)


def key_required(spec: DataFrame) -> DataFrame:
    """Tables none of whose columns is a key."""
    keyless = spec.groupBy("table").agg(F.bool_or("is_pk").alias("has_key")).where(~F.col("has_key"))
    return as_issues(keyless, "key_required", "contract", F.col("table"), F.lit("no key column"), wave=1)


def line_key() -> Column:
    return key_text("table", "line_no")


def is_ragged() -> Column:
    return F.size("cells") != F.size("header")


def ragged_rows(rows: DataFrame) -> DataFrame:
    bad = rows.where(is_ragged())
    detail = F.concat_ws(" of ", F.size("cells").cast("string"), F.size("header").cast("string"))
    return as_issues(bad, "ragged_rows", "contract", line_key(), detail, wave=1)


def type_vocabulary(docs: DataFrame) -> DataFrame:
    bad = docs.where(~F.col("type").isin(*TYPE_VOCABULARY))
    return as_issues(bad, "type_vocabulary", "contract", key_text("table", "name"), F.col("type"), wave=1)


def missing_backing(live: DataFrame, docs: DataFrame, files: DataFrame, not_code_sets: tuple[str, ...] = ()) -> DataFrame:
    """Live and documented tables for which no file was delivered."""
    delivered = files.select("table")

    def gone(df: DataFrame, what: str) -> DataFrame:
        lost = df.select("table").distinct().join(delivered, "table", "left_anti")
        return as_issues(lost, "missing_backing", "contract", F.col("table"), F.lit(what), wave=1)

    code_sets = live.where(~F.col("table").isin(*not_code_sets))
    return gone(code_sets, "live table without file").unionByName(gone(docs, "documented table without file"))


def folder_alignment(files: DataFrame, docs: DataFrame) -> DataFrame:
    """A file lies in the folder of its table's documented schema."""
    home = docs.select("table", F.col("schema").alias("_home")).distinct()
    bad = files.join(home, "table").where(F.col("schema") != F.col("_home"))
    return as_issues(bad, "folder_alignment", "contract", F.col("path"), F.col("_home"), wave=1)


def duplicate_stem(files: DataFrame) -> DataFrame:
    """Table names delivered from more than one place; every later path names the first."""
    later = later_occurrences(files.select("table", "path"), ["table"], ["path"])
    return as_issues(later, "duplicate_stem", "contract", F.col("path"), F.col("first_place.path"), wave=1)


def unknown_table(files: DataFrame, live: DataFrame) -> DataFrame:
    bad = files.join(live.select("table").distinct(), "table", "left_anti")
    return as_issues(bad, "unknown_table", "contract", F.col("path"), F.col("table"), wave=1)


def apply_exemptions(issues: DataFrame, exemptions: DataFrame) -> DataFrame:
    """Add `severity`: an issue whose (rule, object) is exempted is only a warning.

    `exemptions` carries rule and object_key.
    """
    known = exemptions.select("rule", "object_key", F.lit("warning").alias("severity")).distinct()
    return issues.join(known, ["rule", "object_key"], "left").select(
        *issues.columns, F.coalesce("severity", F.lit("error")).alias("severity")
    )


def unused_exemptions(exemptions: DataFrame, matchable: DataFrame, on: list[str]) -> DataFrame:
    """Exemptions that changed nothing: usually a typo or a leftover."""
    return exemptions.join(matchable.select(*on).distinct(), on, "left_anti").distinct()


def freshness(files: DataFrame, ledger: DataFrame, live: DataFrame) -> DataFrame:
    """Per file: missing table / never loaded / stale / current, judged by its latest ledger row.

    files: table, sha256. ledger: table, csv_sha256, loaded_ts, audit_id.
    The latest row is a max over a struct, combined map-side, not a sort per table.
    """
    latest = ledger.groupBy("table").agg(F.max_by("csv_sha256", F.struct("loaded_ts", "audit_id")).alias("_last"))
    there = live.select("table", F.lit(True).alias("_live")).distinct()
    joined = files.select("table", "sha256").join(there, "table", "left").join(latest, "table", "left")
    status = (
        F.when(F.col("_live").isNull(), "missing table")
        .when(F.col("_last").isNull(), "never loaded")
        .when(F.col("_last") != F.col("sha256"), "stale")
        .otherwise("current")
    )
    return joined.select("table", status.alias("status"))


def manifest_reconcile(manifest: DataFrame, ledger: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Versioned files against the ledger of applied ones: (version, status).

    Versions count as numbers, so '1' and '0001' are one version, and having
    both is an error. manifest and ledger: version, checksum. allowed: version.
    """
    number = F.col("version").cast("bigint").alias("version_no")
    found = manifest.groupBy(number).agg(
        F.count(F.lit(1)).alias("n_files"), F.min("checksum").alias("file_checksum")
    )
    applied = ledger.groupBy(number).agg(F.min("checksum").alias("applied_checksum"))
    joined = found.join(applied, "version_no", "full_outer")
    if allowed is None:
        pending = F.lit("pending")
    else:
        joined = joined.join(allowed.select(number, F.lit(True).alias("_ok")).distinct(), "version_no", "left")
        pending = F.when(F.col("_ok"), "pending, allowed").otherwise("pending")
    status = (
        F.when(F.col("n_files") > 1, "duplicate version")
        .when(F.col("n_files").isNull(), "applied but absent")
        .when(F.col("applied_checksum").isNull(), pending)
        .when(F.col("applied_checksum") != F.col("file_checksum"), "checksum changed")
        .otherwise("in sync")
    )
    return joined.select("version_no", status.alias("status"))
