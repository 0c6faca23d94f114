"""Which shape each delivered code set is judged by, and all its rules in one pass over the rows.

A routing table has one row per table name that any side knows. It says whether the
table is judged by its live columns or by its documented ones, and what is wrong before
any cell is read. The judging columns, aligned with the file's header, are part of that
row; a single join brings them to the data rows, where all rules of a row become one
array of hits. Widths of tables are the only thing gathered in a value.

An exemption names a table and one of three kinds, and holds on dry runs only:

* `missing_table`: the table is not live yet. Its file is judged by the documentation.
* `reshaped_table`: the live columns are out of date. Judged by the documentation.
* `dropped_table`: live, but without a file. Only a warning.

Inputs. files: path, schema, table. headers: table, header. rows: table, line_no, cells.
live: table, ordinal, name, type, nullable, is_pk. docs: table, schema, name, type,
nullable, is_pk. exemptions: kind, table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.binding import compute_once, let
from catalith.functions.cells import TYPE_VOCABULARY, cell_problem
from catalith.issues import as_issues, key_text, union_issues
from catalith.operators.contract import MAX_ROWS_PER_TABLE, duplicate_stem, folder_alignment
from catalith.operators.keys import later_occurrences
from catalith.skew import counted_hot_keys, spread_join

# The kinds of exemption.
MISSING, RESHAPED, DROPPED = "missing_table", "reshaped_table", "dropped_table"
SPEC = "array<struct<name:string,type:string,nullable:boolean,is_pk:boolean>>"
HIT = "array<struct<rule:string,detail:string>>"


class ExemptionsNeedDryRun(ValueError):
    """Exemptions were asked for on a real load."""


def _columns(rows: DataFrame, order: str, into: str) -> DataFrame:
    """(table, into): the declared columns of each table, in order."""
    wanted = ["name", "type", "nullable", "is_pk"]
    gathered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_at"), *wanted)))
    listed = rows.groupBy("table").agg(gathered.alias("_all"))
    return listed.select("table", F.transform("_all", lambda c: F.struct(*[c[w].alias(w) for w in wanted])).alias(into))


def routing(files: DataFrame, headers: DataFrame, live: DataFrame, docs: DataFrame, exemptions: DataFrame) -> DataFrame:
    """One row per table: route, header, live and documented columns, and the columns it is judged by (`spec`).

    route: `live`, `docs`, `unknown` (delivered, but neither live nor exempted), `undelivered`.
    Of several headers of one table (its file lies in several places, which is an issue of
    its own) the smallest counts.
    """
    kinds = exemptions.groupBy("table").agg(F.collect_set("kind").alias("exempt"))  # three kinds
    sides = [
        files.groupBy("table").agg(F.lit(True).alias("delivered")),
        headers.groupBy("table").agg(F.min("header").alias("header")),
        _columns(live, "ordinal", "live_columns"),
        _columns(docs, "name", "doc_columns"),
        kinds,
    ]
    rows = reduce(lambda a, b: a.join(b, "table", "full_outer"), sides)
    exempt = lambda kind: F.coalesce(F.array_contains("exempt", kind), F.lit(False))
    there, is_live = F.coalesce("delivered", F.lit(False)), F.col("live_columns").isNotNull()
    route = (
        F.when(~there, "undelivered")
        .when(is_live & ~exempt(RESHAPED), "live")
        .when(is_live | exempt(MISSING), "docs")
        .otherwise("unknown")
    )
    rows = compute_once(rows, {"route": route})
    rows = rows.withColumns(
        {
            "by": F.when(F.col("route") == "live", F.col("live_columns")).when(F.col("route") == "docs", F.col("doc_columns")),
            # What each exemption changed here: one that changed nothing is a typo or a leftover.
            "used": F.array_compact(
                F.array(
                    F.when((F.col("route") == "docs") & ~is_live, F.lit(MISSING)),
                    F.when((F.col("route") == "docs") & is_live, F.lit(RESHAPED)),
                    F.when((F.col("route") == "undelivered") & is_live & exempt(DROPPED), F.lit(DROPPED)),
                )
            ),
        }
    )
    # A header cell that names no column is judged as text that may be empty.
    other = F.struct(
        F.lit(None).cast("string").alias("name"), F.lit("text").alias("type"), F.lit(True).alias("nullable"), F.lit(False).alias("is_pk")
    )
    spec = F.transform("header", lambda h: F.coalesce(F.get(F.filter("by", lambda c: c["name"] == h), F.lit(0)), other))
    return rows.withColumn("spec", spec.cast(SPEC))


def _hit(rule: str, detail: Column) -> Column:
    return F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


def _names(columns: str) -> Column:
    return F.transform(columns, lambda c: c["name"])


def table_hits(routes: DataFrame) -> DataFrame:
    """Adds `hits` (what is wrong with a table as such) and `checks`: all, some (alignment failed), or none."""
    header, live_names, doc_names = F.col("header"), _names("live_columns"), _names("doc_columns")
    longest = F.greatest(F.size(header), F.size(live_names))
    places = F.when(longest > 0, F.sequence(F.lit(0), longest - 1)).otherwise(F.array().cast("array<int>"))
    differ = F.filter(places, lambda i: ~F.get(header, i).eqNullSafe(F.get(live_names, i)))
    judged = F.col("route").isin("live", "docs") & header.isNotNull()
    rows = compute_once(routes, {"_differ": F.when(judged & (F.col("route") == "live"), differ)})

    wrong_header = F.size("_differ") > 0
    header_hit = F.when(
        wrong_header,
        _hit("header_equals", F.concat(F.size("_differ").cast("string"), F.lit(" differ from position "), F.get("_differ", F.lit(0)).cast("string"))),
    )
    gate = judged & ~F.coalesce(wrong_header, F.lit(False))
    told = lambda what, names: F.transform(names, lambda n: _hit("docs_gate", F.concat(F.lit(what + ":"), n)))
    once = F.array_distinct(header)
    repeated = F.filter(once, lambda n: F.size(F.filter(header, lambda h: h.eqNullSafe(n))) > 1)
    documented = F.col("doc_columns").isNotNull()
    gate_hits = F.when(gate & ~documented, F.array(_hit("docs_gate", F.lit("undocumented table:")))).when(
        gate,
        F.concat(
            told("repeated", repeated),
            told("undocumented", F.array_except(header, doc_names)),
            told("documented but absent", F.array_except(doc_names, header)),
        ),
    )
    rows = compute_once(rows, {"_gate": gate_hits.cast(HIT), "_header": header_hit})
    open_docs = (F.col("route") == "live") | (F.size("_gate") == 0)
    types = F.filter("doc_columns", lambda c: ~c["type"].isin(*TYPE_VOCABULARY))
    type_hits = F.transform(types, lambda c: _hit("type_vocabulary", F.concat_ws(" ", c["type"], c["name"])))
    keyless = ~F.exists("by", lambda c: F.coalesce(c["is_pk"], F.lit(False)))
    none = F.array().cast(HIT)
    hits = F.concat(
        F.array_compact(F.array(F.col("_header"))).cast(HIT),
        F.coalesce("_gate", none),
        F.when(gate & open_docs & keyless, F.array(_hit("key_required", F.lit("no key column")))).otherwise(none),
        F.when(gate & open_docs & (F.col("route") == "docs"), type_hits).otherwise(none).cast(HIT),
        F.when((F.col("route") == "undelivered") & F.col("live_columns").isNotNull(), F.array(_hit("missing_backing", F.lit("live table without file")))).otherwise(none),
        F.when((F.col("route") == "undelivered") & documented, F.array(_hit("missing_backing", F.lit("documented table without file")))).otherwise(none),
    )
    checks = F.when(~gate, "none").when(open_docs, "all").otherwise("some")
    return rows.withColumns({"hits": hits, "checks": checks}).drop("_differ", "_gate", "_header")


def row_hits(cells: Column, spec: Column, checks: Column) -> Column:
    """All that is wrong with one row: its length, or its cells."""
    ragged = F.size(cells) != F.size(spec)

    def judged(c: Column, k: Column) -> Column:
        cell = F.get(cells, k)
        empty = F.coalesce(cell, F.lit("")) == ""
        problem = let(
            cell_problem(cell, c["type"]),
            lambda p: F.when(p.isNotNull(), _hit("cell_parses", F.concat_ws(" ", p, c["type"], c["name"]))),
        )
        return F.when(empty, F.when(~F.coalesce(c["nullable"], F.lit(True)), _hit("null_in_required", c["name"]))).otherwise(problem)

    count = F.concat_ws(" of ", F.size(cells).cast("string"), F.size(spec).cast("string"))
    return F.when(ragged, F.array(_hit("ragged_rows", count))).when(
        checks == "all", F.array_compact(F.transform(spec, judged))
    ).otherwise(F.array().cast(HIT))


def routed_rows(rows: DataFrame, routes: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """(table, line_no, cells, checks, spec, key_at) of the rows of tables that are judged at all; `key_at`: places of key cells.

    The routes are one row per table, so the rows of a table that holds most of them are salted.
    `counts`: (table, _n), if at hand.
    """
    counts = row_counts(rows) if counts is None else counts
    key_at = F.filter(F.transform("spec", lambda c, k: F.when(c["is_pk"], k)), lambda k: k.isNotNull())
    wanted = routes.where("checks <> 'none'").select("table", "spec", "checks", key_at.alias("key_at"))
    data = rows.select("table", "line_no", "cells")
    hot = counted_hot_keys(counts, ["table"], "_n")
    return spread_join(data, wanted, ["table"], spread_by=["line_no"], grouped=True, hot=hot)


def row_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("table").agg(F.count(F.lit(1)).alias("_n"))


def with_hits(routed: DataFrame) -> DataFrame:
    """Adds `hits`, what is wrong with each row. The dear part of it all, so only what reads them should ask for them."""
    return compute_once(routed, {"hits": row_hits(F.col("cells"), F.col("spec"), F.col("checks"))})


def judged_rows(rows: DataFrame, routes: DataFrame) -> DataFrame:
    """The same with `hits`."""
    return with_hits(routed_rows(rows, routes))


def row_issues(judged: DataFrame, *rules: str) -> DataFrame:
    """The hits of rows as issues: of all rules, or of those named (ragged_rows, null_in_required, cell_parses)."""
    found = judged.where(F.size("hits") > 0).select("table", "line_no", F.explode("hits").alias("hit"))
    rows = found.where(F.col("hit.rule").isin(*rules)) if rules else found
    return rows.select(
        F.lit(1).alias("wave"), F.col("hit.rule").alias("rule"), F.lit("contract").alias("object_type"),
        key_text("table", "line_no").alias("object_key"), F.col("hit.detail").alias("detail"), F.lit(None).cast("string").alias("hint"),
    )


def duplicate_key_issues(routed: DataFrame) -> DataFrame:
    """Keys that repeat, as raw text; ragged rows and keyless tables take no part."""
    whole = routed.where((F.size("cells") == F.size("spec")) & (F.col("checks") == "all") & (F.size("key_at") > 0))
    key = F.transform("key_at", lambda k: F.coalesce(F.get("cells", k), F.lit("")))
    keyed = whole.select("table", "line_no", key.alias("_key"))
    later = later_occurrences(keyed, ["table", "_key"], ["line_no"])
    detail = F.concat(F.array_join("_key", ","), F.lit(" first at line "), F.col("first_place.line_no").cast("string"))
    return as_issues(later, "duplicate_keys", "contract", key_text("table", "line_no"), detail, wave=1)


def validate(
    files: DataFrame,
    headers: DataFrame,
    rows: DataFrame,
    live: DataFrame,
    docs: DataFrame,
    exemptions: DataFrame | None = None,
    dry_run: bool = False,
    max_rows: int = MAX_ROWS_PER_TABLE,
    routes: DataFrame | None = None,
) -> DataFrame:
    """All issues of a delivery, with `severity`: error, or warning where an exemption holds.

    `routes`, if given, is `table_hits(routing(...))` as a table, so that it is made once.
    Tables without rows, rows of tables without a file, repeated rows and NULL cells are
    all judged; an empty delivery only misses its files. Exemptions on a real load are refused.
    """
    if exemptions is None:
        exemptions = files.sparkSession.createDataFrame([], "kind string, table string")
    elif not dry_run and not exemptions.isEmpty():
        raise ExemptionsNeedDryRun("exemptions hold on dry runs only")
    if routes is None:
        routes = table_hits(routing(files, headers, live, docs, exemptions))
    counts = row_counts(rows)
    routed = routed_rows(rows, routes, counts)
    known = routes.select("table", "route", "used")
    unknown = files.join(known.where("route = 'unknown'"), "table", "left_semi")
    lifted = F.array_contains("used", DROPPED)
    per_table = routes.select("table", "used", F.explode("hits").alias("hit"))
    dropped = (F.col("hit.rule") == "missing_backing") & F.col("hit.detail").startswith("live") & lifted
    # An exempted table is told of, though it is no error.
    exempted = known.select("table", F.explode("used").alias("kind")).where(F.col("kind") != DROPPED)
    many = counts.where(F.col("_n") > max_rows).join(routes.where("checks <> 'none'").select("table"), "table")

    def told(df: DataFrame, rule: Column, key: Column, detail: Column) -> DataFrame:
        return df.select(
            F.lit(1).alias("wave"), rule.alias("rule"), F.lit("contract").alias("object_type"), key.alias("object_key"),
            detail.alias("detail"), F.lit(None).cast("string").alias("hint"),
        )

    table_level = told(per_table.where(~dropped), F.col("hit.rule"), F.col("table"), F.col("hit.detail"))
    waived = told(per_table.where(dropped), F.col("hit.rule"), F.col("table"), F.col("hit.detail")).unionByName(
        told(exempted, F.col("kind"), F.col("table"), F.lit("judged by the documentation"))
    )
    errors = union_issues(
        as_issues(unknown, "unknown_table", "contract", F.col("path"), F.col("table"), wave=1),
        folder_alignment(files, docs),
        duplicate_stem(files),
        table_level,
        told(many, F.lit("row_guardrail"), F.col("table"), F.col("_n").cast("string")),
        row_issues(with_hits(routed)),
        duplicate_key_issues(routed),
    )
    return errors.withColumn("severity", F.lit("error")).unionByName(waived.withColumn("severity", F.lit("warning")))


def unused(exemptions: DataFrame, routes: DataFrame) -> DataFrame:
    """(kind, table) of exemptions that changed nothing."""
    used = routes.select("table", F.explode("used").alias("kind"))
    return exemptions.select("kind", "table").distinct().join(used, ["kind", "table"], "left_anti")
