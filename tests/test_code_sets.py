"""Code sets: routing and rules, publication, and the load as one job."""

import hashlib

import pytest
from pyspark.sql import functions as F

from catalith.operators import code_sets as K
from catalith.operators.contract import freshness
from catalith.plans.code_set_load import load_files
from catalith.sources import contract_csv, documented
from catalith.sources.code_sets import CodeSets, TableShape, freshness_ledger

from .conftest import write

LIVE = "table string, ordinal int, name string, type string, nullable boolean, is_pk boolean"
DOCS = "table string, schema string, name string, type string, nullable boolean, is_pk boolean"


def shape(spark, *tables, schema="ref"):
    columns = [("code", "integer", False, True), ("name", "text", False, False), ("since", "date", True, False)]
    live = spark.createDataFrame([(t, i, *c) for t in tables for i, c in enumerate(columns)], LIVE)
    docs = spark.createDataFrame([(t, schema, *c) for t in tables for c in columns], DOCS)
    return live, docs


def delivery(spark, **tables):
    """(files, headers, rows) of tables given as lists of rows, the first of them the header."""
    files = spark.createDataFrame([(f"ref/{t}.csv", "ref", t) for t in tables], "path string, schema string, table string")
    headers = spark.createDataFrame([(t, r[0]) for t, r in tables.items()], "table string, header array<string>")
    rows = [(t, i, cells) for t, r in tables.items() for i, cells in enumerate(r[1:], start=2)]
    return files, headers, spark.createDataFrame(rows, "table string, line_no int, cells array<string>")


HEADER = ["code", "name", "since"]
GOOD = [HEADER, ["1", "one", ""], ["2", "two", "2024-01-31"]]


def told(issues):
    return sorted((r.severity, r.rule, r.object_key, r.detail) for r in issues.collect())


def exempt(spark, *pairs):
    return spark.createDataFrame(list(pairs), "kind string, table string")


def test_rules_of_rows_and_tables(spark):
    live, docs = shape(spark, "a", "b", "c")
    bad = [HEADER, ["1", "", "2024-13-01"], ["x", "n"], ["1", "again", ""], ["99999999999", "n", ""], ["", None, None]]
    found = K.validate(*delivery(spark, a=bad, b=[["code", "since", "name"], ["junk"]], c=GOOD), live, docs)
    assert told(found) == [
        ("error", "cell_parses", "a|2", "parse date since"), ("error", "cell_parses", "a|5", "range integer code"),
        ("error", "duplicate_keys", "a|4", "1 first at line 2"), ("error", "header_equals", "b", "2 differ from position 1"),
        ("error", "null_in_required", "a|2", "name"), ("error", "null_in_required", "a|6", "code"), ("error", "null_in_required", "a|6", "name"),
        ("error", "ragged_rows", "a|3", "2 of 3"),
    ]
    assert told(K.validate(*delivery(spark, a=bad[:1] + GOOD[1:]), *shape(spark, "a"), max_rows=1)) == [("error", "row_guardrail", "a", "2")]


def test_three_kinds_of_exemption(spark):
    live, docs = shape(spark, "same", "reshaped", "gone", "lost")
    new = shape(spark, "fresh", "odd")[1]
    docs = docs.where("table <> 'gone'").unionByName(new.where("not (table = 'odd' and name = 'since')")).unionByName(
        spark.createDataFrame([("reshaped", "ref", "extra", "varchar", True, False)], DOCS)
    )
    wide = [[*HEADER, "extra"], ["1", "one", "", "e"], ["1", "", "", ""]]
    sent = delivery(spark, same=GOOD, reshaped=wide, fresh=GOOD, odd=GOOD, stray=GOOD)
    kinds = exempt(
        spark, (K.MISSING, "fresh"), (K.MISSING, "odd"), (K.RESHAPED, "reshaped"), (K.DROPPED, "gone"), (K.DROPPED, "same"),
        (K.MISSING, "nowhere"), (K.RESHAPED, "typo"),
    )
    routes = K.table_hits(K.routing(*sent[:2], live, docs, kinds))
    assert {r.table: r.route for r in routes.collect()} == {
        "same": "live", "reshaped": "docs", "fresh": "docs", "odd": "docs", "stray": "unknown", "gone": "undelivered", "lost": "undelivered",
        "nowhere": "undelivered", "typo": "undelivered",
    }
    found = told(K.validate(*sent, live, docs, kinds, dry_run=True))
    assert found == [
        ("error", "docs_gate", "odd", "undocumented:since"),
        ("error", "duplicate_keys", "reshaped|3", "1 first at line 2"),
        ("error", "missing_backing", "lost", "documented table without file"), ("error", "missing_backing", "lost", "live table without file"),
        ("error", "null_in_required", "reshaped|3", "name"), ("error", "type_vocabulary", "reshaped", "varchar extra"),
        ("error", "unknown_table", "ref/stray.csv", "stray"),
        ("warning", "missing_backing", "gone", "live table without file"), ("warning", "missing_table", "fresh", "judged by the documentation"),
        ("warning", "missing_table", "odd", "judged by the documentation"), ("warning", "reshaped_table", "reshaped", "judged by the documentation"),
    ]
    assert {(r.kind, r.table) for r in K.unused(kinds, routes).collect()} == {(K.DROPPED, "same"), (K.MISSING, "nowhere"), (K.RESHAPED, "typo")}
    # A real load takes no exemption, not even one that would change nothing.
    with pytest.raises(K.ExemptionsNeedDryRun):
        K.validate(*sent, live, docs, kinds)
    assert told(K.validate(*sent, live, docs)) != found


def test_nothing_delivered(spark):
    live, docs = shape(spark, "a")
    none = [df.where(F.lit(False)) for df in delivery(spark, a=GOOD)]
    assert [t[1:] for t in told(K.validate(*none, live, docs))] == [
        ("missing_backing", "a", "documented table without file"), ("missing_backing", "a", "live table without file"),
    ]
    assert K.validate(*none, live.limit(0), docs.limit(0)).isEmpty()


def test_rows_of_one_table_are_salted(spark, monkeypatch):
    from catalith import skew

    live, docs = shape(spark, "a", "b")
    rows = [HEADER] + [[str(i), "n", "x" if i % 7 == 0 else ""] for i in range(200)]
    sent = delivery(spark, a=rows, b=GOOD)
    want = told(K.validate(*sent, live, docs))
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 10)
    assert told(K.validate(*sent, live, docs)) == want and len(want) == 29


def test_plan_is_one_pass_over_the_rows(spark):
    live, docs = shape(spark, "a", "b")
    files, headers, rows = delivery(spark, a=GOOD, b=GOOD)
    seen = K.judged_rows(rows, K.table_hits(K.routing(files, headers, live, docs, exempt(spark, ("x", "y")))))
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN (table" not in plan and plan.count("LogicalRDD") + plan.count("LocalRelation") < 10


# --- publication


SHAPES = [TableShape("a", (("code", "integer"), ("name", "text"))), TableShape("b", (("day", "date"),))]


def reloaded(store, a, b, ts, tables=("a", "b")):
    spark = store.spark
    rows = [("a", i, r) for i, r in enumerate(a)] + [("b", i, r) for i, r in enumerate(b)]
    rows = spark.createDataFrame(rows, "table string, line_no int, cells array<string>")
    headers = spark.createDataFrame([("a", "ha" + ts, ["name", "code"]), ("b", "hb" + ts, ["day"])], "table string, sha256 string, header array<string>")
    return store.reload(rows, headers, [s for s in SHAPES if s.table in tables], ts)


def held(store, load=None):
    return {t: sorted(map(tuple, store.read(t, load).collect()), key=str) for t in store.pointers(load)}


def test_publication_is_one_unit(spark, tmp_path, monkeypatch):
    store = CodeSets(spark, str(tmp_path / "sets"))
    assert store.last_load() == 0 and store.pointers() == {} and store.ledger().isEmpty() and store.sweep() == []
    assert reloaded(store, [["x", "1"], ["", ""]], [["20240131"]], "2024-01-01 00:00:00") == 1
    first = held(store)
    assert [r for r in first["a"]] == [(1, "x"), (None, None)] and str(first["b"][0][0]) == "2024-01-31"

    # A load that dies before its last write changes nothing, and the next one takes its number.
    class Killed(Exception):
        pass

    def die(self, path):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(CodeSets, "_drop", die)
        with pytest.raises(Killed):
            reloaded(store, [["y", "2"]], [], "2024-01-02 00:00:00")
    assert store.last_load() == 1 and held(store) == first and store.ledger().count() == 2
    assert reloaded(store, [["z", "3"]], [], "2024-01-03 00:00:00", ("a",)) == 2
    assert held(store) == first | {"a": [(3, "z")]} and held(store, 1) == first

    ledger = store.ledger().orderBy("audit_id").collect()
    assert [(r.table_name, r.csv_sha256[:2], r.row_count, str(r.loaded_ts)[:10]) for r in ledger] == [
        ("a", "ha", 2, "2024-01-01"), ("b", "hb", 1, "2024-01-01"), ("a", "ha", 1, "2024-01-03"),
    ]
    # Only what no kept publication leads to is removed: here what the dead load left.
    assert [g.split("/tables/")[1] for g in store.sweep(keep=2)] == ["b/load_id=2"]
    assert [g.split("/tables/")[1] for g in store.sweep()] == ["a/load_id=1"]
    assert held(store) == first | {"a": [(3, "z")]} and store.ledger().count() == 3
    # A table of no rows is published empty.
    assert reloaded(store, [], [], "2024-01-04 00:00:00") == 3 and held(store) == {"a": [], "b": []}
    with pytest.raises(KeyError):
        store.read("nope")
    with pytest.raises(ValueError, match="must stay"):
        store.sweep(0)


# --- the job


def test_load_of_files(spark, tmp_path):
    root = tmp_path / "data"
    write(root / "ref" / "kind.csv", "﻿code,name,since\r\n1,one,\r\n2,\"two\nlines\",2024-01-31\r\n")
    write(root / "ref" / "level.csv", "code,name,since\n")
    live, docs = shape(spark, "kind", "level")
    store = CodeSets(spark, str(tmp_path / "sets"))

    def load(hour, **options):
        return load_files(store, contract_csv.delivered_files(spark, str(root)), live, docs, f"2024-01-01 {hour:02d}:00:00", **options)

    def fresh():
        files = contract_csv.headers_of(contract_csv.scan_contract_csv(contract_csv.delivered_files(spark, str(root))))
        return {r.table: r.status for r in freshness(files, freshness_ledger(store.ledger()), live).collect()}

    # A dry run judges and writes nothing.
    assert load(0, dry_run=True).load_id is None and fresh() == {"kind": "never loaded", "level": "never loaded"}
    done = load(1)
    assert done.load_id == 1 and done.issues.isEmpty() and fresh() == {"kind": "current", "level": "current"}
    rows = held(store)
    assert [(r[0], r[1], str(r[2])) for r in rows["kind"]] == [(1, "one", "None"), (2, "two\nlines", "2024-01-31")] and rows["level"] == []
    digest = hashlib.sha256((root / "ref" / "kind.csv").read_bytes()).hexdigest()
    assert store.ledger().where("table_name = 'kind'").first().csv_sha256 == digest

    # One fault anywhere refuses the whole delivery, and the ledger says what is stale.
    write(root / "ref" / "kind.csv", "code,name,since\n1,uno,\n")
    write(root / "ref" / "level.csv", "code,name,since\n1,,\n")
    refused = load(2)
    assert refused.load_id is None and told(refused.issues) == [("error", "null_in_required", "level|2", "name")]
    assert held(store) == rows and fresh() == {"kind": "stale", "level": "stale"}

    # A file that cannot be read, and one in the wrong place, refuse it too.
    write(root / "ref" / "level.csv", "")
    write(root / "level.csv", "code\n")
    assert {(i.rule, i.object_key) for i in load(3).issues.collect()} >= {("csv_read", "ref/level.csv"), ("csv_placement", "level.csv")}
    (root / "level.csv").unlink()
    write(root / "ref" / "level.csv", "code,name,since\n7,seven,\n")
    assert load(4).load_id == 2 and [r[1] for r in held(store)["level"]] == ["seven"] and held(store, 1) == rows
    with pytest.raises(K.ExemptionsNeedDryRun):
        load(5, exemptions=exempt(spark, (K.DROPPED, "kind")))


def test_documentation_of_a_folder(spark, tmp_path):
    root = tmp_path / "docs"
    row = "- table_name: {}\n  column_name: {}\n  data_type: text\n  is_nullable: {}\n"
    write(root / "ref" / "columns.yaml", row.format("kind", "code", "false") + "  is_primary_key: true\n" + row.format("kind", "name", "true"))
    write(root / "ref" / "columns" / "columns.yaml", row.format("level", "code", "false"))
    write(root / "ref" / "columns" / "more.yaml", row.format("level", "code", "true") + row.format("level", "x", "'yes'") + "- 7\n")
    write(root / "ref" / "deep" / "columns" / "odd.yaml", "a: [")
    write(root / "other" / "columns.yaml", row.format("kind", "extra", "true"))
    write(root / "columns.yaml", row.format("lost", "code", "true"))
    write(root / "ref" / "tables.yaml", "- table_name: kind\n")
    write(root / "ref" / "columns" / "notes.txt", "x")
    docs, issues = documented.read_documentation(spark, str(root))
    got = sorted((r.schema, r.table, r.name, r.type, r.nullable, r.is_pk) for r in docs.collect())
    assert got == [
        ("other", "kind", "extra", "text", True, False), ("ref", "kind", "code", "text", False, True), ("ref", "kind", "name", "text", True, False),
        ("ref", "level", "code", "text", False, False), ("ref", "level", "code", "text", True, False),
    ]
    assert {(i.rule, i.object_key, i.detail.split(":")[0]) for i in issues.collect()} == {
        ("duplicate_column", "level|code", "2"), ("table_in_two_schemas", "kind", "other,ref"),
        ("documented_rows", "ref/columns/more.yaml#1", "malformed"), ("documented_rows", "ref/columns/more.yaml#2", "expected a mapping per row"),
        ("documented_rows", "ref/deep/columns/odd.yaml#0", "unreadable"), ("documented_rows", "columns.yaml#0", "outside a schema folder"),
    }
    with pytest.raises(FileNotFoundError):
        documented.read_documentation(spark, str(tmp_path / "nowhere"))
