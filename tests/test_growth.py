"""What only showed on larger tables."""

import random
import re
import time

from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder
from catalith.functions import expressions as E
from catalith.operators import code_sets as K
from catalith.operators import consumers as Q
from catalith.operators import contract as C
from catalith.operators import graph as G
from catalith.operators import hierarchy as H
from catalith.operators import history as Y
from catalith.operators import intervals as I
from catalith.operators import lineage as L
from catalith.skew import first_place


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().sparkPlan().toString()


def test_no_shared_key_has_no_numbers_also_when_buckets_meet(spark, monkeypatch):
    a, b = spark.range(3).toDF("x"), spark.range(10, 14).toDF("y")
    rels = [("r", "a", ["x"], "b", ["y"], "one_to_one")]
    frames = {"a": a, "b": b}
    for buckets in (1, 1 << 16):
        monkeypatch.setattr(Q, "SKETCH", buckets)
        (row,) = Q.cardinality_report(rels, frames).collect()
        assert (row.status, row.matched_keys, row.keys_only_in_a, row.keys_only_in_b) == ("no shared key", 0, None, None)
    (row,) = Q.cardinality_report(rels, frames, exact=True).collect()
    assert (row.keys_only_in_a, row.keys_only_in_b) == (3, 4)


def test_versions_are_never_broadcast(spark):
    """Estimates see the rows that versions and pieces are made from, not how many they become."""
    t = lambda c: F.timestamp_seconds(F.col(c)).cast("timestamp_ntz")
    rows = spark.createDataFrame([(1, 0, 7200, 10), (1, 7200, 9000, 20), (2, 0, 3600, 30)], "k int, a long, b long, v int")
    history = rows.select("k", t("a").alias("update_ts"), t("b").alias("end_ts"), "v")
    cur = spark.createDataFrame([(1, 9000, 40)], "k int, a long, v int").select("k", t("a").alias("update_ts"), "v")
    moments = spark.createDataFrame([(1, 1, 100), (2, 1, 7500), (3, 1, 9000), (4, 2, 3600), (5, 1, None)], "row int, k int, a long")
    found = Y.as_of_moments(cur, history, ["k"], moments.select("row", "k", t("a").alias("at")), "at")
    # Only the list of lengths is broadcast.
    assert re.findall(r"BroadcastHashJoin \[([a-z_]*)#", _plan(found)).count("_level") == _plan(found).count("BroadcastHashJoin [")
    assert sorted((r["row"], r.v) for r in found.collect() if r.found) == [(1, 10), (2, 20), (3, 40)]


def test_short_stretches_are_asked_for_few_lengths(spark):
    ends = spark.createDataFrame([(5, 5), (5, 6), (4, 7), (3, 12), (0, (1 << 39) - 1), (9, 8)], "a long, b long")
    cut = ends.select(I.dyadic_pieces(F.col("a"), F.col("b")).alias("p")).collect()
    spelled = [sorted((x.place << x.level, (x.place + 1 << x.level) - 1) for x in r.p) for r in cut]
    assert spelled == [[(5, 5)], [(5, 5), (6, 6)], [(4, 7)], [(3, 3), (4, 7), (8, 11), (12, 12)], [(0, (1 << 39) - 1)], []]


def test_bracket_free_texts_are_judged_without_counting_depth(spark):
    """Same verdicts either way, and plain tokens are not looked at by regular expressions."""
    texts = ["a = b", "a", "", "a AND b", "f (a = b)", "(a = b)", "case when a = b then c end", "a[1] = 2", "IN (1)", "x in (1)", "end = 1"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.p for r in rows.select("t", E.is_predicate(F.col("t")).alias("p")).collect()]
    assert got == [True, False, False, True, False, True, False, True, True, True, True]
    labels = rows.select(E.navigation_kind(F.col("t")).alias("k")).where("k is not null")
    assert labels.isEmpty()


def test_rules_do_not_look_for_references(spark):
    rows = spark.createDataFrame([("k", "a.b.c.d = now()")], "k string, e string")
    issues = L.expression_rules(rows, "e", F.col("k"), "t", True)
    assert "_bad" not in _plan(issues)
    assert [r.rule for r in issues.collect()] == ["volatile_functions"]


def test_rounds_are_compared_row_by_row_only_if_their_fingerprints_agree(spark, monkeypatch):
    compared = []
    plain = type(spark.range(1)).exceptAll
    monkeypatch.setattr(type(spark.range(1)), "exceptAll", lambda self, other: compared.append(1) or plain(self, other))
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(9)], "a string, b string")
    assert {r.component for r in G.connected_components(edges, "a", "b").collect()} == {"n0"}
    assert compared == []


def test_rows_made_from_arrays_are_never_broadcast(spark):
    headers = spark.createDataFrame([("t1", ["a", "b", "b"]), ("t2", ["a"])], "table string, header array<string>")
    docs = spark.createDataFrame([("t1", "a"), ("t1", "c")], "table string, name string")
    gate = C.docs_gate(headers, docs)
    assert "BroadcastHashJoin" not in _plan(gate)
    assert sorted((r.object_key, r.detail) for r in gate.collect()) == [
        ("t1", "documented but absent:c"), ("t1", "repeated:b"), ("t1", "undocumented:b"), ("t2", "undocumented table:"),
    ]
    rows = spark.createDataFrame([("k", "a.b.c.d = 1", "a.b.c.x")], "k string, e string, own string")
    columns = spark.createDataFrame([("a.b.c.d",)], "column_id string")
    own = L.self_reference(rows, "e", "own", "k", columns, "column_id")
    assert "BroadcastHashJoin" not in _plan(own)
    assert [r.detail for r in own.collect()] == ["a.b.c.d"]


def test_documented_columns_are_never_broadcast(spark):
    rows = spark.createDataFrame([("k", "a.b.c.d = a.b.c.E"), ("l", "a.b.c.x = 1"), ("m", None)], "k string, e string")
    # One row, as far as Spark can tell.
    columns = spark.range(1).select(F.explode(F.array(F.lit("d"), F.lit("e"))).alias("c")).select(F.concat_ws(".", F.lit("a.b.c"), "c").alias("column_id"))
    found = L.refs_resolve(rows, "e", "k", columns, "column_id", "column_mappings")
    assert "BroadcastHashJoin" not in _plan(found)
    assert sorted((r.object_key, r.detail, r.hint) for r in found.collect()) == [("k", "a.b.c.E", "a.b.c.e"), ("l", "a.b.c.x", None)]


def _contract(spark, rows):
    """(rows, routes) of one table `t` of a key and a date."""
    live = spark.createDataFrame(
        [("t", 0, "code", "integer", False, True), ("t", 1, "since", "date", True, False)],
        "table string, ordinal int, name string, type string, nullable boolean, is_pk boolean",
    )
    files = spark.createDataFrame([("s/t.csv", "s", "t")], "path string, schema string, table string")
    headers = spark.createDataFrame([("t", ["code", "since"])], "table string, header array<string>")
    docs = live.withColumn("schema", F.lit("s"))
    routes = K.table_hits(K.routing(files, headers, live, docs, spark.createDataFrame([], "kind string, table string")))
    return spark.createDataFrame(rows, "table string, line_no int, cells array<string>"), routes


def test_keys_are_compared_without_judging_cells_or_sorting_rows(spark):
    rows, routes = _contract(spark, [("t", i, [str(i % 3), ""]) for i in range(2, 8)] + [(None, 9, ["1", ""])])
    found = K.duplicate_key_issues(K.routed_rows(rows, routes))
    assert "cell_parses" not in _plan(found) and "SortAggregate [table" not in _plan(found) and "min(struct" not in _plan(found)
    assert sorted((r.object_key, r.detail) for r in found.collect()) == [
        ("t|5", "2 first at line 2"), ("t|6", "0 first at line 3"), ("t|7", "1 first at line 4"),
    ]


def test_first_place_of_one_column_is_that_of_structs(spark):
    rows = spark.createDataFrame([("a", 3), ("a", 1), ("b", None), ("b", 2), ("c", None), (None, 5), (None, 4)], "k string, n int")
    got, want = (rows.groupBy("k").agg(c.alias("f")) for c in (first_place(["n"]), F.min(F.struct("n"))))
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
    assert "SortAggregate" not in _plan(got)


def test_idle_labels_stay_where_they_are_and_asked_ones_are_dealt_out(spark, monkeypatch):
    ids = [(f"{'a' if i % 3 else 'b'}.t{i % 4}.concept.k{i}",) for i in range(40)]
    df = spark.createDataFrame([*ids, ("a..concept.k1",), (None,)], "id string")
    patterns = spark.createDataFrame([("a.*",), ("*.t1.concept.*",), ("b.t2.*.k2",), ("*.k7",), ("*.none.concept",)], "p string")
    want = sorted(tuple(r) for r in H.path_match_many(df, "id", patterns, "p").collect())
    assert len(want) == 26 + 10 + 1 and ("a.t1.concept.k1", "*.t1.concept.*") in want
    monkeypatch.setattr(H, "IDS_PER_TASK", 3)
    many = H.path_match_many(df, "id", patterns, "p")
    assert sorted(tuple(r) for r in many.collect()) == want
    assert "_salt" in _plan(many) and "LeftAnti" in _plan(many)


def test_expressions_are_cut_as_far_as_asked_only(spark):
    """By one find per reference, and clean texts without tokens; the outcome is that of the tokens."""
    random.seed(5)
    pieces = [
        "a", "a.b", "a.b.c", "a.b.c.d", "a . b.\nc.d", '"a.x".b.c."d e"', "a.b.c.d.e", "f(", "a.b.c.d (", "a.f(", ")", "'x.y.z.w'", "E'it\\'s a.b'", "e'", "'",
        '"', '"q"', '"q', "$$a.b$$", "$t$ a.b.c $t$", "$t$", "-- a.b.c\n", "--", "/* a.b */", "/*", "select", "SELECT", "At", "date", "range", "Key", "1.5", ".5", "a.1",
        "=", "<>-", "@-", "::", "[", "]", ",", ";", " ", "  ", "\n", "and", "current_date", "été.b.c.d", ".", "#", "e", "x'ab'", "5a.b.c.d",
    ]
    texts = ["", None, *pieces] + ["".join(random.choice(pieces) + random.choice(["", " "]) for _ in range(random.randint(1, 9))) for _ in range(4000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    t = F.col("t")
    cut = rows.select("t", E.tokens(t).alias("toks"), E.column_references(t).alias("refs"), E.badly_qualified(t).alias("bad"))
    both = cut.select("t", "refs", E.reference_tokens(F.col("toks")).alias("r"), "bad", E.badly_qualified_tokens(F.col("toks")).alias("b"))
    assert both.where("not (refs <=> r) or not (bad <=> b)").collect() == []
    assert rows.select(E.all_qualified(t).alias("q")).where("q").count() > 100
    long = spark.createDataFrame([("a.b.c.d + 1.5 or f(x) = 'y' -- z\n " * 30_000,), ("a.b.c.d + (" * 90_000,)], "t string")
    assert [tuple(r) for r in long.select(F.size(E.column_references(t)), F.size(E.badly_qualified(t))).collect()] == [(30_000, 30_000), (90_000, 0)]


def test_what_was_shuffled_for_a_staged_table_goes(spark):
    def shuffled() -> set[str]:
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    before, conf = shuffled(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    rows = stage(spark.range(1000).selectExpr("id % 10 as k").groupBy("k").count(), staging_folder(spark), "counts")
    ends = time.time() + 20
    while shuffled() - before and time.time() < ends:
        time.sleep(0.2)
    assert not shuffled() - before and rows.count() == 10
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == conf
