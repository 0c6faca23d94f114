"""Rule semantics on small hand-made frames."""

from pyspark.sql import functions as F

from catalith import skew
from catalith.functions import cells, expressions, paths
from catalith.issues import gate_waves
from catalith.operators import code_sets as K
from catalith.operators import diff as X
from catalith.operators import graph as G
from catalith.sources import contract_csv as S5
from catalith.sources import files as S
from catalith.sources.documents import document_rows
from catalith.sources.state import introspect_tables

from .conftest import write


def one(spark, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}")


def each(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_predicates(spark):
    cases = {
        "a.b.c.d = e.f.g.h": True, "(a.b.c.d) = (e.f.g.h)": True, "((a.b.c.d in (1, 2)))": True, "not a.b.c.d": True,
        "a.b.c.d is not distinct from e.f.g.h": True, "a.b.c.d between 1 and 2": True, "a.b.c.d ~* 'x'": True,
        "a.b.c.d similar to 'x'": True, "a.b.c.d": False, "a.b.c.d + 1": False, "f(a.b.c.d = 1)": False,
        "case when a.b.c.d = 1 then 2 end": False, "((a.b.c.d)) || ((e.f.g.h = 1))": False, "a.b.c.d->>'k'": False,
        "(" * 40 + "a.b.c.d = 1" + ")" * 40: True,
    }
    assert each(spark, list(cases), expressions.is_predicate) == list(cases.values())


def test_navigation(spark):
    cases = {
        "a.b.c.d": None, "a.b.c.d;": None, "a.b.c.d; select 1": "multiple statements", "(select 1)": "subquery",
        "a.b.c.d in (select 1)": "subquery", "select 1 union select 2": "UNION set-operation", "select 1": "SELECT statement",
        "with x as (select 1) select 1": "SELECT statement", "update t set a = 1": "UPDATE statement",
        "a.b.c.d is distinct from e.f.g.h": None, "extract(year from a.b.c.d)": None, "a join b on true": "JOIN",
        "'select 1'": None, "a.b.c.d -- select 1": None, "a.b.c.d::timestamp with time zone": None,
    }
    assert each(spark, list(cases), expressions.navigation_kind) == list(cases.values())


def test_every_volatile_function_is_found(spark):
    calls = [f"coalesce(a.b.c.d, {n.upper()}())" for n in expressions.VOLATILE_FUNCTIONS]
    assert each(spark, calls, expressions.volatile_functions) == [[n] for n in expressions.VOLATILE_FUNCTIONS]
    words = list(expressions.CONTEXT_KEYWORDS)
    assert each(spark, words, expressions.volatile_functions) == [[w] for w in words]
    fine = ["a.b.c.current_role", "a.b.c.d at time zone 'utc'", "'now()'", "a.b.c.now = 1"]
    assert each(spark, fine, expressions.volatile_functions) == [[]] * 4


def test_references(spark):
    cases = {
        "a.b.c.d = a.b.c.d": ["a.b.c.d", "a.b.c.d"], 'a . b."C-x".d > 1.5': ["a.b.C-x.d"], "'a.b.c.d' || f.g(e.f.g.h)": ["e.f.g.h"],
        "it''s": [], "'it''s a.b.c.d' = e.f.g.h /* x.y.z.w */": ["e.f.g.h"],
    }
    assert each(spark, list(cases), expressions.column_references) == list(cases.values())
    assert each(spark, ["x = 1", "a.b.c = a.b.c.d.e", "cast(a.b.c.d as date)", "a.b.c.d::money"], expressions.badly_qualified) == [
        ["x"], ["a.b.c", "a.b.c.d.e"], [], [],
    ]


def test_cells(spark):
    cases = [
        (" 5 ", "integer", None), ("+5", "integer", None), ("5.0", "integer", "parse"), ("1_000", "integer", "parse"),
        ("99999", "smallint", "range"), ("nan", "numeric", None), ("-inf", "real", None), ("5d", "real", "parse"),
        ("y", "boolean", "parse"), ("T", "boolean", None), ("2024-02-30", "date", "parse"), ("20240101", "date", None),
        ("2024", "date", "parse"), ("2024-1-5", "date", "parse"), ("2024-01-05T10:00:00+02:00", "timestamp with time zone", None),
        ("2024-01-05 25:00", "timestamp without time zone", "parse"), ("", "date", None), ("x", "text", None), ("x", "odd", None),
    ]
    df = spark.createDataFrame([(i, v, t) for i, (v, t, _) in enumerate(cases)], "i int, v string, t string")
    got = df.orderBy("i").select(cells.cell_problem(F.col("v"), F.col("t"))).collect()
    assert [r[0] for r in got] == [c[2] for c in cases]


def test_paths(spark):
    df = spark.createDataFrame([("a.b",), ("a.b.c",), ("a.bc",), ("a.x.concept.k",), ("a.concept.k",)], "p string")
    assert {r.p for r in df.where(paths.is_under("p", "a.b")).collect()} == {"a.b", "a.b.c"}
    assert {r.p for r in df.where(paths.matches("p", "a.*.concept.*")).collect()} == {"a.x.concept.k", "a.concept.k"}
    cut = one(spark, "a.b.c.d").select(paths.subpath("v", 1, 2), paths.subpath("v", -2), paths.subpath("v", 0, -1)).first()
    assert tuple(cut) == ("b.c", "c.d", "a.b.c")


def test_diff_semantics(spark):
    schema = "k int, v string, tags array<string>"
    cur = spark.createDataFrame([(1, None, ["a", "b"]), (2, "x", []), (3, "x", []), (4, "x", [])], schema)
    new = spark.createDataFrame([(1, None, ["b", "a"]), (2, "x", []), (3, None, []), (40, "x", [])], schema)
    ops = {(r.k, r.op) for r in X.snapshot_diff(new, cur, ["k"], ["v", "tags"]).collect()}
    # List order counts, NULL equals NULL, a changed key is a delete and an insert.
    assert ops == {(1, "update"), (3, "update"), (4, "delete"), (40, "insert")}


def test_guard_limits(spark):
    cur = spark.range(80).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    diff = lambda n: X.snapshot_diff(cur.where(F.col("k") >= n), cur, ["k"], ["v"])
    verdict = lambda n, **kw: X.mass_delete_guard([diff(n)], [cur], **kw).first().violation
    assert not verdict(20)  # exactly the fraction
    assert verdict(21)
    assert not verdict(19, fraction=0.0, min_count=20)
    for bad in ({"fraction": True}, {"fraction": 1.5}, {"min_count": -1}, {"min_count": False}):
        try:
            X.check_guard_knobs(**{"fraction": 0.25, "min_count": 20, **bad})
            raise AssertionError(bad)
        except ValueError:
            pass


def test_waves(spark):
    rows = [(2, "r", "t", "a", "", None), (3, "r", "t", "b", "", None)]
    from catalith.issues import ISSUE_SCHEMA

    assert [r.wave for r in gate_waves(spark.createDataFrame(rows, ISSUE_SCHEMA)).collect()] == [2]


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(8, 60)]
    df = spark.createDataFrame(chain + star + [(500, 500)], "a int, b int")
    found = {r.node: r.component for r in G.connected_components(df, "a", "b").collect()}
    assert {found[n] for n in range(100, 161)} == {100} and {found[n] for n in range(7, 60)} == {7} and found[500] == 500


def test_spread_joins_equal_plain_joins(spark, monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 100)
    k = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 7)
    rows = spark.range(3000).select(k.alias("k"), F.col("id").alias("n"))
    one_each = spark.createDataFrame([(0, "zero"), (1, "one"), (9, "nine"), (None, "none")], "k bigint, w string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = rows.join(one_each, "k", how)
        for grouped in (True, False):
            split = skew.spread_join(rows, one_each, ["k"], how, spread_by=["n"], grouped=grouped)
            assert sorted(map(tuple, split.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_salts_follow_the_count_of_each_key(spark):
    # 80 hot keys, one of them with a third of the rows, and a NULL key that needs no salts of its own.
    rows = spark.range(24_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 79).alias("k")
    )
    salts = {r.k: r._salts for r in skew.hot_keys(rows, ["k"], target=50).collect() if r.k is not None}
    assert len(salts) == 80 and salts[-1] == 160 and salts[5] in (3, 2)


def test_documents():
    assert document_rows("tables", b"- {a: 1, b: x}\n- 3\n")[0]["kinds"] == {"a": "int", "b": "text"}
    assert document_rows("tables", b"- {a: 1, b: x}\n- 3\n")[1]["error"] == "expected a mapping per row"
    assert document_rows("tables", b"- a: 1\n  a: 2\n")[0]["error"] == "repeated key a"
    assert document_rows("tables", b"- &x {a: 1}\n- {<<: *x, b: 2}\n")[0]["error"] == "merge key"
    assert document_rows("tables", b"a: 1\n")[0]["error"] == "expected a list"
    assert document_rows("schema", b"- a\n")[0]["error"] == "expected a mapping"
    assert document_rows("schema", b"\xff\xfe")[0]["error"].startswith("unreadable")


def test_contract_files(spark, tmp_path):
    root = tmp_path / "ref"
    write(root / "codes" / "kind.csv", "﻿code,text\r\n1,\"two\nlines\"\r\n01,\r\n1,x\r\n2\r\n")
    write(root / "codes" / "empty.csv", "")
    write(root / "codes" / "deep" / "x.csv", "a\n")
    write(root / "codes" / "Upper.CSV", "a\n")
    write(root / "other" / "y.csv", "a\n")
    write(root / "top.csv", "a\n")
    schemas = spark.createDataFrame([("codes",)], "schema string")
    files = S5.delivered_files(spark, str(root))
    reasons = {(r.object_key, r.detail) for r in S5.placement_issues(files, schemas).collect()}
    assert reasons == {
        ("codes/deep/x.csv", "nested too deep"), ("codes/Upper.CSV", "extension not in lower case"),
        ("other/y.csv", "unknown folder"), ("top.csv", "not in a schema folder"),
    }
    found = S5.scan_contract_csv(S5.readable(files, schemas))
    assert [(r.object_key, r.detail) for r in S5.read_issues(found).collect()] == [("codes/empty.csv", "empty file")]
    lines = {r.line_no: r.cells for r in S5.rows_of(found).collect()}
    assert lines == {2: ["1", "two\nlines"], 3: ["01", ""], 4: ["1", "x"], 5: ["2"]}
    digest = S.content_hash(files.where("path = 'codes/kind.csv'")).first().sha256
    assert S5.headers_of(found).where("table = 'kind'").first().sha256 == digest
    live = spark.createDataFrame(
        [("kind", 0, "codes", "code", "text", False, True), ("kind", 1, "codes", "text", "text", False, False)],
        "table string, ordinal int, schema string, name string, type string, nullable boolean, is_pk boolean",
    )
    kind = S5.headers_of(found).where("table = 'kind'")
    issues = K.validate(kind.select("path", "schema", "table"), kind, S5.rows_of(found), live, live)
    assert {(r.rule, r.object_key) for r in issues.collect()} == {
        ("ragged_rows", "kind|5"), ("duplicate_keys", "kind|4"), ("null_in_required", "kind|3"),
    }


def test_missing_root_fails_at_once(spark, tmp_path):
    try:
        S.scan_files(spark, str(tmp_path / "nowhere"))
        raise AssertionError("a missing folder must fail")
    except Exception as e:
        assert isinstance(e, FileNotFoundError)


def test_scan_lists_every_file_once(spark, tmp_path):
    want = {}
    for rel, text in {"a.yaml": "x", "d/e/f/deep.yaml": "é", "d/empty.yaml": "", "d/e/.hidden": "h", "d/_under": "u", "sp ace/ü%20.yaml": "p"}.items():
        write(tmp_path / rel, text)
        want[rel] = text.encode()
    (tmp_path / "hollow" / "inner").mkdir(parents=True)
    for i in range(300):
        write(tmp_path / "many" / f"{i}.txt", str(i))
        want[f"many/{i}.txt"] = str(i).encode()
    for root in (str(tmp_path), f"file://{tmp_path}/"):
        rows = S.scan_files(spark, root).collect()
        assert {r.rel: bytes(r.content) for r in rows} == want and len(rows) == len(want)
        assert all(r.length == len(want[r.rel]) and r.path.endswith(r.rel) for r in rows)
    assert S.scan_files(spark, str(tmp_path), content=False).where("ext = '.yaml'").count() == 4
    assert S.list_files(spark, str(tmp_path / "hollow")).isEmpty()


def test_introspection(spark):
    spark.range(3).select(F.col("id").alias("code", metadata={"is_pk": True}), F.lit("x").alias("name")).createOrReplaceTempView("kinds")
    rows = [(r.table, r.ordinal, r.name, r.is_pk) for r in introspect_tables(spark).orderBy("ordinal").collect() if r.table == "kinds"]
    assert rows == [("kinds", 0, "code", True), ("kinds", 1, "name", False)]
    spark.catalog.dropTempView("kinds")


def test_expression_tokens_of_any_length(spark):
    from catalith.functions import expressions as E

    long_texts = {
        "'" + "''" * 500_000 + "'": 1, "+" * 100_000: 100_000, ".".join(["a"] * 300_000): 1, '"' + "a" * 1_000_000 + '"': 1,
        "$$" + "a.b" * 300_000 + "$$": 1, "E'" + "\\'" * 300_000 + "'": 1, "=-" * 50_000: 1 + 1,
    }
    df = spark.createDataFrame([(t,) for t in long_texts], "e string")
    assert [r[0] for r in df.select(F.size(E.tokens(F.col("e")))).collect()] == list(long_texts.values())


def test_expression_text_that_is_never_closed_is_cut_in_one_go(spark):
    import time

    from catalith.functions import expressions as E

    texts = ["".join(f"$t{i}$ " for i in range(20_000)), "/* " * 100_000, "$$ $a$ " * 20_000, "a /* b", "$x$ a.b.c.d"]
    df = spark.createDataFrame([(t,) for t in texts], "e string").coalesce(1)
    start = time.monotonic()
    got = [r[0] for r in df.select(E.tokens(F.col("e"))).collect()]
    assert time.monotonic() - start < 20
    assert got[0] == [texts[0]] and got[1] == [] and len(got[2]) == 13_334 and got[3] == ["a"] and got[4] == [texts[4]]


def test_expression_names_by_position(spark):
    from catalith.functions import expressions as E

    cases = {
        "s.m.t.c <>-1": ([], True), "cast(s.m.t.c as int8)": ([], False), "extract(millennium from s.m.t.c)": ([], False),
        "s.m.t.c collate \"C\" = 'x'": ([], True), "date = s.m.t.c": (["date"], True), "year > 3": (["year"], True),
        "$q$a.b.c$q$ = s.m.t.c": ([], True), "E'it\\'s a.b.c'": ([], False), "date '2020-01-01' < s.m.t.c": ([], True),
        "s.m.t.c::timestamp with time zone at time zone 'utc'": ([], False), "interval '1' day + s.m.t.c": ([], False),
        "range > s.m.t.c": (["range"], True), "filter = s.m.t.c": (["filter"], True), "s.m.t.c = values": (["values"], True),
        "s.m.t.c is unknown": ([], True), "s.m.t.c = unknown": (["unknown"], True), "coalesce(row, s.m.t.c)": (["row"], False),
        "sum(s.m.t.c) filter (where s.m.t.d > 1)": ([], False), "s.m.t.c like 'a' escape 'b'": ([], True),
        "sum(s.m.t.c) over (partition by s.m.t.d order by s.m.t.e rows between unbounded preceding and current row)": ([], False),
        "sum(s.m.t.c) over (range between 1 preceding and 2 following)": ([], False), "interval > 3": (["interval"], True),
        "(s.m.t.c, set) = (1, 2)": (["set"], True), "s.m.t.c in (select 1)": ([], True), "not over": (["over"], True),
    }
    df = spark.createDataFrame([(t,) for t in cases], "e string").coalesce(1)
    rows = df.select(E.badly_qualified(F.col("e")), E.is_predicate(F.col("e"))).collect()
    assert [tuple(r) for r in rows] == list(cases.values())
    assert spark.sql("""select '"now"()' as e""").select(E.volatile_functions(F.col("e"))).first()[0] == ["now"]
