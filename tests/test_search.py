"""Operators that search: spans that hold a moment, ways through relationships."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from catalith.functions import expressions
from catalith.operators import consumers, graph, hierarchy, history, intervals, join_paths

DAY = datetime(2020, 1, 1)


def test_pieces_cover_each_grain_once(spark):
    random.seed(1)
    rows = [(a, a + random.choice([-1, 0, 1, 5, 100, 5000, 1 << 30])) for a in (random.choice([0, 1, 7, 1 << 20, 12345]) for _ in range(200))]
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    for r in df.select("a", "b", intervals.dyadic_pieces(F.col("a"), F.col("b")).alias("p")).collect():
        spans = sorted((p.place << p.level, (p.place + 1) << p.level) for p in r.p)
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))
        assert (spans[0][0], spans[-1][1]) == (r.a, r.b + 1) if r.b >= r.a else not spans
        assert len(spans) <= 2 * max(1, (r.b - r.a + 1).bit_length())


def moments_and_spans(n, seed):
    random.seed(seed)
    at = lambda: DAY + timedelta(seconds=random.choice([0, 1, 3599, 3600, 86400, random.randint(-10**7, 10**7)]), microseconds=random.choice([0, 1, 999_999]))
    spans = []
    for i in range(n):
        s, e = at(), at()
        spans.append((random.choice([None, 1, 1, 1, 2, 3]), i, random.choice([s, s, s, None]), random.choice([e, e, None, s])))
    points = [(random.choice([None, 1, 1, 2, 4]), 1000 + i, random.choice([at(), at(), None, spans[i % n][2], spans[i % n][3]])) for i in range(n)]
    return spans, points


@pytest.mark.parametrize("grain", [1, 60, 3600, 86400 * 30])
def test_interval_join_equals_the_comparison(spark, grain):
    spans, points = moments_and_spans(300, grain)
    s = spark.createDataFrame(spans, "k int, span int, start timestamp, stop timestamp").repartition(3)
    p = spark.createDataFrame(points, "k int, point int, at timestamp").repartition(3)
    want = sorted(
        (pid, sid) for k, pid, at in points for kk, sid, a, b in spans
        if k is not None and k == kk and at and a and a <= at and (b is None or at < b)
    )
    got = intervals.interval_join(s, p, ["k"], "start", "stop", "at", grain)
    assert sorted((r.point, r.span) for r in got.collect()) == want and len(want) > 1000
    # Without a key every span counts.
    every = intervals.interval_join(s.drop("k"), p.drop("k"), [], "start", "stop", "at", grain)
    assert every.count() == sum(1 for _, _, at in points for _, _, a, b in spans if at and a and a <= at and (b is None or at < b))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_as_of_moments(spark):
    day = lambda n: DAY + timedelta(days=n)
    closed = [(1, "a", day(0), day(2)), (1, "b", day(2), day(5)), (2, "x", day(1), day(3)), (3, "gone", day(0), day(1))]
    now = [(1, "c", day(5)), (2, "y", day(3))]
    hist = spark.createDataFrame(closed, "k int, v string, update_ts timestamp, end_ts timestamp")
    cur = spark.createDataFrame(now, "k int, v string, update_ts timestamp")
    asked = [(1, day(-1)), (1, day(0)), (1, day(2)), (1, day(2)), (1, day(4)), (1, day(5)), (1, day(99)), (2, day(0)), (2, day(1)), (3, day(1)), (4, day(1)), (None, day(1)), (1, None)]
    moments = spark.createDataFrame([(*a, i) for i, a in enumerate(asked)], "k int, at timestamp, row int")
    got = {r["row"]: (r.v, r.found) for r in history.as_of_moments(cur, hist, ["k"], moments, "at").collect()}
    want = [None, "a", "b", "b", "b", "c", "c", None, "x", None, None, None, None]
    assert got == {i: (v, v is not None) for i, v in enumerate(want)}
    # One moment for all keys is the plain filter.
    t = day(2)
    one = spark.createDataFrame([(k, t) for k in (1, 2, 3)], "k int, at timestamp")
    a = {(r.k, r.v) for r in history.as_of_moments(cur, hist, ["k"], one, "at").where("found").collect()}
    assert a == {(r.k, r.v) for r in history.as_of(cur, hist, t).collect()}
    none = moments.where(F.lit(False))
    assert history.as_of_moments(cur, hist, ["k"], none, "at").isEmpty()


# --- ways through relationships


def brute_paths(rels, placed, source, targets):
    """(fewest hops in all, system) of the systems that join all targets, and the distances in each."""
    best, dist = None, {}
    for system in sorted({s for _, s in placed}):
        arcs = defaultdict(list)
        for a, b, key in rels:
            if a != b and (a, system) in placed and (b, system) in placed:
                arcs[a].append(b), arcs[b].append(a)
        seen, ways, level, hop = {source: 0}, {source: 1}, [source], 0
        while level:
            hop += 1
            following = defaultdict(int)
            for u in level:
                for v in arcs[u]:
                    if v not in seen:
                        following[v] += ways[u]
            ways |= following
            seen |= dict.fromkeys(following, hop)
            level = list(following)
        dist[system] = (seen, ways)
        if (source, system) in placed and all(t in seen for t in targets):
            best = min(filter(None, [best, (sum(seen[t] for t in targets), system)]))
    return best, dist


def test_paths_on_random_graphs(spark):
    random.seed(4)
    names = [f"t{i:02d}" for i in range(40)]
    rels = [(*random.sample(names, 2), f"r{i:03d}") for i in range(55)] + [("t01", "t01", "loop"), ("t02", "t03", "p1"), ("t03", "t02", "p2")]
    placed = {(t, s) for t in names for s in ("s1", "s2", "s3") if random.random() < 0.8}
    asked = {}
    for i in range(120):
        source, *targets = random.sample(names, random.choice([2, 2, 3, 4]))
        asked[f"m{i}"] = (source, targets)
    asked["self"] = ("t05", ["t05"])
    asked["ghost"] = ("t05", ["nowhere"])
    wanted = spark.createDataFrame([(k, s, t) for k, (s, ts) in asked.items() for t in ts + ts[:1]], "key string, source string, target string")
    r = spark.createDataFrame(rels, "a string, b string, name string").repartition(3)
    p = spark.createDataFrame(sorted(placed), "table_id string, system string")
    paths = join_paths.join_paths(wanted, r, "a", "b", "name", p)
    hops, issues = defaultdict(list), defaultdict(set)
    for h in paths.hops.collect():
        hops[h.key].append((h.hop, h.from_table, h.to_table, h.rel_key, h.system))
    for i in paths.issues.collect():
        issues[i.rule].add(i.object_key)
    ends = {name: {a, b} for a, b, name in rels}
    assert asked.keys() - hops.keys() == issues["unreachable_target"] | {"self"} and len(issues["unreachable_target"]) > 1
    for key, (source, targets) in asked.items():
        best, dist = brute_paths(rels, placed, source, targets)
        if key == "self":
            continue
        assert (best is None) == (key in issues["unreachable_target"])
        if best is None:
            continue
        seen, ways = dist[best[1]]
        steps = sorted(hops[key])
        assert {s[4] for s in steps} == {best[1]}
        reached = {source}
        for hop, a, b, rel, system in steps:
            assert a in reached and ends[rel] == {a, b} and seen[b] == hop == seen[a] + 1
            assert (a, system) in placed and (b, system) in placed
            reached.add(b)
        assert set(targets) <= reached and len(steps) == len(reached) - 1
        assert (key in issues["ambiguous_path"]) == any(ways[t] > 1 for t in targets)


def test_only_inner_tables_are_searched_for_components(spark, monkeypatch):
    # Forty tables hang on three hubs in a row; two tables have only each other.
    rels = [(f"leaf{i:02d}", f"hub{i % 3}", f"r{i}") for i in range(40)] + [("hub0", "hub1", "x"), ("hub1", "hub2", "y"), ("pair_a", "pair_b", "z")]
    placed = [(t, "s") for t in {t for a, b, _ in rels for t in (a, b)}]
    wanted = [("far", "leaf00", "leaf02"), ("apart", "leaf00", "pair_a"), ("two", "pair_b", "pair_a"), ("hub", "leaf01", "hub1")]
    seen, full = [], graph.connected_components
    monkeypatch.setattr(join_paths, "connected_components", lambda e, a, b: seen.append(e.count()) or full(e, a, b))
    paths = join_paths.join_paths(
        spark.createDataFrame(wanted, "key string, source string, target string"), spark.createDataFrame(rels, "a string, b string, name string"),
        "a", "b", "name", spark.createDataFrame(placed, "table_id string, system string"),
    )
    assert seen == [2]
    assert sorted((h.key, h.hop, h.from_table, h.to_table) for h in paths.hops.collect()) == [
        ("far", 1, "leaf00", "hub0"), ("far", 2, "hub0", "hub1"), ("far", 3, "hub1", "hub2"), ("far", 4, "hub2", "leaf02"),
        ("hub", 1, "leaf01", "hub1"), ("two", 1, "pair_b", "pair_a"),
    ]
    assert [(i.rule, i.object_key) for i in paths.issues.collect()] == [("unreachable_target", "apart")]


def test_sources_of_one_neighbour_are_searched_once(spark, monkeypatch):
    # Two hundred leaves on each of two hubs in a row ask for a leaf of the other hub, for the far hub and for a leaf of their own hub.
    rels = [(f"leaf{i:03d}", f"hub{i % 2}", f"r{i}") for i in range(400)] + [("hub0", "mid", "x"), ("mid", "hub1", "y1"), ("hub1", "mid", "y2")]
    placed = [(t, "s") for t in {t for a, b, _ in rels for t in (a, b)}]
    wanted = [(f"m{i}_{n}", f"leaf{i:03d}", t) for i in range(2, 400, 2) for n, t in enumerate(("leaf001", "hub1", "leaf000", "hub0"))]
    wanted += [("back", "hub0", "leaf001"), ("down", "hub0", "leaf000")]
    seen, full, kept, staged = [], join_paths._expanded, [], join_paths.stage
    monkeypatch.setattr(join_paths, "_expanded", lambda last, *rest: seen.append(last.count()) or full(last, *rest))
    monkeypatch.setattr(join_paths, "stage", lambda df, folder, name: kept.append(f"{folder}/{name}") or staged(df, folder, name))
    paths = join_paths.join_paths(
        spark.createDataFrame(wanted, "key string, source string, target string"), spark.createDataFrame(rels, "a string, b string, name string"),
        "a", "b", "name", spark.createDataFrame(placed, "table_id string, system string"),
    )
    hops = defaultdict(list)
    for h in sorted(paths.hops.collect()):
        hops[h.key].append((h.from_table, h.to_table, h.rel_key))
    away = [("hub0", "mid", "x"), ("mid", "hub1", "y1")]
    for i in range(2, 400, 2):
        up = (f"leaf{i:03d}", "hub0", f"r{i}")
        assert hops[f"m{i}_0"] == [up, *away, ("hub1", "leaf001", "r1")] and hops[f"m{i}_1"] == [up, *away]
        assert hops[f"m{i}_2"] == [up, ("hub0", "leaf000", "r0")] and hops[f"m{i}_3"] == [up]
    assert hops["back"] == [*away, ("hub1", "leaf001", "r1")] and hops["down"] == [("hub0", "leaf000", "r0")]
    unclear = {f"m{i}_{n}" for i in range(2, 400, 2) for n in (0, 1)} | {"back"}
    assert {(i.rule, i.object_key) for i in paths.issues.collect()} == {("ambiguous_path", k) for k in unclear}
    assert max(seen) < 10
    # Only what the results are read from is left.
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    left = {p.rsplit("/", 1)[1] for p in kept if hadoop(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop(p))}
    assert left == {"asked", "chosen", "ways", "hops"}


def test_pairs_are_led_through_their_smaller_level(spark):
    # Each of 300 sources has one table, which is among the 300 of the one target, and the other way round.
    level = lambda rows: spark.createDataFrame(rows, "start string, node string").selectExpr("'s' as system", "start", "node", "1L as ways")
    many = level([(f"o{i}", f"c{i}") for i in range(300)])
    one = level([("n", f"c{i}") for i in range(300)])
    pairs = spark.createDataFrame([(f"o{i}", "n") for i in range(300)], "source string, target string").selectExpr("'s' as system", "*")
    for found in (join_paths._touching(pairs, many, one), join_paths._touching(pairs.selectExpr("system", "target as source", "source as target"), one, many)):
        rows = found.collect()
        assert sorted(r.node for r in rows) == sorted(f"c{i}" for i in range(300)) and {(r._s, r._t) for r in rows} == {(1, 1)}


def test_paths_without_relationships(spark):
    wanted = spark.createDataFrame([("m", "a", "b"), ("n", None, "b")], "key string, source string, target string")
    rels = spark.createDataFrame([], "a string, b string, name string")
    placed = spark.createDataFrame([("a", "s"), ("b", "s")], "table_id string, system string")
    paths = join_paths.join_paths(wanted, rels, "a", "b", "name", placed)
    assert paths.hops.isEmpty() and [(i.rule, i.object_key, i.detail) for i in paths.issues.collect()] == [("unreachable_target", "m", "a to b")]


def test_mapping_along_a_path(spark):
    frames = {
        "s.a.sale": spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, buyer int"),
        "s.a.buyer": spark.createDataFrame([(10, 7), (20, 8)], "id int, land int"),
        "s.g.land": spark.createDataFrame([(7, "x")], "id int, name string"),
    }
    rels = spark.createDataFrame(
        [("s.a.sale", "s.a.buyer", "by", "s.a.sale.buyer = s.a.buyer.id", "many_to_one", "k1"),
         ("s.g.land", "s.a.buyer", "home", "s.g.land.id = s.a.buyer.land", "one_to_many", "k2")],
        "table_a_id string, table_b_id string, relationship_name string, join_condition string, cardinality string, rel_key string",
    )
    placed = spark.createDataFrame([(t, "lake") for t in frames], "table_id string, system string")
    wanted = spark.createDataFrame([("m", "s.a.sale", "s.g.land")], "key string, source string, target string")
    told = join_paths.described(join_paths.join_paths(wanted, rels, "table_a_id", "table_b_id", "rel_key", placed), rels, "rel_key")
    assert sorted((r.hop, r.to_table, r.cardinality) for r in told.collect()) == [(1, "s.a.buyer", "many_to_one"), (2, "s.g.land", "many_to_one")]
    out = consumers.apply_mapping(frames, "s.a.sale", ["id"], join_paths.joins_of(told, "m"), "coalesce(s.g.land.name, 'none')")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x"), (2, "none"), (3, "none")]


# --- many patterns, long ids


def test_many_patterns_equal_the_expression(spark):
    import re

    random.seed(2)
    labels = ["a", "b", "c", "concept"]
    ids = sorted({".".join(random.choices(labels, k=random.randint(1, 6))) for _ in range(150)}) + ["a..b", "", ".a", "a.b"]
    patterns = sorted({".".join(random.choice([*labels, "*", "*"]) for _ in range(random.randint(1, 6))) for _ in range(120)})
    patterns += ["*", "*.*", "no.*", "*.none.*", "a.b"]
    df = spark.createDataFrame([(i,) for i in [*ids, None]], "id string").repartition(3)
    rule = {p: re.compile("".join(r"(?:[^.]+\.)*" if x == "*" else re.escape(x) + r"\." for x in p.split("."))) for p in set(patterns)}
    want = sorted((i, p) for i in ids for p, r in rule.items() if r.fullmatch(i + ".") and ("*" in p.split(".") or p == i))
    many = hierarchy.path_match_many(df, "id", spark.createDataFrame([(p,) for p in [*patterns, None]], "pattern string"), "pattern")
    assert sorted((r.id, r.pattern) for r in many.collect()) == want
    for p in patterns[::7] + ["*", "*.*", "a.b"]:
        one = [r.id for r in hierarchy.path_match(df, "id", p).collect()]
        assert sorted(one) == [i for i, q in want if q == p]


def test_ids_of_very_many_labels(spark):
    long = ".".join(["x"] * 100_000)
    df = spark.createDataFrame([(f"{long}.end",), (f"top.{long}",), ("top.end",)], "id string")
    assert [r.id for r in hierarchy.path_match(df, "id", "top.*.x.*").collect()] == [f"top.{long}"]
    assert hierarchy.path_match(df, "id", "*.x.*.x.*.end").count() == 1
    patterns = spark.createDataFrame([("top.*.x.*",), ("*.end",), ("*.x.*.y.*",)], "pattern string")
    got = {(r.id[:5], r.pattern) for r in hierarchy.path_match_many(df, "id", patterns, "pattern").collect()}
    assert got == {("top.x", "top.*.x.*"), ("x.x.x", "*.end"), ("top.e", "*.end")}


# --- all recorded cardinalities


def test_cardinality_report_on_small_tables(spark):
    frames = {
        "a": spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "k int, v string"),
        "b": spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int"),
        "none": spark.createDataFrame([], "k int"),
    }
    rels = [
        ("ok", "a", ["k"], "b", ["k"], "many_to_one"), ("wrong", "a", ["k"], "b", ["k"], "one_to_one"), ("wide", "b", ["k"], "b", ["k"], "many_to_many"),
        ("new", "b", ["k"], "a", ["k"], None), ("odd", "a", ["k"], "b", ["k"], "n:1"), ("lone", "a", ["v"], "b", ["k"], "one_to_one"),
        ("empty", "a", ["k"], "none", ["k"], "one_to_one"),
    ]
    got = {r.rel_key: tuple(r)[4:] for r in consumers.cardinality_report(rels, frames).collect()}
    assert got == {
        "ok": ("many_to_one", "agrees", 2, 0, 1), "wrong": ("many_to_one", "contradicted", 2, 0, 1), "wide": ("one_to_one", "narrower", 3, 0, 0),
        "new": ("one_to_many", "unrecorded", 2, 1, 0), "odd": ("many_to_one", "unknown value", 2, 0, 1),
        "lone": (None, "no shared key", 0, None, None), "empty": (None, "no shared key", 0, None, None),
    }
    exact = {r.rel_key: tuple(r)[4:] for r in consumers.cardinality_report(rels, frames, exact=True).collect()}
    assert exact == got | {"lone": (None, "no shared key", 0, 4, 3), "empty": (None, "no shared key", 0, 2, 0)}


# --- components between loads


def test_components_follow_random_edits(spark):
    random.seed(6)
    node = lambda: random.randint(0, 45)
    edges = [(node(), node()) for _ in range(40)]
    frame = lambda rows: spark.createDataFrame(rows, "a int, b int")
    labels = graph.connected_components(frame(edges), "a", "b")
    for turn in range(6):
        out = random.sample(edges, [0, 6, 12, 0, len(edges), 3][turn] if turn != 5 else min(3, len(edges)))
        new = [(node(), node()) for _ in range([5, 0, 8, 0, 20, 9][turn])]
        left = list(edges)
        for e in out:
            left.remove(e)
        edges = left + new
        labels = graph.updated_components(labels, frame(edges), "a", "b", frame(new), frame(out))
        labels = spark.createDataFrame(labels.collect(), "node int, component int")
        want = graph.connected_components(frame(edges), "a", "b")
        assert sorted(map(tuple, labels.collect())) == sorted(map(tuple, want.collect()))


def test_untouched_components_are_not_searched(spark, monkeypatch):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (200, 201)]
    frame = lambda rows: spark.createDataFrame(rows, "a int, b int")
    labels = graph.connected_components(frame(chain), "a", "b")
    seen, full = [], graph.connected_components
    monkeypatch.setattr(graph, "connected_components", lambda e, a, b: seen.append(e.count()) or full(e, a, b))
    after = [e for e in chain if e != (101, 102)] + [(200, 100)]
    got = graph.updated_components(labels, frame(after), "a", "b", frame([(200, 100)]), frame([(101, 102)]))
    assert {r.node: r.component for r in got.collect()} == {i: 0 for i in range(61)} | {100: 100, 101: 100, 200: 100, 201: 100}
    # The torn component's one edge, and one edge between components: never the long chain.
    assert seen == [1, 1]


def test_references_cut_from_the_text_are_those_of_the_tokens(spark):
    random.seed(6)
    parts = ["a", "é", "E", "e", ".", ".", " ", "\n", "'", "''", '"', '"q r"', '"q.r"', "$$", "$t$", "(", "--", "/*", "*/", "-", "=", "!", "2.5", ".5", "ab.cd.ef.g", "t.c"]
    texts = [("".join(random.choices(parts, k=random.randint(0, 12))),) for _ in range(3000)] + [(None,)]
    df = spark.createDataFrame(texts, "e string")
    rows = df.select("e", expressions.column_references(F.col("e")).alias("a"), expressions.reference_tokens(expressions.tokens(F.col("e"))).alias("b")).collect()
    assert all(r.a == r.b for r in rows) and sum(bool(r.a) for r in rows) > 100
