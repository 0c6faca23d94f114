"""Finding the way from one table to others through the recorded relationships.

A relationship is one hop and joins two tables in either direction; a path of several
hops can only be run where one system carries every table on it. The search goes level
by level from both ends of each wanted pair, in all systems at once: after `i` levels
from the source and `j` from the target, exactly the pairs `i + j` hops apart meet. So a
table that very many others hang on is reached from both sides and seldom left again.
A source with one neighbour only has to go there first: what all such sources of one
neighbour ask for is searched once, from that neighbour. No way leads through a table
with one neighbour, so none is entered but as a target.
Levels hold each (system, start, table) once, with its smallest predecessor and whether
there was another way; pairs that have met, and systems in which a target cannot be
reached at all (another component of the graph), are not searched any further.

The driver runs one loop turn per hop of the longest path and collects nothing but counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder, unstage
from catalith.issues import as_issues, union_issues
from catalith.operators.graph import connected_components
from catalith.operators.venues import placed_ends
from catalith.specs import FLIPPED_CARDINALITY

STATE = ["system", "start", "node"]


@dataclass(frozen=True)
class JoinPaths:
    """hops: key, system, hop, from_table, to_table, rel_key. issues: unreachable and ambiguous keys."""

    hops: DataFrame
    issues: DataFrame


def _merged(df: DataFrame) -> DataFrame:
    """Never broadcast: Spark would judge a staged table by its packed size, a thirtieth of what its rows take on the driver."""
    return df.hint("merge")


def runnable_steps(rels: DataFrame, a: str, b: str, rel_key: str, deployments: DataFrame) -> DataFrame:
    """(system, low, high, rel_key, ways): each step that a system can run, by its smallest relationship."""
    ends = rels.where(F.col(a) != F.col(b)).select(F.col(rel_key).alias("rel_key"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    placed = placed_ends(ends.where("rel_key is not null"), _merged(deployments))
    steps = placed.select("system", F.least("_a", "_b").alias("low"), F.greatest("_a", "_b").alias("high"), "rel_key")
    return steps.groupBy("system", "low", "high").agg(F.min("rel_key").alias("rel_key"), F.count(F.lit(1)).alias("ways"))


def _both_ways(steps: DataFrame) -> DataFrame:
    """(system, node, next, rel_key, ways): each step goes both ways."""
    way = lambda a, b: F.struct(F.col(a).alias("node"), F.col(b).alias("next"))
    turned = steps.select("system", F.explode(F.array(way("low", "high"), way("high", "low"))).alias("_w"), "rel_key", "ways")
    return turned.select("system", "_w.node", "_w.next", "rel_key", "ways")


def _neighbours(steps: DataFrame) -> DataFrame:
    """(system, node, up, rel_key, ways) of every table with a step: its one neighbour and the step there, or NULLs if it has several."""
    near = _both_ways(steps).groupBy("system", "node").agg(
        F.count(F.lit(1)).alias("_n"), F.min("next").alias("up"), F.min("rel_key").alias("rel_key"), F.min("ways").alias("ways")
    )
    return near.select("system", "node", *[F.when(F.col("_n") == 1, F.col(c)).alias(c) for c in ("up", "rel_key", "ways")])


def _homes(near: DataFrame, inner: DataFrame) -> DataFrame:
    """(system, node, component) of the tables with several neighbours, by the steps between them."""
    # A table of one system is a node of its own: length-prefixed, so that no two are written alike.
    name = lambda c: F.concat_ws(":", F.length("system").cast("string"), "system", c)
    found = connected_components(inner.select(name("low").alias("a"), name("high").alias("b")), "a", "b")
    homes = near.where("up is null").select("system", "node", name("node").alias("_n"))
    # A table that only others with one neighbour hang on goes by itself.
    homes = homes.join(_merged(found.withColumnRenamed("node", "_n")), "_n", "left")
    return homes.select("system", "node", F.coalesce("component", "_n").alias("component"))


def _reachable(pairs: DataFrame, near: DataFrame, homes: DataFrame) -> DataFrame:
    """The pairs (system, source, target) whose ends lie in one component, with the target's one neighbour and the step there.

    Every source has several neighbours. A target with one neighbour lies where that one does.
    """
    at_end = near.select("system", F.col("node").alias("target"), "up", F.col("rel_key").alias("up_key"), F.col("ways").alias("up_ways"))
    at_source = homes.select("system", F.col("node").alias("source"), F.col("component").alias("_s"))
    at_target = homes.select("system", F.col("node").alias("_tail"), F.col("component").alias("_t"))
    tailed = pairs.join(_merged(at_end), ["system", "target"]).withColumn("_tail", F.coalesce("up", "target"))
    placed = tailed.join(_merged(at_source), ["system", "source"]).join(_merged(at_target), ["system", "_tail"])
    return placed.where("_s = _t").drop("_s", "_t", "_tail")


def _expanded(last: DataFrame, before: DataFrame | None, arcs: DataFrame, open_starts: DataFrame) -> DataFrame:
    """The next level: what the arcs reach from the last one and no earlier level holds.

    Arcs go both ways, so a step from one level ends in the level before, in the same one, or in the next.
    """
    stepped = last.join(open_starts, ["system", "start"], "left_semi").join(
        _merged(arcs.withColumnRenamed("ways", "_more")), ["system", "node"]
    )
    seen = last.select(*STATE) if before is None else last.select(*STATE).unionByName(before.select(*STATE))
    new = stepped.select(
        "system", "start", F.col("next").alias("node"), F.struct(F.col("node").alias("node"), "rel_key").alias("by"),
        (F.col("ways") * F.col("_more")).alias("ways"),
    ).join(_merged(seen), STATE, "left_anti")
    # Two ways or twenty make no difference.
    return new.groupBy(*STATE).agg(F.min("by").alias("by"), F.least(F.sum("ways"), F.lit(2)).alias("ways"))


def _touching(pairs: DataFrame, from_source: DataFrame, from_target: DataFrame) -> DataFrame:
    """(system, source, target, node, _s, _t): the tables in which the outermost levels of a wanted pair meet.

    Each pair is led through the smaller of its two levels, and the other is only asked by
    equality: no table brings all pairs that touch it together, and a target that very many
    sources ask for and very many tables hang on does not meet each with each.
    """
    begins = from_source.select("system", F.col("start").alias("source"), "node", F.col("ways").alias("_s"))
    ends = from_target.select("system", F.col("start").alias("target"), "node", F.col("ways").alias("_t"))
    size = lambda level, start, n: level.groupBy("system", start).agg(F.count(F.lit(1)).alias(n))
    sized = pairs.join(size(begins, "source", "_ns"), ["system", "source"]).join(size(ends, "target", "_nt"), ["system", "target"])
    narrow = F.col("_ns") <= F.col("_nt")
    by_source = sized.where(narrow).join(_merged(begins), ["system", "source"]).join(_merged(ends), ["system", "target", "node"])
    by_target = sized.where(~narrow).join(_merged(ends), ["system", "target"]).join(_merged(begins), ["system", "source", "node"])
    return by_source.unionByName(by_target).drop("_ns", "_nt")


def _walked(ends: DataFrame, levels: list[DataFrame], kept: list[str], backwards: bool) -> list[DataFrame]:
    """(kept, hop, from_table, to_table, rel_key): the steps from each end (at, node, level) back to its start, a frame a level.

    `kept` tells the ends apart.
    """
    steps, current = [], None
    for k in range(len(levels) - 1, 0, -1):
        here = ends.where(F.col("level") == k).drop("level")
        current = here if current is None else current.unionByName(here)
        found = current.join(_merged(levels[k].select(*STATE, "by")), STATE)
        near, far = F.col("by.node"), F.col("node")
        pair = (far, near) if backwards else (near, far)
        steps.append(
            found.select(*kept, F.lit(k).alias("hop"), pair[0].alias("from_table"), pair[1].alias("to_table"), "by.rel_key")
        )
        current = found.select(*[c for c in current.columns if c != "node"], near.alias("node"))
    return steps


def _search(pairs: DataFrame, arcs: DataFrame, first_arcs: DataFrame, order: tuple[str, str], folder: str, name: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """([(system, source, target, ways, hops)], [(system, source, target, hop, from_table, to_table, rel_key)]) of pairs that have a way.

    The sides take turns in the given order. Sources take `first_arcs` if they begin.
    """

    def first(column: str) -> DataFrame:
        starts = pairs.select("system", F.col(column).alias("start")).distinct()
        none = F.lit(None).cast("struct<node:string,rel_key:string>")
        return starts.select("system", "start", F.col("start").alias("node"), none.alias("by"), F.lit(1).cast("bigint").alias("ways"))

    if pairs.isEmpty():
        return [], []
    sides = {side: [stage(first(side), folder, f"{name}_{side}_0")] for side in order}
    left, met, hops = pairs, [], 0
    while not left.isEmpty():
        side = order[hops % 2]
        hops += 1
        levels = sides[side]
        starts = left.select("system", F.col(side).alias("start")).distinct()
        steps = first_arcs if hops == 1 and side == "source" else arcs
        grown = _expanded(levels[-1], levels[-2] if len(levels) > 1 else None, steps, starts)
        levels.append(stage(grown, folder, f"{name}_{side}_{len(levels)}"))
        found = _touching(left, sides["source"][-1], sides["target"][-1]).groupBy("system", "source", "target").agg(
            F.min("node").alias("meeting"), F.sum(F.col("_s") * F.col("_t")).alias("ways")
        )
        tried = stage(left.join(found, ["system", "source", "target"], "left"), folder, f"{name}_tried_{hops}")
        met.append(tried.where("meeting is not null").withColumn("hops", F.lit(hops)))
        left = tried.where("meeting is null").select("system", "source", "target")
    every = reduce(DataFrame.unionByName, met)
    kept = ["system", "source", "target", "hops"]
    halves = every.select(*kept, F.col("meeting").alias("node"))
    # The side that began has made one level more if the number of hops is odd.
    more, less = F.expr("(hops + 1) div 2").cast("int"), F.expr("hops div 2").cast("int")
    to_start = {side: halves.select("*", F.col(side).alias("start"), n.alias("level")) for side, n in zip(order, (more, less), strict=True)}
    steps = [s.drop("hops") for s in _walked(to_start["source"], sides["source"], kept, False)]
    back = _walked(to_start["target"], sides["target"], kept, True)
    steps += [s.withColumn("hop", F.col("hops") - F.col("hop") + 1).drop("hops") for s in back]
    return [m.select(*kept, "ways") for m in met], steps


def _all(frames: list[DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def join_paths(
    wanted: DataFrame, rels: DataFrame, a: str, b: str, rel_key: str, deployments: DataFrame
) -> JoinPaths:
    """The shortest way from each key's source to all its targets, in one system.

    wanted: key, source, target (several rows per key for several targets; one source).
    rels: two tables a row, and a unique key. deployments: table_id, system.

    Of the systems that join everything a key asks for, the one with the fewest hops in
    all is taken, the smallest name on ties. Of several shortest ways the smallest meeting
    table, predecessors and relationships are taken, and the key is reported as ambiguous:
    somebody has to choose. A key without any way is reported as unreachable and has no
    hops. Targets equal to the source need none; NULLs are not looked for.

    Staged tables go as soon as no later one is made from them.
    """
    spark = wanted.sparkSession
    folder = staging_folder(spark)
    asked = wanted.where("source <> target").select("key", "source", "target").distinct()
    asked = stage(asked, folder, "asked")
    steps = stage(runnable_steps(rels, a, b, rel_key, deployments), folder, "steps")
    near = stage(_neighbours(steps), folder, "near")
    hung = near.where("up is not null").select("system", F.least("node", "up").alias("low"), F.greatest("node", "up").alias("high"))
    inner = stage(steps.join(_merged(hung), ["system", "low", "high"], "left_anti"), folder, "inner")
    unstage(spark, folder, "steps")

    # Each question is put to the source's one neighbour, or to the source itself if it has several.
    at_source = near.select("system", F.col("node").alias("source"), "up", "rel_key", "ways")
    led = asked.join(_merged(at_source), "source").select(
        "key", "system", "source", "target", F.coalesce("up", "source").alias("lead"), F.col("up").isNotNull().alias("led"),
        "rel_key", F.coalesce("ways", F.lit(1)).alias("ways"),
    )
    led = stage(led, folder, "led")
    pairs = led.where("lead <> target").select("system", F.col("lead").alias("source"), "target", "led").distinct()
    homes = stage(_homes(near, inner), folder, "homes")
    pairs = stage(_reachable(pairs, near, homes), folder, "pairs")
    unstage(spark, folder, "near", "homes")

    tails = pairs.where("up is not null").select(
        "system", F.col("target").alias("node"), F.col("up").alias("next"), F.col("up_key").alias("rel_key"), F.col("up_ways").alias("ways")
    )
    tails = stage(tails.distinct(), folder, "tails")
    arcs = stage(_both_ways(inner).unionByName(tails), folder, "arcs")
    unstage(spark, folder, "inner")
    into_tails = tails.select("system", F.col("next").alias("node"), F.col("node").alias("next"), "rel_key", "ways")
    met, ways = [], []
    # The step to the one neighbour was the source's turn, so there the targets begin.
    for was_led, order, name in ((False, ("source", "target"), "own"), (True, ("target", "source"), "led")):
        some = pairs.where(F.col("led") == was_led).select("system", "source", "target")
        found, through = _search(some, arcs, arcs.unionByName(into_tails), order, folder, name)
        met += [f.withColumn("led", F.lit(was_led)) for f in found]
        ways += [w.withColumns({"led": F.lit(was_led), "hop": (F.col("hop") + int(was_led)).cast("int")}) for w in through]
    triple = "system string, source string, target string"
    met = _all(met, spark, f"{triple}, hops int, ways bigint, led boolean")
    ways = _all(ways, spark, f"{triple}, hop int, from_table string, to_table string, rel_key string, led boolean")
    ways = stage(ways, folder, "ways")
    met = met.select("system", F.col("source").alias("lead"), "target", "led", "hops", F.col("ways").alias("_more"))
    through = led.where("lead <> target").join(_merged(met), ["system", "lead", "target", "led"])
    through = through.withColumns({"hops": F.col("hops") + F.col("led").cast("int"), "ways": F.col("ways") * F.col("_more")}).drop("_more")
    # Only a source with one neighbour is led to its target at once.
    placed = through.unionByName(led.where("lead = target").withColumn("hops", F.lit(1)))
    placed = stage(placed, folder, "placed")
    unstage(spark, folder, "led", "pairs", "tails", "arcs", *[f"{n}_{s}" for n in ("own", "led") for s in ("source_*", "target_*", "tried_*")])

    have = placed.groupBy("key", "system").agg(F.sum("hops").alias("n"), F.count(F.lit(1)).alias("_have"))
    need = asked.groupBy("key").agg(F.count(F.lit(1)).alias("_need"))
    best = have.join(_merged(need), "key").where("_have = _need").groupBy("key").agg(F.min(F.struct("n", "system")).alias("b"), F.max("_need").alias("_need"))
    best = best.select("key", F.col("b.system").alias("system"), (F.col("_need") > 1).alias("several"))
    chosen = stage(placed.join(_merged(best), ["key", "system"]).drop("hops"), folder, "chosen")
    unstage(spark, folder, "placed")

    row = ["key", "system", "several", "hop", "from_table", "to_table", "rel_key"]
    begun = chosen.where("led").select("key", "system", "several", F.lit(1).alias("hop"), F.col("source").alias("from_table"), F.col("lead").alias("to_table"), "rel_key")
    rest = chosen.where("lead <> target").select("key", "system", "several", F.col("lead").alias("source"), "target", "led")
    steps = begun.unionByName(rest.join(_merged(ways), ["system", "source", "target", "led"]).select(*row))
    # A table that two targets' ways share is joined once. The one way to a single target has each table once.
    by = F.struct("from_table", "rel_key")
    joined = steps.where("several").groupBy("key", "system", "hop", "to_table").agg(F.min(by).alias("by"), F.max(by).alias("last"))
    joined = stage(joined, folder, "hops")
    forked = joined.where("by <> last").select("key")
    out = ["key", "system", "hop", "from_table", "to_table", "rel_key"]
    hops_table = steps.where("not several").select(*out).unionByName(joined.select("key", "system", "hop", "by.from_table", "to_table", "by.rel_key"))
    unclear = chosen.where("ways > 1").select("key").union(forked).distinct()
    lost = asked.join(_merged(chosen.select("key")), "key", "left_anti")
    issues = union_issues(
        as_issues(lost, "unreachable_target", "column_mappings", F.col("key"), F.concat_ws(" to ", "source", "target")),
        as_issues(unclear, "ambiguous_path", "column_mappings", F.col("key"), F.lit("several shortest ways")),
    )
    return JoinPaths(hops_table, issues)


def described(paths: JoinPaths, rels: DataFrame, rel_key: str) -> DataFrame:
    """The hops with name, condition and cardinality of their relationship, the last told from the hop's own side."""
    flip = F.create_map(*[F.lit(x) for pair in FLIPPED_CARDINALITY.items() for x in pair])
    told = rels.select(F.col(rel_key).alias("rel_key"), "relationship_name", "join_condition", "table_a_id", F.col("cardinality").alias("_c"))
    rows = paths.hops.join(told, "rel_key")
    seen = F.when(F.col("from_table") == F.col("table_a_id"), F.col("_c")).otherwise(F.try_element_at(flip, F.col("_c")))
    return rows.withColumn("cardinality", seen).drop("table_a_id", "_c")


def joins_of(hops: DataFrame, key: str) -> list[tuple[str, str]]:
    """The joins of one mapping in the order to make them: (table, condition). One mapping names a handful of tables."""
    rows = hops.where(F.col("key") == key).select("hop", "to_table", "join_condition").collect()
    return [(r["to_table"], r["join_condition"]) for r in sorted(rows)]
