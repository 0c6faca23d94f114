"""Connected components of an undirected graph, and the linkability check built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder
from catalith.issues import as_issues
from catalith.operators.venues import documented_parts
from catalith.skew import spread_join


def _neighbour_minimum(arcs: DataFrame) -> DataFrame:
    return arcs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    arcs = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = spread_join(arcs, _neighbour_minimum(arcs), ["u"], spread_by=["v"], grouped=True)
    return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of these neighbours."""
    lows = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = spread_join(edges, lows, ["u"], spread_by=["v"], grouped=True)
    moved = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lows.select("u", F.col("m").alias("v"))).distinct()


def _is_settled(edges: DataFrame) -> bool:
    """Every node hangs on one parent, and no parent hangs on another node: told by one grouping of all ends."""
    ends = edges.select("u", F.lit(1).alias("hangs")).union(edges.select("v", F.lit(0)))
    seen = ends.groupBy("u").agg(F.sum("hangs").alias("hangs"), F.min("hangs").alias("low"))
    return seen.where((F.col("hangs") > 1) | ((F.col("hangs") > 0) & (F.col("low") == 0))).isEmpty()


def _fingerprint(edges: DataFrame) -> tuple:
    """Equal for equal edges, and seldom for others: one number a task, where comparing edges shuffles all of them."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with an edge; a component is named by its smallest node.

    Alternating large-star and small-star rounds (Kiveris et al., SoCC 2014)
    need a number of rounds that grows with the logarithm of the graph, not
    with its diameter. Hubs are spread over tasks. Each round becomes a table in
    the checkpoint folder: that cuts the lineage, survives lost executors, and
    gives the next round the real size instead of an estimate that multiplies
    from round to round.
    """
    folder = staging_folder(edges.sparkSession)
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    current = stage(pairs.where(F.col("u") != F.col("v")).distinct(), folder, "round_0")
    rounds, print_before = 0, None
    while not _is_settled(current):
        rounds += 1
        moved = stage(_small_star(_large_star(current)), folder, f"round_{rounds}")
        print_after = _fingerprint(moved)
        same, print_before = print_after == print_before, print_after
        if same and moved.exceptAll(current).isEmpty() and current.exceptAll(moved).isEmpty():
            raise RuntimeError(f"components are not settled, but round {rounds} changed nothing")
        current = moved
    named = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(named, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def updated_components(
    labels: DataFrame, edges: DataFrame, a: str, b: str, inserted: DataFrame, deleted: DataFrame
) -> DataFrame:
    """What `connected_components(edges)` would give, from the labels before an edit.

    `labels` (node, component) are those of the edges before; `edges` are all edges after;
    `inserted` and `deleted` are the difference. Only components that lost an edge are
    searched anew, inside themselves. Inserted edges then are edges between components:
    the components they join are found on that small graph, and renamed. Everything else
    keeps its label unread, but for one join that a rename needs.

    Edges may repeat and may join a node to itself. An edge counts as lost as soon as it is
    in `deleted`, even if an equal one is left; that costs work, never a wrong label.
    """
    spark = edges.sparkSession
    folder = staging_folder(spark)

    def ends(df: DataFrame) -> DataFrame:
        return df.select(F.explode(F.array(a, b)).alias("node")).distinct()

    lost = ends(deleted).join(labels, "node").select("component").distinct()
    lost = stage(lost, folder, "lost")
    if lost.isEmpty():
        kept = labels
    else:
        kept = labels.join(lost, "component", "left_anti").select("node", "component")
        torn = labels.join(lost, "component", "left_semi").select("node")
        # All edges of a torn component's nodes: both ends lie in it, or one is new and comes by an inserted edge.
        own = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        inside = own.join(torn.withColumnRenamed("node", "u"), "u", "left_semi").join(torn.withColumnRenamed("node", "v"), "v", "left_semi")
        kept = kept.unionByName(connected_components(inside, "u", "v"))
    kept = stage(kept, folder, "kept")
    new = inserted.select(F.col(a).alias("u"), F.col(b).alias("v"))
    if new.isEmpty():
        return kept
    home = lambda name: kept.select(F.col("node").alias(name), F.col("component").alias(f"{name}_home"))
    placed = new.join(home("u"), "u", "left").join(home("v"), "v", "left")
    joined = placed.select(F.coalesce("u_home", "u").alias("u"), F.coalesce("v_home", "v").alias("v")).distinct()
    merged = stage(connected_components(joined, "u", "v").toDF("component", "_into"), folder, "merged")
    fresh = ends(inserted).join(kept.select("node"), "node", "left_anti").withColumn("component", F.col("node"))
    renamed = kept.unionByName(fresh).join(merged, "component", "left")
    return renamed.select("node", F.coalesce("_into", "component").alias("component"))


def linkable_tables(
    exprs: DataFrame, tables_col: str, key: str, components: DataFrame, tables: DataFrame
) -> DataFrame:
    """Expressions over several tables that the relationship graph does not connect."""
    several = exprs.where(F.size(tables_col) > 1)
    parts = documented_parts(several, tables_col, key, tables)
    placed = spread_join(
        parts, components.withColumnRenamed("node", "table_id"), ["table_id"], "left", spread_by=["expr_key"]
    )
    home = F.coalesce("component", "table_id")
    apart = placed.groupBy("expr_key").agg(
        F.min(home).alias("low"), F.max(home).alias("high"), F.count(F.lit(1)).alias("_known"), F.max("n_tables").alias("_n")
    )
    return as_issues(
        apart.where((F.col("low") != F.col("high")) & (F.col("_known") == F.col("_n"))), "linkable_tables", "column_mappings", F.col("expr_key"),
        F.concat_ws(" and ", "low", "high"),
    )
