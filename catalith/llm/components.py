"""Components of a link table: union-find inside each task, then rounds between tasks.

Links with a null end are left out. Repeated links and links of a node to itself count for
nothing more; a node with no other link than to itself has no row. No links give no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Nodes a task holds in its forest before it passes the forest on and starts a new one.
FOREST_NODES = 500_000


class Forest:
    """Union-find with path halving; the smallest node of a tree is its root."""

    def __init__(self):
        self.parent: dict = {}

    def root(self, x):
        parent = self.parent
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x, y) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


def _forests(links: DataFrame) -> DataFrame:
    """The links (a, b), each task's replaced by (node, root) of the trees they form."""
    kind = links.schema["a"].dataType.simpleString()

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, t = Forest(), None

        def rows() -> pa.RecordBatch:
            nodes = [x for x in forest.parent if forest.root(x) != x]
            return pa.record_batch([pa.array(nodes, t), pa.array([forest.root(x) for x in nodes], t)], ["a", "b"])

        for batch in batches:
            t = batch.schema.field(0).type
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                forest.join(a, b)
            if len(forest.parent) > FOREST_NODES:
                yield rows()
                forest = Forest()
        if forest.parent:
            yield rows()

    return links.select("a", "b").mapInArrow(unite, f"a {kind}, b {kind}")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of each node with a link; the smallest node names the component.

    Each round every node takes the least label around it, then the label of that label.
    Labels only fall, and a round that changes none ends the work.
    """
    folder = staging_folder(links.sparkSession)
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    trees = stage(_forests(pairs), folder, "trees")
    arcs = trees.select("a", "b").unionByName(trees.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stage(arcs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")), folder, "labels_0")
    turn = 0
    while True:
        turn += 1
        seen = arcs.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(seen, "a").select("a", F.least("label", "near").alias("low"), "label")
        jumps = labels.select(F.col("a").alias("low"), F.col("label").alias("far"))
        moved = lower.join(jumps, "low").select("a", F.least("low", "far").alias("new"), "label")
        moved = stage(moved, folder, f"labels_{turn}")
        if moved.where("new <> label").isEmpty():
            return labels.select(F.col("a").alias("node"), F.col("label").alias("component"))
        labels = moved.select("a", F.col("new").alias("label"))
