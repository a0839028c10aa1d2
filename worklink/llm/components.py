"""Connected components of a distributed graph by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklink.llm.common import released, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is its smallest node.

    Each round gives every node the smallest label among itself and its neighbours and
    contracts the graph accordingly. Stars, chains and groups of any size shrink to a
    point in a few rounds; the smallest node of a component never changes its label. Edges and
    labels are tables in the shared folder, each deleted when the next one is written; only counts reach the driver. Loops and
    repeated edges do no harm, no edges give no rows.
    """
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
    pairs = stored(pairs, "edges")
    labels = None
    while not pairs.isEmpty():
        # neighbours are counted on both ends, pre-aggregated where the rows are
        ends = pairs.select(F.col("b").alias("node"), F.col("a").alias("low")).unionByName(
            pairs.select(F.col("a").alias("node"), F.col("a").alias("low")))
        step = stored(ends.groupBy("node").agg(F.min("low").alias("low")), "step")
        if labels is None:
            labels = stored(step.select("node", F.col("low").alias("component")), "labels")
        else:
            moved = labels.join(step.withColumnRenamed("node", "component"), "component", "left")
            before, labels = labels, stored(moved.select("node", F.coalesce("low", "component").alias("component")), "labels")
            released(before)
        left = step.select(F.col("node").alias("a"), F.col("low").alias("c"))
        right = step.select(F.col("node").alias("b"), F.col("low").alias("d"))
        moved = pairs.join(left, "a").join(right, "b").select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b"))
        before, pairs = pairs, stored(moved.filter("a <> b").distinct(), "edges")
        released(before, step)
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)


def spanning(pairs_a, pairs_b):
    """A spanning forest of some edges held in one task: those that join two trees."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(pairs_a, pairs_b):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            yield a, b
