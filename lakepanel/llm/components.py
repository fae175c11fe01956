"""Connected components of an undirected graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for edges ``a, b`` of long ids.

    Every round maps each node of the graph to its smallest neighbour (or
    itself), follows that map eight steps, and contracts the edges by it.  All
    of it is joins and aggregates with map-side combining; the driver learns
    only whether edges are left.  Rows with a null and loops are ignored; an
    empty table gives an empty result.
    """
    left = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    labels = left.select(F.col("a").alias("node")).union(left.select(F.col("b").alias("node"))).distinct()
    labels = labels.withColumn("component", F.col("node"))
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("x"), F.least("a", "b").alias("y"))
        step = stored(step, "steps")
        for _ in range(3):
            onward = step.select(F.col("x").alias("y"), F.col("y").alias("z"))
            step = step.join(onward, "y", "left").select("x", F.coalesce("z", "y").alias("y"))
        step = stored(step, "steps")
        named = step.select(F.col("x").alias("component"), "y")
        labels = labels.join(named, "component", "left").select("node", F.coalesce("y", "component").alias("component"))
        labels = stored(labels, "labels")
        ends = step.select(F.col("x").alias("a"), F.col("y").alias("c")), step.select(F.col("x").alias("b"), F.col("y").alias("d"))
        left = left.join(ends[0], "a").join(ends[1], "b").where("c <> d")
        left = left.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct()
        left = stored(left, "edges")
    return labels
