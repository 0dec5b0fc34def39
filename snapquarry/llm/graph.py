"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, store


def components(edges: DataFrame) -> DataFrame:
    """node, root for each end of edges(a, b), both long hashes; nodes are connected iff their roots are equal.

    Each round hangs every node under its smallest neighbour, if that is smaller than itself, and goes on with the edges
    between different parents. Nodes are hashes, so their order is random along a path and rounds are few; a star whose
    hub is smallest takes one. Only minima per node are taken, so a node with very many neighbours is summed up before
    it is shuffled. What each round leaves is written to the shared folder, and no plan grows with the rounds."""
    left = store(edges.filter("a <> b").distinct(), "edges")
    label = store(left.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")), "labels")
    while not left.isEmpty():
        ends = left.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        parent = store(ends.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("up")), "parents")
        one, two = parent.select(F.col("node").alias("a"), F.col("up").alias("x")), parent.select(F.col("node").alias("b"), F.col("up").alias("y"))
        moved = left.join(one, "a").join(two, "b").filter("x <> y")
        last, left = left, store(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        up = parent.select(F.col("node").alias("root"), "up")
        old, label = label, store(label.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "labels")
        discard(last, parent, old)
    discard(left)
    return label
