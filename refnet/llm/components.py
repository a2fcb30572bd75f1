"""Connected components of an undirected graph given by its edges, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refnet.llm.common import stored


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) for every node of an edge (a, b): label is the smallest node that can be reached.

    Each step hooks every node that has a smaller neighbour to the smallest one, follows one more hook, and renames the
    edges by it; renamed edges that join a node to itself go. Steps are about the logarithm of the longest path. Every
    step's small tables are written to the shared folder.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    graph = stored(edges.distinct(), name)
    nodes = graph.select(F.col("a").alias("node")).union(graph.select("b")).distinct().withColumn("label", F.col("node"))
    while not graph.isEmpty():
        hooks = stored(graph.groupBy("b").agg(F.min("a").alias("a")), name)
        next_ = hooks.select(F.col("b").alias("_b"), F.col("a").alias("_to"))
        hooks = stored(hooks.join(next_, F.col("a") == F.col("_b"), "left").select(F.col("b").alias("_from"), F.coalesce("_to", "a").alias("_to")), name)
        nodes = nodes.join(hooks, F.col("label") == F.col("_from"), "left").select("node", F.coalesce("_to", "label").alias("label"))
        one = graph.join(hooks, F.col("a") == F.col("_from"), "left").select(F.coalesce("_to", "a").alias("a"), "b")
        two = one.join(hooks, F.col("b") == F.col("_from"), "left").select("a", F.coalesce("_to", "b").alias("b"))
        graph = stored(two.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), name)
    return stored(nodes, name)
