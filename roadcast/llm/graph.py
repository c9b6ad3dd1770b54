"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from roadcast.llm.tables import settle


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``: root is the smallest node it
    is connected with.

    Rounds shrink the graph to stars. Each is written to the shared folder, and no
    node's neighbours are ever gathered: only their minimum is.
    """
    found = settle(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    while True:
        both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Every larger neighbour is tied to the least of the neighbourhood.
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        # Then a node's smaller neighbours are tied to the least of them.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        tied = lowest.select("a", F.col("m").alias("b")).unionByName(small).distinct()
        found = settle(tied, "edges")
        children = found.select("a").distinct()
        # Stars: no node has two parents, and no parent has one.
        total = found.count()
        if total == children.count() and found.join(children.withColumnRenamed("a", "b"), "b", "left_semi").isEmpty():
            roots = found.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
            return found.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
