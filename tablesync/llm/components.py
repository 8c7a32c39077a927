"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import counted, parts_for, stage

MAX_ROUNDS = 60
EDGES_PER_PART = 250_000


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: every node points to one node, which points
    to none.  One row a task and node goes through the shuffle."""
    ends = edges.select("a", F.lit(1).alias("child"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("b").alias("a"), F.lit(0).alias("child"), F.lit(1).alias("root")))
    nodes = ends.groupBy("a").agg(F.sum("child").alias("child"), F.max("root").alias("root"))
    return nodes.filter("child > 1 or (child = 1 and root = 1)").isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node
    of a link; ``a`` and ``b`` are integers.  The number of rounds is
    logarithmic in the longest path; each round is written to the shared
    checkpoint folder.  Minima are combined in each task and written down before
    the edges meet them, so a node with many edges splits in that join."""
    edges, n = counted(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a != b").distinct(), "cc")
    for _ in range(MAX_ROUNDS):
        if n == 0 or _settled(edges):
            break
        parts = parts_for(n, EDGES_PER_PART)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (both.filter("b > a").join(stage(low, "cc-low", parts), "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct())
        large = stage(large, "cc", parts)
        low = stage(large.groupBy("a").agg(F.min("b").alias("m")), "cc-low", parts)
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b")))
                 .filter("a != b").distinct())
        edges, n = counted(small, "cc", parts)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
