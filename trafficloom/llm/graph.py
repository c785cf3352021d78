"""Connected components of an edge table, by alternating star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficloom.llm.common import stored

#: Edges a task takes at least; rounds over few edges need few tasks.
TASK_EDGES = 200_000


def components(edges: DataFrame) -> DataFrame:
    """For edges (a, b) of longs, one row (node, root) per node; the root is the
    smallest node of the component and has a row of its own.

    Each round hangs all larger neighbours of a node on its smallest one and then all
    smaller ones, until every node hangs on a root directly. A node's smallest neighbour
    comes from a grouped minimum joined back, so no neighbourhood is gathered. Rounds grow
    with the logarithm of the longest path. The tables between the rounds are stored; only
    counts reach the driver.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = stored(pairs.distinct(), "component-edges")
    while _unsettled(current):
        tasks = max(1, current.count() // TASK_EDGES)
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = large.distinct().coalesce(tasks)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        moved = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        joined = moved.union(small.select("u", F.col("m").alias("v"))).coalesce(tasks)
        current = stored(joined.distinct().coalesce(tasks), "component-edges")
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(current.select("v", "v").distinct())


def _unsettled(edges: DataFrame) -> bool:
    """Whether a node hangs on two others, or on one that hangs itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    sums = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return not sums.filter("hangs > 1 OR hangs > 0 AND holds > 0").isEmpty()
