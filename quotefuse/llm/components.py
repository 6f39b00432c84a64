"""Connected components of a graph given as edges, by alternating large-star
and small-star steps. Every step is a partially aggregated minimum and an
equi-join, so a node with very many neighbours is never gathered in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotefuse.llm.common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links the larger (or the smaller) neighbours of each node to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else \
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = both.join(least, "a")
    if large:
        out = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the
    least node of the component. Self-loops and repeated edges are allowed."""
    now = saved(edges.where(F.col("a") != F.col("b"))
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        # a forest of stars is a fixed point: no node is both above and below
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (state["n"], state["s"]) == mark or state["n"] == 0:
            break
        mark = (state["n"], state["s"])
        now = saved(_star(_star(now, large=True), large=False), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
