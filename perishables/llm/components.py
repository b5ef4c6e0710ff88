"""Connected components of a distributed edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perishables.llm.common import store


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
        F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to ``(node, root)``: the smallest node that each node reaches.

    Every step sends each node's least neighbour along its edges: an aggregation with
    partial minima and a join, so that no node's neighbours are gathered (the minima are written first, so that
    the join can split a node with very many edges).  Steps repeat until the edges are stars around their least
    nodes; each step's edges are written and read again.
    Nodes without an edge to another node are not listed.
    """
    now = store(edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "components")
    while True:
        pairs = _both_ways(now)
        least = store(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "components-least")
        large = store(pairs.filter(F.col("v") > F.col("u")).join(least, "u")
                      .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "components-large")
        least = store(large.groupBy("a").agg(F.min("b").alias("m")), "components-least")
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")) \
            .select("e.a", "e.b").filter(F.col("a") != F.col("b")).distinct()
        new = store(small, "components")
        # the steps end where no edge is new and none has gone
        same = new.unionAll(now).groupBy("a", "b").count().filter(F.col("count") != 2).isEmpty()
        now = new
        if same:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
