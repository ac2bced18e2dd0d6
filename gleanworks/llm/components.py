"""Connected components by contraction to the least neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanworks.llm.common import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges(u, v), longs; the component is one of its nodes.

    Each round sends every node to the least of itself and its neighbours and keeps the edges
    between different targets. Where ids are hashes, a round leaves a fraction of the nodes, so the
    rounds grow with the logarithm of the graph. Hubs meet only in sums with partial results and in
    joins whose large partitions Spark can split.
    """
    edges = durable(edges.where("u <> v").distinct())
    steps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        to = durable(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("to")))
        steps.append(to)
        left = edges.join(to, "u").select(F.col("to").alias("a"), "v")
        right = to.select(F.col("u").alias("v"), F.col("to").alias("b"))
        edges = durable(left.join(right, "v").where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    if not steps:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out = steps[0].select(F.col("u").alias("node"), F.col("to").alias("component"))
    for to in steps[1:]:
        on = to.select(F.col("u").alias("component"), "to")
        out = out.join(on, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return durable(out)
