"""Connected components by contraction: only minima are taken per node, never neighbour lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldtrace.session import materialise


def _both_ways(edges: DataFrame) -> DataFrame:
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.select("a", "b").unionByName(turned)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b: long), the component by its smallest node.

    In each round a node joins the neighbour, or itself, that comes first in an order drawn for the
    round; joined nodes become one and the edges between them go. Drawn orders shrink long chains
    as well as stars by a constant share, so the rounds follow the logarithm of the graph. Every
    round is written to the shared folder. NULL ends and loops are no edges.
    """
    kept = edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
    left = materialise(kept.filter("a != b").distinct())
    steps: list[DataFrame] = []
    while not left.isEmpty():
        order = lambda c: F.xxhash64(F.lit(len(steps)), c)  # noqa: E731, B023
        nearest = _both_ways(left).groupBy("a").agg(
            F.min(F.struct(order(F.col("b")).alias("o"), F.col("b").alias("b"))).alias("best")
        )
        joins = F.when(F.col("best.o") < order(F.col("a")), F.col("best.b")).otherwise(F.col("a"))
        step = materialise(nearest.select(F.col("a").alias("node"), joins.alias("into")))
        steps.append(step)
        ends = left
        for end in ("a", "b"):
            renamed = step.select(F.col("node").alias(end), F.col("into").alias(f"{end}_into"))
            ends = ends.join(renamed, end)
        left = materialise(
            ends.select(F.col("a_into").alias("a"), F.col("b_into").alias("b"))
            .filter("a != b")
            .distinct()
        )
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = steps[0]
    for step in steps[1:]:
        further = step.select(F.col("node").alias("into"), F.col("into").alias("further"))
        found = found.join(further, "into", "left").select(
            "node", F.coalesce("further", "into").alias("into")
        )
    found = materialise(found)
    smallest = found.groupBy("into").agg(F.min("node").alias("component"))
    return materialise(found.join(smallest, "into").select("node", "component"))
