"""Connected components of a graph given as edges, by alternating stars.

Every step is a grouped minimum and a join on the grouping key; the minimum is
combined before its shuffle and the join is one that adaptive execution can split,
so a node with very many neighbours does not meet in one task. No edge list ever
leaves the executors; the driver sees one count and one checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the larger neighbours of each node under its smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    both = both.toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("root"))
    least = least.select("node", F.least("node", "root").alias("root"))
    hung = both.where(F.col("other") > F.col("node")).join(least, "node")
    return hung.select(F.col("other").alias("high"), F.col("root").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours under the smallest of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("root"))
    moved = edges.join(least, "high").where(F.col("low") != F.col("root"))
    return (
        moved.select(F.col("low").alias("high"), F.col("root").alias("low"))
        .unionByName(least.select("high", F.col("root").alias("low")))
        .distinct()
    )


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(high, low))")).first())


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``: root is the smallest node
    that can be reached. Loops, repeated edges and either direction are allowed."""
    current = scratch.save(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .distinct(),
        "edges0",
    )
    step, seen = 0, _signature(current)
    while seen[0]:
        step += 1
        large = scratch.save(_large_star(current), f"large{step}")
        current = scratch.save(_small_star(large), f"edges{step}")
        scratch.drop(f"large{step}", f"edges{step - 1}")
        last, seen = seen, _signature(current)
        if seen == last:
            break
    roots = current.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    return current.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(roots)
