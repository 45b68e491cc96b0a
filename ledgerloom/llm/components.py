"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of the links (a, b), both longs; nodes with one
    root are connected. Each round merges every node into the neighbour that comes first
    in an order drawn anew for the round, and keeps the links between what is left, so
    the graph shrinks by a constant share. Sums by node are combined before a shuffle."""
    links = written(links.select("a", "b").filter("a != b").distinct(), "links")
    labels, turn = None, 0
    while not links.isEmpty():
        turn += 1
        order = F.struct(F.xxhash64("b", F.lit(turn)).alias("h"), F.col("b").alias("node"))
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        own = both.select(F.col("a"), F.col("a").alias("b")).distinct().unionByName(both)
        step = written(own.groupBy("a").agg(F.min(order).alias("m")).select("a", F.col("m.node").alias("to")), "step")
        if labels is None:
            labels = step.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            moved = labels.join(step.withColumnRenamed("a", "root"), "root", "left")
            labels = written(moved.select("node", F.coalesce("to", "root").alias("root")), "labels")
        head = step.select("a", F.col("to").alias("x"))
        tail = step.select(F.col("a").alias("b"), F.col("to").alias("y"))
        merged = links.join(head, "a").join(tail, "b").filter("x != y")
        links = written(merged.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
