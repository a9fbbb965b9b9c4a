"""Connected components by contraction: each round hooks every node to its smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` for every node of ``edges`` (a, b: long); equal labels, same component.

    A round ties each node to its smallest neighbour, follows these ties to their roots by doubling, and
    keeps the edges whose roots differ: at most half of the nodes are left each time, and long paths take
    few steps. A hub is only a join key with one row on its other side. Edges with NULL ends are left out.
    """
    left = checkpointed(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels: DataFrame | None = None
    while True:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = checkpointed(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")))
        while True:
            further = hooked.select(F.col("node").alias("label"), F.col("label").alias("next"))
            doubled = checkpointed(hooked.join(further, "label").select("node", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved")))
            hooked = doubled.select("node", "label")
            if doubled.where("moved").isEmpty():
                break
        if labels is None:
            labels = hooked
        else:
            moved = hooked.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = checkpointed(labels.join(moved, "label", "left").select("node", F.coalesce("next", "label").alias("label")))
        a = hooked.select(F.col("node").alias("a"), F.col("label").alias("x"))
        b = hooked.select(F.col("node").alias("b"), F.col("label").alias("y"))
        mapped = left.join(a, "a").join(b, "b").where("x <> y")
        left = checkpointed(mapped.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if left.isEmpty():
            return labels
