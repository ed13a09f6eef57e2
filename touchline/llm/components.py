"""Connected components of an edge list, by rounds of written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from touchline.session import Scratch


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """(v, c) for every vertex of edges (a, b): c is the smallest vertex it is linked with.

    Each round takes the least label among the neighbours and then that label's own label,
    so chains shorten by more than half; a round that changes nothing is the last.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = scratch.write(both.toDF("v", "w"), f"{name}-edges")
    labels = scratch.write(both.groupBy("v").agg(F.least("v", F.min("w")).alias("c")), f"{name}-0")
    step = 0
    while True:
        step += 1
        of = labels.withColumnsRenamed({"v": "w", "c": "cw"})
        near = both.join(of, "w").groupBy("v").agg(F.min("cw").alias("low"))
        lower = labels.join(near, "v").select("v", "c", F.least("c", "low").alias("n"))
        jump = labels.withColumnsRenamed({"v": "n", "c": "cn"})
        moved = lower.join(jump, "n").select("v", "c", F.least("n", "cn").alias("n"))
        moved = scratch.write(moved, f"{name}-{step}")
        labels = moved.select("v", F.col("n").alias("c"))
        if moved.where("n <> c").isEmpty():
            return labels
