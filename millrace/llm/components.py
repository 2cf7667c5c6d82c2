"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.scratch import drop_staged, stage


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Each node links its larger (or smaller) neighbours to the least of its neighbourhood."""
    if small:
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = around.join(least, "u")
    if small:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    else:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.where("a != b").distinct()


def connected(links: DataFrame) -> DataFrame:
    """node and label (the least node of its component) for every node of ``links`` (a, b).

    Each step is one aggregation and one join on the node, which Spark may split where a node has
    many links; the number of steps grows with the logarithm of the size of a component.
    """
    edges = stage(links.select("a", "b").where("a != b").distinct(), "edges")
    previous = None
    while True:
        large = stage(_star(edges, small=False), "large-star")
        after = stage(_star(large, small=True), "small-star")
        now = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop_staged(edges, large)
        edges = after
        if now == previous:
            break
        previous = now
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stage(labels.union(edges.select("b", "b").distinct()), "labels")
