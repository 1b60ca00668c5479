"""Connected components of an edge table, by alternating star steps; nothing reaches the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm.staging import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node points its larger neighbours to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``; the component is its smallest node.

    Steps repeat until nothing changes, about as often as the logarithm of the longest path.
    Every step is written to the shared folder. No edges give no rows.
    """
    edges = staged(edges.select("a", "b").where("a <> b").distinct(), "component-edges")
    before = None
    while True:
        edges = staged(_small_star(_large_star(edges)).distinct(), "component-edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
