"""Connected components by alternating large and small stars: windows and minima only, one table a round
written to the shared folder, no component ever gathered in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import few, materialize


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), any direction, repeats and loops allowed -> (node, component): the smallest node
    that each node of a proper edge reaches."""
    edges = materialize(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    of = Window.partitionBy("a")
    seen = None
    while seen != (seen := edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()) and seen[0]:
        # large star: larger neighbours of a node meet the smallest of it and its neighbours
        both = few(edges, seen[0]).select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
        large = few(both.withColumn("m", F.least(F.min("b").over(of), F.col("a"))).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")), seen[0])
        # small star: smaller neighbours of a node, and the node, meet the smallest of them
        down = few(large.withColumn("m", F.min("b").over(of)), seen[0])
        ends = F.array(F.when(F.col("b") != F.col("m"), F.col("b")), F.col("a"))
        down = down.select(F.explode(F.array_compact(ends)).alias("a"), F.col("m").alias("b"))
        edges = materialize(few(down.distinct(), seen[0]), "stars")
    # Every edge now leads from a node to the smallest of its component.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
