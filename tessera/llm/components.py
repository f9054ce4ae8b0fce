"""Connected components of a link table, as rounds of joins.

Alternates two star contractions: every node hands its larger neighbours, then
its smaller ones, to its smallest neighbour.  Links turn into stars around the
smallest node of each component in O(log^2 n) rounds; each round is landed, so
lost executors only repeat a round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import land


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none of its own."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    counted = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return counted.where("out > 1 OR (out = 1 AND into = 1)").isEmpty()


def components(edges: list[DataFrame]) -> DataFrame:
    """(node, root) for every node of the links (columns a, b); root is the
    smallest node of the component.  Nodes without links do not appear."""
    now = reduce(DataFrame.union, [e.select("a", "b") for e in edges]).where("a <> b")
    now = land(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _are_stars(now):
        now = land(_small_star(_large_star(now)), "stars")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
