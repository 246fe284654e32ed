"""Connected components of links held as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b of any orderable type): the smallest node it is joined with.

    Rounds of two steps: every node hands its smallest neighbour to its larger ones, then to its smaller ones, until the
    links form stars about their smallest nodes. Rounds grow with the logarithm of the longest chain. Each round is
    written to the shared folder; a node with very many links is only ever a key of a combining minimum and of a join
    that can be split.
    """
    edges = cut(links.select("a", "b").where("a <> b").distinct(), "links")
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # every link now points from a larger to a smaller node: `a` keeps its smallest, the others are tied to that
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = cut(low.select("a", F.col("m").alias("b")).union(tied).distinct(), "links")
        edges = after
        points_on = after.select("a").distinct().join(after.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        points_twice = after.groupBy("a").count().where("count > 1").select("a")
        if points_on.union(points_twice).isEmpty():
            break
    stars = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.union(roots)
