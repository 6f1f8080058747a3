"""Connected components of a link table by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framespan.llm._common import discard, written


def are_stars(links: DataFrame) -> bool:
    """Whether every node is either the end of links or the start of one alone."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(links.select("b", F.lit(0), F.lit(1)))
    return not ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 OR (out > 0 AND into > 0)").limit(1).count()


def components(links: DataFrame) -> DataFrame:
    """node and root (the least node that it can reach) of every node of links (a, b).

    Each round moves every node's links to its least neighbour; stars are reached after a logarithmic number of rounds,
    and links that are stars already need none.  Neighbours are never collected.  A round is a minimum by node, with
    partial sums, and a join of the links with one row a node; a hub's links meet in that join, where Spark's adaptive
    plan splits them, as the other side is one row."""
    stars = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    stars = written(stars)
    while not are_stars(stars):
        both = stars.union(stars.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        last, stars = stars, written(small)
        discard(last)
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(stars.select(F.col("b"), F.col("b")).distinct())
