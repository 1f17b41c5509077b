"""Connected components of a set of links, by alternating large-star and small-star rounds.

Both rounds are one grouped minimum (combined before the shuffle) and one join, so a node with very
many links is never collected in one task. The links of each round are written to the shared folder;
the rounds stop when the links no longer change, which then point from each node to the smallest node
of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist.session import materialize


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(low, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(a, b) links with a > b, in any number and order -> (node, root) for every node that is not a root itself."""
    links = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while (now := _mark(links)) != before:
        before = now
        links = materialize(_small_star(materialize(_large_star(links), "large-star")), "small-star")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
