"""Connected components of a table of links, by alternating large and small stars, on Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.common import discard, written


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_stars(edges: DataFrame) -> DataFrame:
    """Half a round: every node's larger neighbours are tied to its least neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return large.where("a <> b").distinct()


def _small_stars(large: DataFrame) -> DataFrame:
    """The other half: every node's smaller neighbours, and itself, are tied to the least of them."""
    down = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    tied = down.select("a", F.col("m").alias("b"))
    return tied.unionByName(small).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node reached, of every node of ``edges`` (``a``, ``b``) that is not least itself.

    Every round is written, so a lost executor costs one round; two numbers a
    round reach the driver.
    """
    tidy = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = written(tidy, "links")
    before = None
    while (now := _signature(current)) != before:
        before = now
        if not now[0]:
            break
        large = written(_large_stars(current), "stars")
        following = written(_small_stars(large), "links")
        discard(current, large)
        current = following
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
