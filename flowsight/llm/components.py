"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest of its neighbourhood."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("node"), F.least("u", "m").alias("m"))
    return (
        both.filter(F.col("v") > F.col("u"))
        .join(least, F.col("u") == F.col("node"))
        .select(F.col("v").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every node (a > b) hands itself and its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node")
    joined = links.join(least, F.col("a") == F.col("node"))
    to_least = joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select(F.col("node").alias("a"), F.col("m").alias("b")).union(to_least).distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Links are pairs of longs in any order, repeated or reflexive ones are harmless; rows with a
    null are left out. Every round is written to the shared folder; the number of rounds grows
    with the logarithm of the graph's size. Only a count and a checksum reach the driver.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    stars = links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).filter(
        x.isNotNull() & y.isNotNull() & (x != y)
    )
    stars, before = written(stars.distinct(), "links"), None
    while True:
        state = stars.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("check"),
        ).first()
        if state == before or state["n"] == 0:
            break
        before = state
        stars = written(_small_star(_large_star(stars)), "stars")
    roots = stars.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
