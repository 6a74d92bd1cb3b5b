"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes in ``links`` (a, b): the least node in reach.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours, then itself and its smaller ones, to the least node it knows. Each
    step is an aggregation and a join, a stored table cuts the lineage, and the
    number of rounds grows with the logarithm of the longest path.
    """
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = materialise(links.filter(F.col("a") != F.col("b")).distinct())
    before = None
    while True:
        links = materialise(_small_star(_large_star(links)))
        now = links.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.countDistinct("a")
        ).first()
        if now == before:
            break
        before = now
    found = links.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return found.unionByName(
        links.select(F.col("a").alias("node"), F.col("a").alias("component"))
    ).distinct()


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = _least(both).withColumn("least", F.least("u", "least"))
    larger = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return larger.select(F.col("least").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = _least(down)
    handed = down.join(least, "u").select(F.col("least").alias("a"), F.col("v").alias("b"))
    own = least.select(F.col("least").alias("a"), F.col("u").alias("b"))
    return handed.unionByName(own).filter(F.col("a") != F.col("b")).distinct()
