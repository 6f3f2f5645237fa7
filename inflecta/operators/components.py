"""Connected parts of a link table, by alternating star steps.

Each step is one minimum per node, combined before the shuffle, and one join; the number of steps grows with the
logarithm of the longest chain. Nothing is gathered per node, so a node with many links is no group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inflecta.session import durable


def connected_parts(links: DataFrame) -> DataFrame:
    """(node, part): for each node of ``links`` (a, b) the least node it is connected with."""
    current = durable(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before, now = None, state(current)
    while now != before:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = durable(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        lesser = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lesser, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = durable(small.unionByName(lesser.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        before, now = now, state(current)
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("part"))
    return stars.unionByName(stars.select(F.col("part").alias("node"), "part").distinct())
