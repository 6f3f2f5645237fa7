"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a minimum per node (combined before the shuffle) and one join; the number of steps grows with the
logarithm of the longest chain. Nothing is collected but the two numbers that tell whether a step changed anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inflecta.llm.common import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component): the least node reachable, for each node of edges (a, b); others are their own component."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, step = scratch.save(edges, f"{name}-0"), 0
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        # Large star: greater neighbours of a are tied to the least of a's neighbourhood.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.save(large, f"{name}-{step + 1}-large")
        # Small star: lesser neighbours of a, and a itself, are tied to the least of them.
        lesser = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lesser, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(lesser.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        following = scratch.save(small, f"{name}-{step + 1}")
        scratch.drop(f"{name}-{step}", f"{name}-{step + 1}-large")
        current, step, before = following, step + 1, state
        state = _state(current)
        if state == before:
            break
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
