"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritable.sources.scratch import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node that it sees."""
    both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    seen = both.groupBy("hi").agg(F.min("lo").alias("m")).select(
        F.col("hi").alias("lo"), F.least("hi", "m").alias("m"))
    return edges.join(seen, "lo").select("hi", F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo <> m").select(
        F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.withColumnRenamed("m", "lo")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``a, b`` (long) → ``node, component``: the smallest node that each linked node reaches.

    The number of rounds grows with the logarithm of the nodes. Neighbours are never gathered:
    each step is a minimum per node and an equi-join, whose hot keys adaptive execution splits.
    Every round is written, so a lost executor costs one round's tasks at most. Loops, repeated
    edges and an empty input are fine; nodes without an edge are not returned.
    """
    edges = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        "edges")
    before, state = None, _state(edges)
    while state != before:
        edges = written(_small_star(_large_star(edges)), "edges")
        before, state = state, _state(edges)
    roots = edges.select("lo").distinct().select(F.col("lo").alias("node"), "lo")
    return edges.select(F.col("hi").alias("node"), "lo").unionByName(roots).select(
        "node", F.col("lo").alias("component"))
