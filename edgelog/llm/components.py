"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from edgelog.llm import shared


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of the node and its neighbours."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours all move to the smallest of them; edges point down."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that is not the smallest of its component.

    ``edges`` has comparable columns ``u`` and ``v``, in any direction; loops, repeated
    edges and nulls change nothing. Each round is written to the shared folder, so a
    lost executor costs a round at most. Only a count and a checksum reach the driver.
    """
    down = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    held = shared.stored(down, "edges")
    before = _mark(held)
    while before[0]:
        held = shared.stored(_small_star(_large_star(held).distinct()).distinct(), "edges")
        after = _mark(held)
        if after == before:
            break
        before = after
    return held.select(F.col("u").alias("node"), F.col("v").alias("root"))
