"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(u, v)``; root is the smallest node that can be reached.

    Each round shuffles the edges by node and keeps only stars; the number of rounds grows with the logarithm of
    the longest path. A hub's edges are one row each and are never gathered into one value, so a component that
    holds a third of all nodes is split like any skewed join. Self loops and repeated edges do no harm; an empty
    table has no nodes. Every round is written to the shared folder, and goes when the result is written.
    """
    with Scratch(edges.sparkSession) as scratch:
        return written(_stars(edges, scratch))


def _stars(edges: DataFrame, scratch: Scratch) -> DataFrame:
    edges = scratch.written(edges.select("u", "v").where("u <> v").distinct())
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(low, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
        )
        edges = scratch.written(small.distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
