"""Connected components of an edge table, with joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge; component is the smallest node reachable.

    Large-star and small-star steps in turn: every node's larger neighbours, then the node and its smaller ones, are
    hung on its smallest neighbour. Rounds grow with the logarithm of the longest path. Nothing but a row count and a
    checksum comes to the driver; every round is checkpointed. Null ends and loops are left out.
    """
    now = cut(edges.where(F.col(a) != F.col(b))
              .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = _mark(now)
    while True:
        now = cut(_small(_large(now)))
        new = _mark(now)
        if new == mark:
            break
        mark = new
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).head())


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(least, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    hung = e.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
