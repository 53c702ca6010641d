"""Connected components of an undirected edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import stored


def _larger_to_least(edges: DataFrame) -> DataFrame:
    """Large star: every larger neighbour of a node is tied to the node's least neighbour (or itself)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _smaller_to_least(edges: DataFrame) -> DataFrame:
    """Small star: a node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = (edges.join(least, "u").where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return rest.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge; root is the least node it can reach.

    Each round is written to the shared folder, so lineage stays short.  Loops
    and repeated edges are ignored; an empty edge table gives an empty result.
    Rounds grow with the logarithm of the longest chain.
    """
    edges = stored(edges.where(F.col(a) != F.col(b))
                   .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = stored(_smaller_to_least(_larger_to_least(edges)), "edges")
        now = _state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
