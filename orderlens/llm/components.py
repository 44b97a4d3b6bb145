"""Connected components of an edge table, for graphs that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import kept_table


def _lowest(pairs: DataFrame) -> DataFrame:
    """node -> its smallest neighbour or itself; reduced on the map side, so hubs are harmless."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root is the component's smallest node.

    Large-star and small-star steps alternate until nothing changes. Each is a map-side reduced
    minimum and an equi-join, whose hot keys Spark splits; each round is written to the shared
    scratch folder. Loops, repeated edges and an empty table are allowed; nulls are not.
    """
    edges = kept_table(edges.where("a != b").distinct(), "edges")
    before = None
    while True:
        pairs = _both_ways(edges)
        # large-star: every larger neighbour moves to the node's smallest one
        large = (
            pairs.join(_lowest(pairs), "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        )
        # small-star: smaller neighbours and the node itself move to the smallest
        down = large.where("a != b").distinct().select(F.col("a").alias("u"), F.col("b").alias("v"))
        joined = down.join(_lowest(down), "u")
        small = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            joined.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
        edges = kept_table(small.where("a != b").distinct(), "edges")
        seen = edges.agg(
            F.count("*"), F.sum(F.col("a").cast("decimal(20,0)")), F.sum(F.col("b").cast("decimal(20,0)")),
            F.expr("bit_xor(xxhash64(a, b))"),
        ).first()
        if seen == before:
            break
        before = seen
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
