"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.session import stage


def _lowest(pairs: DataFrame) -> DataFrame:
    """Per node the least of itself and its neighbours; combined on the map side.

    Written out: a join of two tables, and not of an aggregate, is one whose partitions
    Spark splits at run time where a node has very many edges, or that it broadcasts where
    the nodes are few.
    """
    return stage(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "lowest")


def _print(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("h")).first()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node reachable, for every node that has an edge.

    Large-star and small-star steps in turn: each node's larger neighbours, then its
    smaller ones, are linked to the least of them, until nothing changes and every tree is
    a star about its least node. Rounds grow with the logarithm of the longest path. Each
    round is written out, so a lost executor costs no more than that round.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    edges = stage(edges, "edges")
    before = _print(edges)
    while before["n"]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = _lowest(large)  # repeated edges do no harm until the round is written
        small = large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u > v").distinct(), "edges")
        after = _print(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
