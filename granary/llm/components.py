"""Connected components of a graph of any size, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import discard, mark, stage


def _star(pairs: DataFrame, label: str) -> DataFrame:
    """Rows (u, v) with the least of u and its v's as m. The minima are written, so that a hot u's rows can be split in the join."""
    least = stage(pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), label)
    return pairs.join(least, "u")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its least node) for every node of an edge. Loops and repeated edges change nothing."""
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    since = mark()
    edges, before = stage(edges, "edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, "large").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u != v").distinct(), "edges")
        small = _star(large, "small")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = stage(small.where("u != v").distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))).first())
        discard(edges.sparkSession, since, edges)
        if now == before:
            break
        before = now
    # Settled: every node but a component's least has one edge, to that.
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
