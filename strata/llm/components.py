"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    """edges (u, v) with m, the least of u and its neighbours v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("m", "u"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    out = _least(down).select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
    return out.select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is its least node.

    Every step keeps the components and needs a logarithmic number of rounds;
    minima are aggregated before the shuffle, so a hot node costs one row per
    task and its join is an ordinary one that adaptive execution can split.
    Each round is written to the shared folder.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "edges")
    mark = None
    while True:
        edges = stored(_small_star(_large_star(edges).where("u <> v").distinct()).where("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.max(F.xxhash64("v", "u"))).first()
        if now == mark:
            break
        mark = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
