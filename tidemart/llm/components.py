"""Connected components of a graph given as edges, by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Each round links every node's larger neighbours, then its smaller ones, to
    the smallest node around; the edges turn into stars in a number of rounds that grows with
    the logarithm of the graph. Minima are aggregated before they are joined
    back, so no node's neighbours are collected, and each round is written to
    the shared folder. Loops (a = b) keep a node without other links.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    stars = saved(_ordered(edges), "components")
    before = None
    while True:
        stars = saved(_small_star(_large_star(stars)), "components")
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    found = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node to the smaller."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return _ordered(both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(linked.union(least.select("a", F.col("m").alias("b"))))
