"""Connected components of a table of links, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is the smallest node.

    Alternating large-star and small-star: each round, every node hands its
    larger (smaller) neighbours to its smallest one. Rounds are written down;
    the number of links never grows, and grouping sums in the tasks first, so
    hubs are harmless. Ends when a round changes nothing.
    """
    edges = staged(links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _fingerprint(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        edges = staged(both.filter(F.col("b") > F.col("a")).join(lowest, F.col("a") == F.col("u")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        lowest = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        near = edges.join(lowest, F.col("a") == F.col("u"))
        edges = staged(near.select(F.col("b").alias("a"), F.col("m").alias("b")).filter(F.col("a") != F.col("b")).union(
            lowest.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "small")
        before, state = state, _fingerprint(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b"), F.col("b")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
