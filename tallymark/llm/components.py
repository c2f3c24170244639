"""Connected components of an undirected graph, by alternating large-star and small-star steps.

Every step is an aggregation with map-side combine and an equi-join, in which the edges of a centre with over a thousandth of all
edges stay where they are (the few such centres are broadcast), so none is gathered in one task; nothing but two numbers for the test of convergence
goes to the driver. Each step is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tables as T


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r.n, r.x


def _large(edges: DataFrame, n: int) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    return T.join_counted(both.filter("v > u"), least, "u", 2 * n).select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = T.join_counted(down, least, "u", n).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v (longs) -> u, component (the smallest node of u's component), for all nodes but those smallest ones."""
    now = T.checkpoint(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before, mark = None, _mark(now)
    while mark != before and mark[0]:
        before, now = mark, T.checkpoint(_small(_large(now, mark[0]), mark[0]))
        mark = _mark(now)
    return now.select("u", F.col("v").alias("component"))


def labels(edges: DataFrame) -> DataFrame:
    """u, component for all nodes that have an edge."""
    found = components(edges)
    return found.union(found.select(F.col("component").alias("u"), "component").distinct())
