"""Connected components of an edge table, by alternating large and small stars.

Each round is two aggregations and two joins on the edges; the number of rounds grows with the
logarithm of the longest path. A hub has one row per neighbour on the side of a join that
adaptive execution splits, and its minimum is aggregated partially before it moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.sources.scratch import discard, written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    all_ = _both(edges)
    return all_.join(_least(all_), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())


def roots(edges: DataFrame) -> DataFrame:
    """For every node u of the edges (u, v) that is not the least of its component: u and that least node, root."""
    edges = written(edges.where("u <> v").distinct())
    mark = _mark(edges)
    while True:
        before, edges = edges, written(_small_star(_large_star(edges)))
        discard(before)
        if (now := _mark(edges)) == mark:
            return edges.select("u", F.col("v").alias("root"))
        mark = now
