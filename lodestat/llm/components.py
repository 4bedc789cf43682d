"""Connected components of an edge table, by alternating star contraction.

Each round hangs every node below the smallest node that it or a neighbour knows, first
for larger neighbours and then for smaller ones, until the edges are stars.  The number
of rounds grows with the logarithm of the component size.  Edges stay in tables: a round
is two joins and two aggregations, written to the shared folder, and only the number of
edges and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("low"))
    moved = both.where("b > a").join(least, F.col("a") == F.col("node"))
    return moved.select(F.col("b").alias("a"), F.col("low").alias("b"))  # a > b from here on


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    moved = edges.join(least, F.col("a") == F.col("node")).where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return least.select(F.col("node").alias("a"), F.col("low").alias("b")).unionByName(moved).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node of the edges ``a``, ``b``.

    Nodes without an edge to another node are not in the result.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialize(edges.distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = materialize(_small_star(_large_star(edges).distinct()), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
