"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.common import kept


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): the component is its least node.

    Every round moves the neighbours of a node to the least of them: the larger ones, then the
    smaller ones. Minima are combined before a shuffle, so a node with very many neighbours costs
    one row per task, and the number of edges never grows. Each round is stored, so that lost
    executors repeat one round at most.
    """
    edges = kept(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before, state = None, _state(edges)
    while state != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = kept(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(edges)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
