"""Connected components of links between numbered nodes, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paperloom.session import land


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node that an edge (a, b) names, the smallest left out.

    Large-star and small-star steps in turn: each joins a node's neighbours to the smallest of them, so after a
    few rounds every component is a star. Smallest neighbours come from a partial aggregation, and hot
    nodes join back by key, which the adaptive join splits. Each round is landed.
    """
    edges = land(edges.where("a <> b").distinct(), "links")
    before = _state(edges)
    while before[0]:
        around = _both_ways(edges)
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = land(small.where("a <> b").distinct(), "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
