"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from parcelog.storage import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from each node: ``node``, ``root`` (itself for the smallest).

    ``edges`` has comparable columns ``u`` and ``v``; null ends and loops don't count,
    repeated edges are one, no edges give no rows. Each round joins edges with their
    node's smallest neighbour, is written to the shared folder and halves the distances;
    no node's neighbours meet in one task other than through splittable joins.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
    edges = materialize(edges, "edges")
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u > v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").union(least.select("u", F.col("m").alias("v")))
        edges = materialize(small.distinct(), "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
