"""Connected components of an edge table by alternating large-star and small-star steps
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _mark(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``(u, v)`` edges of one orderable type -> ``(node, root)``, ``root`` the smallest node
    of the component. Nodes without an edge to another node don't appear; no edges, no rows.

    Every step is a partially aggregated minimum and a join by node, so that a node with very
    many neighbours is split like any skewed join key. Each round is checkpointed in the
    shared folder; the number of rounds grows with the logarithm of the longest path.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        before, mark = mark, _mark(e)
        if before == mark:
            break
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
