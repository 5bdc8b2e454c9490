"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.session import stage


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the smallest node each node can reach, for every node of ``edges``.

    Each round hangs neighbours on the smallest node they see; every table stays linear in the number of
    edges, and the stars are found by a pre-aggregated minimum, so a hub with many neighbours is one
    partial result per task. Rounds end when the edges no longer change; each is written out, so a lost
    executor costs one round. Self-loops and repeated edges are allowed; rows with a NULL end are ignored.
    """
    # Both ends keep a self-loop, so isolated nodes (only self-loops) stay.
    e = edges.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).where(F.col("a").isNotNull())
    e = e.where(F.col("b").isNotNull())
    nodes = stage(e.select("a").union(e.select("b")).distinct(), "nodes")
    e = stage(e.where("a <> b").distinct(), "edges")
    before = None
    while True:
        # Large star: neighbours larger than the node move to the node's minimum.
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        e = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: smaller neighbours and the node itself move to that minimum.
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        hung = e.join(low, "a")
        e = hung.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select("a", F.col("m").alias("b"))).distinct()
        e = stage(e, "edges")
        seen = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        now = (seen[0], seen[1])
        if now == before:
            break
        before = now
    return nodes.select(F.col("a").alias("node")).join(
        e.select(F.col("a").alias("node"), "b"), "node", "left").select(
        "node", F.coalesce("b", "node").alias("component"))
