"""Connected components of a table of links, by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import merged, saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round. Each node's least neighbour comes from a pre-aggregated group and meets the node's links by a join that splits hot nodes."""
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
    met = edges.join(merged(least), F.col("u") == F.col("x"))
    if large:
        out = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("x").alias("u"), F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root (the least node reachable) of every node in edges (u, v); nodes without links don't appear.

    Each round is written to the shared folder, so lineage stays short. The driver sees one checksum a round.
    """
    now = saved(edges.select("u", "v").filter("u <> v").distinct(), "links")
    mark = None
    for _ in range(rounds):
        now = saved(_star(_star(now, True), False), "links")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(seen)
    raise RuntimeError(f"links didn't settle in {rounds} rounds")
