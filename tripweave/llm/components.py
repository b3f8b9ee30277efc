"""Connected components of a graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import stored


def connected_components(links: DataFrame, left: str = "src", right: str = "dst") -> DataFrame:
    """Columns ``node``, ``component``: every node of ``links`` with the smallest node reachable.

    Large-star and small-star steps alternate until the edges no longer change; then each
    node hangs from its component's smallest node. Steps aggregate minima before they
    shuffle, each round is written to the shared folder, and the driver sees two numbers a
    round. Null ends, loops and repeated links change nothing; no links give no rows.
    """
    u, v = F.col(left), F.col(right)
    edges = links.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    edges = stored(edges.distinct(), "links")
    before = _state(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "stars")
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return (
        edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(roots.withColumn("component", F.col("node")))
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    larger = both.where("v > u").join(lowest, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, "u").where("v <> m")
    return (
        moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(lowest.select("u", F.col("m").alias("v")))
        .distinct()
    )
