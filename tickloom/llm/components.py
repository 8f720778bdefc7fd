"""Connected components of links by contraction; each round is written in the shared folder, none is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, jumps: int = 2) -> DataFrame:
    """node, root for the nodes of links (a, b); root is the least node of the component. No links give no rows.

    Each node points to the least of its neighbours and itself, pointers are followed some steps, and links are drawn
    between what their ends point to; links within one node fall away. Rounds end when no link is left."""
    edges = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = stored(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")), "labels")
    for i in range(10_000):
        if edges.isEmpty():
            return labels
        least = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
        least = stored(least, f"up{i}")
        for j in range(jumps):
            far = least.select(F.col("node").alias("up"), F.col("up").alias("far"))
            least = stored(least.join(far, "up", "left").select("node", F.coalesce("far", "up").alias("up")), f"up{i}_{j}")
        moved = labels.join(least.select(F.col("node").alias("root"), "up"), "root", "left")
        labels = stored(moved.select("node", F.coalesce("up", "root").alias("root")), f"labels{i}")
        for end in ("a", "b"):
            edges = edges.join(least.select(F.col("node").alias(end), "up"), end, "left").withColumn(end, F.coalesce("up", end)).drop("up")
        edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges = stored(edges, f"edges{i}")
    raise RuntimeError("components did not converge")
