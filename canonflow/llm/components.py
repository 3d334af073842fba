"""Connected components by repeated joins: the smallest label spreads, and labels are followed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of `links` (a, b).

    Each round takes the smallest label among a node's neighbours, then the label of that label,
    so chains shorten by at least half. Rounds end in a written table; one number per round
    reaches the driver.
    """
    both = links.select(F.col("a").alias("x"), F.col("b").alias("y")).union(links.select(F.col("b").alias("x"), F.col("a").alias("y")))
    both = written(both.where("x != y").distinct(), "links")
    labels = written(both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label")).withColumnRenamed("x", "node"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("y"), F.col("label").alias("near")), "y").groupBy("x").agg(F.min("near").alias("near"))
        lower = labels.join(near.withColumnRenamed("x", "node"), "node").select("node", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        ahead = labels.select(F.col("node").alias("to"), F.col("label").alias("ahead"))
        moved = lower.join(ahead, "to").select("node", F.least("to", "ahead").alias("label"), "was")
        moved = written(moved, "labels")
        changed = moved.where("label != was").limit(1).count()
        labels = moved.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
