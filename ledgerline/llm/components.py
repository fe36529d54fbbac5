"""Connected components of a link table by rounds of joins: labels fall to the smallest node within reach, and each round
also jumps to the label's own label, so the number of rounds grows with the logarithm of the longest chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def components(links: DataFrame) -> DataFrame:
    """node, label (smallest node of its component) of every node of links(a long, b long)."""
    both = links.select(F.col("a").alias("x"), F.col("b").alias("y"))
    edges = written(both.unionAll(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).where("x <> y").distinct(), "edges")
    labels = written(edges.groupBy(F.col("x").alias("node")).agg(F.least(F.col("node"), F.min("y")).alias("label")), "labels")
    while True:
        # the smallest label among the neighbours, then the label of the label
        near = edges.join(labels.select(F.col("node").alias("y"), "label"), "y").groupBy(F.col("x").alias("node")).agg(F.min("label").alias("near"))
        low = labels.join(near, "node", "left").select("node", F.least("label", F.coalesce("near", "label")).alias("low"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("next"))
        new = written(low.join(jump, "low", "left").select("node", F.least("low", F.coalesce("next", "low")).alias("label"), (F.least("low", F.coalesce("next", "low")) != F.col("was")).alias("moved")), "labels")
        labels = new.select("node", "label")
        if not new.where("moved").limit(1).count():
            return labels
