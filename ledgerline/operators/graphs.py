"""Connected components and lineage by rounds of joins, each round checkpointed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cut(df: DataFrame) -> DataFrame:
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        from ..sources.lake import shared_dir

        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def components(links: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) for links(a, b)."""
    edges = _cut(links.select(F.col("a").alias("x"), F.col("b").alias("y")).unionAll(links.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct())
    labels = _cut(edges.groupBy(F.col("x").alias("node")).agg(F.least(F.col("node"), F.min("y")).alias("label")))
    while True:
        near = edges.join(labels.select(F.col("node").alias("y"), "label"), "y").groupBy(F.col("x").alias("node")).agg(F.min("label").alias("near"))
        low = labels.join(near, "node").select("node", F.least("label", "near").alias("low"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("next"))
        new = _cut(low.join(jump, "low").select("node", F.least("low", "next").alias("label"), "was"))
        labels = new.select("node", "label")
        if not new.where("label <> was").limit(1).count():
            return labels


def lineage(parents: DataFrame, limit: int = 8) -> DataFrame:
    """node, root, generation, loop for parents(node, parent); a chain of `limit` steps or more counts as a loop."""
    state = parents.select("node", F.coalesce("parent", "node").alias("root"), F.when(F.col("parent").isNull(), 0).otherwise(1).alias("generation"))
    up = parents.where("parent is not null").select(F.col("node").alias("root"), F.col("parent").alias("above"))
    for _ in range(limit - 1):
        state = state.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"), (F.col("generation") + F.when(F.col("above").isNull(), 0).otherwise(1)).alias("generation"))
    loop = F.col("generation") >= limit
    return state.select("node", F.when(~loop, F.col("root")).alias("root"), F.when(~loop, F.col("generation")).alias("generation"), loop.alias("loop"))
