"""Disclosure control: small cells are folded, and no hidden cell can be worked out from a total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def fold_small(counts: DataFrame, group: list[str], item: str, n: str, floor: int = 20, other: str = "other") -> DataFrame:
    """Items below the floor become `other`; an `other` that is itself below the floor is left out."""
    folded = counts.withColumn(item, F.when(F.col(n) < floor, other).otherwise(F.col(item))).groupBy(*group, item).agg(F.sum(n).alias(n))
    return folded.where(F.col(n) >= floor)


def protect_residual(counts: DataFrame, group: str, item: str, n: str, floor: int = 20) -> DataFrame:
    """group, item, n: items below the floor are hidden in their group's remainder; where that remainder is above 0 but
    below the floor, the smallest shown item is hidden too, and so on until it is large enough or nothing is shown."""
    w = Window.partitionBy(group)
    hidden = F.sum(F.when(F.col(n) < floor, F.col(n)).otherwise(0)).over(w)
    order = Window.partitionBy(group).orderBy(F.col(n), item).rowsBetween(Window.unboundedPreceding, -1)
    smaller = F.coalesce(F.sum(n).over(order), F.lit(0))
    shown = counts.withColumn("hidden", hidden).withColumn("smaller", smaller)
    # an item is shown if it reaches the floor and what is hidden without it is nothing or enough
    return shown.where((F.col(n) >= floor) & ((F.col("hidden") == 0) | (F.col("smaller") >= floor))).select(group, item, n)
