"""Fail-closed gates: a source that does not look like itself is refused, with the reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import is_long_fill


class SourceRejected(ValueError):
    pass


@dataclass(frozen=True)
class Gate:
    """Rows that fail `shape` are dropped and counted; too few or too many good rows, or a failed canary, refuse the source."""

    name: str
    shape: Column
    least: int = 1
    most: int | None = None
    canary: Column | None = None  # an aggregate that must be true

    def report(self, df: DataFrame) -> DataFrame:
        good = F.coalesce(self.shape, F.lit(False))
        return df.agg(F.count("*").alias("total"), F.count(F.when(~good, 1)).alias("dropped"), *([self.canary.alias("canary")] if self.canary is not None else [])).withColumn("gate", F.lit(self.name))

    def clean(self, df: DataFrame) -> DataFrame:
        seen = self.report(df).first()
        n = seen["total"] - seen["dropped"]
        if n < self.least or (self.most is not None and n > self.most):
            raise SourceRejected(f"{self.name}: {n} good rows of {seen['total']}")
        if self.canary is not None and not seen["canary"]:
            raise SourceRejected(f"{self.name}: canary failed")
        return df.where(F.coalesce(self.shape, F.lit(False)))


def realness(df: DataFrame, columns: list[str], high: float = 0.98, low: float = 0.02) -> DataFrame:
    """rows, bad, verdict: are the text columns' values fabricated filler?"""
    bad = F.lit(False)
    for c in columns:
        bad = bad | is_long_fill(F.col(c))
    share = F.col("bad") / F.nullif(F.col("rows"), F.lit(0))
    out = df.agg(F.count("*").alias("rows"), F.count(F.when(bad, 1)).alias("bad"))
    return out.withColumn("verdict", F.when(F.lit(not columns) | share.isNull(), "untestable").when(share >= high, "fabricated").when(share <= low, "clean").otherwise("mixed"))
