"""Sets of days as intervals: union, difference and membership of intervals by key, by sweeping over their ends.

An interval has a first and a last day, both inside; one whose last day is before its first holds nothing.  Every operation
is one pass of running sums over the ends of a key, never a join of intervals with intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ends(spans: DataFrame, by: list[str], first: str, last: str, name: str) -> DataFrame:
    """by, at, and +1 where an interval begins and -1 on the day after it ends."""
    whole = spans.where(F.col(first) <= F.col(last))
    begin = whole.select(*by, F.col(first).cast("date").alias("at"), F.lit(1).alias(name))
    return begin.unionAll(whole.select(*by, F.date_add(F.col(last), 1).alias("at"), F.lit(-1).alias(name)))


def _where(depths: DataFrame, by: list[str], inside: Column) -> DataFrame:
    """by, first, last of the longest runs of days on which `inside` holds; depths has a row for each day of change."""
    w = Window.partitionBy(*by).orderBy("at")
    marked = depths.withColumn("__in", inside).withColumn("__new", F.col("__in") & ~F.coalesce(F.lag("__in").over(w), F.lit(False)))
    marked = marked.withColumn("__next", F.lead("at").over(w)).withColumn("__run", F.sum(F.col("__new").cast("int")).over(w))
    return marked.where("__in").groupBy(*by, "__run").agg(F.min("at").alias("first"), F.date_sub(F.max("__next"), 1).alias("last")).drop("__run")


def union(spans: DataFrame, by: list[str], first: str = "first", last: str = "last") -> DataFrame:
    """by, first, last: the days that any interval of a key holds, as few disjoint intervals; neighbours are joined."""
    each = _ends(spans, by, first, last, "d").groupBy(*by, "at").agg(F.sum("d").alias("d"))
    deep = each.withColumn("depth", F.sum("d").over(Window.partitionBy(*by).orderBy("at")))
    return _where(deep, by, F.col("depth") > 0)


def difference(left: DataFrame, right: DataFrame, by: list[str], first: str = "first", last: str = "last") -> DataFrame:
    """by, first, last: the days of a key that intervals of left hold and none of right does."""
    l = _ends(left, by, first, last, "l").withColumn("r", F.lit(0))
    r = _ends(right, by, first, last, "r").select(*by, "at", F.lit(0).alias("l"), "r")
    each = l.unionAll(r).groupBy(*by, "at").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    w = Window.partitionBy(*by).orderBy("at")
    deep = each.select(*by, "at", F.sum("l").over(w).alias("l"), F.sum("r").over(w).alias("r"))
    return _where(deep, by, (F.col("l") > 0) & (F.col("r") == 0))


def covered(rows: DataFrame, spans: DataFrame, by: list[str], at: str, name: str, first: str = "first", last: str = "last") -> DataFrame:
    """rows with `name`: does an interval of its key hold its day?  Null days are held by none.

    Days are counted first, so a frequent day is one row of the sweep, whatever number of rows it has."""
    days = rows.select(*by, F.col(at).cast("date").alias("__at")).where("__at IS NOT NULL").distinct()
    ends = _ends(spans, by, first, last, "d").groupBy(*by, F.col("at").alias("__at")).agg(F.sum("d").alias("d"))
    swept = ends.withColumn("__day", F.lit(False)).unionByName(days.withColumn("d", F.lit(0).cast("bigint")).withColumn("__day", F.lit(True)))
    depth = F.sum("d").over(Window.partitionBy(*by).orderBy("__at", "__day").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    held = swept.withColumn("__depth", depth).where("__day AND __depth > 0").select(*[F.col(c).alias(f"__{c}") for c in by], "__at")
    same = F.col("__at") == F.col(at).cast("date")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return rows.join(held, same, "left").withColumn(name, F.col("__at").isNotNull()).drop("__at", *[f"__{c}" for c in by])
