"""Statistics that SQL lacks, as aggregate Columns or DataFrame operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exclusive_quantile(x: str, p: float) -> Column:
    """The p-quantile by the exclusive method (position (n + 1) p, clamped to the data); null below two values."""
    v = F.array_sort(F.collect_list(x))
    n = F.size(v)
    at = (n + 1) * F.lit(p)
    j = F.greatest(F.lit(1), F.least(F.floor(at).cast("int"), n - 1))
    d = at - j
    return F.when(n >= 2, F.element_at(v, j) * (1 - d) + F.element_at(v, j + 1) * d)


def index_percentile(x: str, p: float) -> Column:
    """The value at place floor(p n) of the sorted values."""
    v = F.array_sort(F.collect_list(x))
    return F.try_element_at(v, F.least(F.size(v), F.floor(F.size(v) * F.lit(p)).cast("int") + 1))


def values_at(df: DataFrame, by: str, x: str, places: dict[str, Column], buckets: int = 1000) -> DataFrame:
    """by, n and, for each name, the value at a place (from 1, a Column over n) of the sorted values of the group; null beyond.

    Equal values are counted first; of buckets of equal width only those that hold a wanted place are ranked, so no group
    goes through one task, but values that crowd into one bucket do."""
    counts = df.where(F.col(x).isNotNull()).groupBy(by, F.col(x).alias("__v")).agg(F.count("*").alias("__c"))
    ends = counts.groupBy(by).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.sum("__c").alias("n"))
    width = (F.col("__hi") - F.col("__lo")).cast("double") / buckets
    bucket = F.coalesce(F.floor((F.col("__v") - F.col("__lo")).cast("double") / F.nullif(width, F.lit(0.0))), F.lit(0).cast("bigint"))
    placed = counts.join(ends.select(F.col(by).alias("__by"), "__lo", "__hi"), F.col(by).eqNullSafe(F.col("__by"))).select(by, "__v", "__c", bucket.alias("__b"))
    sums = placed.groupBy(F.col(by).alias("__by"), F.col("__b").alias("__bb")).agg(F.sum("__c").alias("__c"))
    before = sums.withColumn("__to", F.sum("__c").over(Window.partitionBy("__by").orderBy("__bb"))).withColumn("__from", F.col("__to") - F.col("__c")).drop("__c")
    want = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), p.cast("bigint").alias("at")) for k, p in places.items()]))
    wanted = ends.select(F.col(by).alias("__g"), want.alias("__w")).select("__g", "__w.*")
    chosen = wanted.join(before, F.col("__g").eqNullSafe(F.col("__by")) & (F.col("at") > F.col("__from")) & (F.col("at") <= F.col("__to"))).select("__g", "__bb", "name", F.col("at") - F.col("__from"))
    chosen = chosen.toDF("__g", "__bb", "name", "at")
    rows = placed.join(chosen.select("__g", "__bb").distinct(), F.col(by).eqNullSafe(F.col("__g")) & (F.col("__b") == F.col("__bb")), "left_semi")
    ranked = rows.withColumn("__to", F.sum("__c").over(Window.partitionBy(by, "__b").orderBy("__v")))
    found = ranked.join(chosen, F.col(by).eqNullSafe(F.col("__g")) & (F.col("__b") == F.col("__bb")) & (F.col("at") <= F.col("__to")) & (F.col("at") > F.col("__to") - F.col("__c")))
    got = found.groupBy(F.col(by).alias("__g")).agg(*[F.max(F.when(F.col("name") == k, F.col("__v"))).alias(k) for k in places])
    return ends.select(by, "n").join(got, F.col(by).eqNullSafe(F.col("__g")), "left").drop("__g")


def index_percentiles(df: DataFrame, by: str, x: str, shares: dict[str, float]) -> DataFrame:
    """by and, for each name, the value at place floor(p n) of the sorted values, as index_percentile, for large groups."""
    n = F.col("n")
    return values_at(df, by, x, {k: F.least(n, F.floor(n * F.lit(p)) + 1) for k, p in shares.items()}).drop("n")


def exclusive_quantiles(df: DataFrame, by: str, x: str, shares: dict[str, float]) -> DataFrame:
    """by, n and, for each name, the quantile as exclusive_quantile, for large groups."""
    n, at, places = F.col("n"), {}, {}
    for k, p in shares.items():
        j = F.greatest(F.lit(1), F.least(F.floor((n + 1) * F.lit(p)), n - 1))
        at[k], places[f"{k}_0"], places[f"{k}_1"] = (n + 1) * F.lit(p) - j, j, j + 1
    v = values_at(df, by, x, places)
    return v.select(by, "n", *[F.when(n >= 2, F.col(f"{k}_0") * (1 - d) + F.col(f"{k}_1") * d).alias(k) for k, d in at.items()])


def interpolated_quantiles(df: DataFrame, by: str, x: str, shares: dict[str, float]) -> DataFrame:
    """by, n and, for each name, the interpolated quantile (place (n - 1) p from 0), for large groups."""
    n, at, places = F.col("n"), {}, {}
    for k, p in shares.items():
        place = (n - 1) * F.lit(p)
        at[k], places[f"{k}_0"], places[f"{k}_1"] = place - F.floor(place), F.floor(place) + 1, F.least(n, F.floor(place) + 2)
    v = values_at(df, by, x, places)
    return v.select(by, "n", *[(F.col(f"{k}_0") + (F.col(f"{k}_1") - F.col(f"{k}_0")) * d).alias(k) for k, d in at.items()])


def mode_of(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """by, value, n: the most frequent value of each key; ties go to the smaller value."""
    counts = df.groupBy(*by, value).agg(F.count("*").alias("n"))
    best = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("n").desc(), F.col(value).asc_nulls_last()))
    return counts.withColumn("__r", best).where("__r = 1").drop("__r")


def fingerprint(df: DataFrame) -> DataFrame:
    """rows, xor, total: equal for equal multisets of rows in any order and partitioning."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.agg(F.count("*").alias("rows"), F.bit_xor(h).alias("xor"), F.sum(h.cast("decimal(38,0)")).alias("total"))


def concentration(df: DataFrame, by: str, value: str, shares: tuple[float, ...] = (0.1, 0.01)) -> DataFrame:
    """For each share, the part of the total value that the top share of keys holds (keys without a value hold nothing and come
    last).  The least value that still belongs to the top is found by its place; what lies above it is summed, and of keys
    with just that value as many as are wanted."""
    sums = df.groupBy(by).agg(F.sum(value).alias("v"))
    total = sums.agg(F.sum("v").alias("total"), F.count("*").alias("keys"))
    name = lambda s: f"top_{round(s * 100)}_pct"
    keys = total.select(F.lit(True).alias("all"), "total", "keys")
    known = sums.where("v IS NOT NULL").select(F.lit(True).alias("all"), "v")
    counted = known.groupBy("all").agg(F.count("*").alias("m")).join(keys, "all").first()
    if counted is None:
        return total.select(*[F.lit(None).cast("double").alias(name(s)) for s in shares])
    top = {s: min(counted["m"], math.ceil(counted["keys"] * s)) for s in shares}
    edge = values_at(known, "all", "v", {name(s): F.lit(counted["m"] - top[s] + 1) for s in shares})
    over = known.crossJoin(F.broadcast(edge.drop("all", "n")))
    held = [F.coalesce(F.sum(F.when(F.col("v") > F.col(name(s)), F.col("v"))), F.lit(0.0)) + (top[s] - F.count(F.when(F.col("v") > F.col(name(s)), 1))) * F.first(name(s)) for s in shares]
    return over.agg(*[F.round(h / counted["total"], 6).alias(name(s)) for h, s in zip(held, shares)])


def best_cut(bins: DataFrame, bin_: str, low: str, high: str) -> DataFrame:
    """cut, errors: the smallest bin edge that misplaces fewest, with `low` counts to lie below and `high` counts above."""
    below = F.coalesce(F.sum(high).over(Window.orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    above = F.sum(low).over(Window.orderBy(bin_).rowsBetween(0, Window.unboundedFollowing))
    return bins.select(F.col(bin_).alias("cut"), (below + above).alias("errors")).orderBy("errors", "cut").limit(1)
