"""Choosing rows: first, only, top and ordinal rows of a key, fallback joins, multiset differences."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_N = "__n"


def first_rows(df: DataFrame, by: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key.  A row number under a filter lets Spark cut each key before the shuffle."""
    return df.withColumn(_N, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(_N) <= n).drop(_N)


def only_rows(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows whose key occurs once, by aggregate and join back, so that a very frequent key is never gathered."""
    once = df.groupBy(*by).agg(F.count("*").alias(_N)).where(F.col(_N) == 1).drop(_N)
    cond = [df[c].eqNullSafe(once[c]) for c in by]
    all_ = cond[0]
    for c in cond[1:]:
        all_ = all_ & c
    return df.join(once, all_, "left_semi")


def ordinal_key(df: DataFrame, key: str, order: list[Column], out: str) -> DataFrame:
    """key, key#2, key#3 ... for repeated keys."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    text = F.col(key).cast("string")
    return df.withColumn(out, F.when(n == 1, text).otherwise(F.concat(text, F.lit("#"), n.cast("string"))))


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (with multiplicity) of one side only, labelled `left` or `right`."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def fallback(df: DataFrame, key: str, sources: list[tuple[str, DataFrame]], value: str, out: str = "value", label: str = "source") -> DataFrame:
    """The value of the first source that has the key, and that source's name.  Each source has unique keys."""
    found, names = [], []
    for i, (name, source) in enumerate(sources):
        side = source.select(F.col(key).alias(f"__k{i}"), F.col(value).alias(f"__v{i}"))
        df = df.join(side, F.col(key) == F.col(f"__k{i}"), "left")
        found.append(F.col(f"__v{i}"))
        names.append(F.when(F.col(f"__v{i}").isNotNull(), name))
    df = df.withColumn(out, F.coalesce(*found)).withColumn(label, F.coalesce(*names))
    return df.drop(*[f"__{x}{i}" for x in "kv" for i in range(len(sources))])


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """left(key, at, ...) with the value of the latest row of right(key, at, value) of its key that is not later (ties: the
    greatest value); null if there is none.  Both sides go through one shuffle and a running last value, not through a join."""
    mine = [c for c in left.columns if c not in (key, at)]
    seen = right.groupBy(key, at).agg(F.max(value).alias(value)).select(key, at, F.lit(0).alias("__side"), F.struct(value).alias("__v"), *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in mine])
    asked = left.select(key, at, F.lit(1).alias("__side"), F.lit(None).cast(seen.schema["__v"].dataType).alias("__v"), *mine)
    w = Window.partitionBy(key).orderBy(at, "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = seen.unionByName(asked).withColumn("__last", F.last("__v", ignorenulls=True).over(w))
    return filled.where("__side = 1").select(key, at, *mine, F.col(f"__last.{value}").alias(value))


def numbered(df: DataFrame, order: list[Column], name: str, folder: str) -> DataFrame:
    """df with the place of each row (from 1) in a total order, without a window over all rows: rows are dealt by ranges of the
    order and stored, ranges are numbered in themselves, and the sizes of the ranges before are added."""
    path = f"{folder}/ranges-{uuid4().hex}"
    df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()).write.parquet(path)
    dealt = df.sparkSession.read.parquet(path)
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("__n"))  # one row a range
    before = sizes.withColumn("__before", F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).drop("__n")
    own = dealt.withColumn("__own", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    return own.join(F.broadcast(before), "__part").withColumn(name, F.col("__own") + F.col("__before")).drop("__part", "__own", "__before")
