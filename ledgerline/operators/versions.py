"""Registers over time: bitemporal versions, snapshots to intervals, flows between extracts, holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def row_hash(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumn("row_hash", F.md5(F.concat_ws("\x1f", *[F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) for c in columns])))


def versions(pulls: DataFrame, key: str, columns: list[str], pull: str) -> DataFrame:
    """key, columns, recorded_from, recorded_to of each version: runs of pulls in which a key had one content.

    pulls: one row for each key and pull number (whole extracts).  recorded_to is the pull in which the content had changed
    or vanished, null while it is current.  All pulls are versioned in one pass of windows, not by replaying merges."""
    w = Window.partitionBy(key).orderBy(pull)
    hashed = row_hash(pulls, columns)
    new = F.lag("row_hash").over(w).isNull() | (F.lag("row_hash").over(w) != F.col("row_hash")) | (F.lag(pull).over(w) != F.col(pull) - 1)
    runs = hashed.withColumn("run", F.sum(new.cast("int")).over(w))
    last = pulls.agg(F.max(pull).alias("last"))
    spans = runs.groupBy(key, "run").agg(*[F.first(c).alias(c) for c in columns], F.min(pull).alias("recorded_from"), F.max(pull).alias("seen"))
    return spans.crossJoin(F.broadcast(last)).select(key, *columns, "recorded_from", F.when(F.col("seen") < F.col("last"), F.col("seen") + 1).alias("recorded_to"))


def as_known_at(versions_: DataFrame, pull: int) -> DataFrame:
    return versions_.where((F.col("recorded_from") <= pull) & (F.col("recorded_to").isNull() | (F.col("recorded_to") > pull)))


def intervals(readings: DataFrame, group: str, unit: str, at: str, price: str) -> DataFrame:
    """Per unit: first and last reading, first and last price, price changes, readings, and after which reading it left."""
    w = Window.partitionBy(group, unit).orderBy(at)
    known = F.last(price, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    changed = (F.col(price).isNotNull() & known.isNotNull() & (F.col(price) != known)).cast("int")
    steps = readings.withColumn("changed", changed)
    priced = F.when(F.col(price).isNotNull(), F.struct(at, price))
    per = steps.groupBy(group, unit).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.min(priced).getField(price).alias("first_price"), F.max(priced).getField(price).alias("last_price"), F.sum("changed").alias("price_changes"), F.count("*").alias("readings"))
    times = readings.select(group, at).distinct()
    following = times.withColumn("left_after", F.lead(at).over(Window.partitionBy(group).orderBy(at))).withColumnRenamed(at, "last_seen")
    return per.join(following, [group, "last_seen"], "left")


def flows(before: DataFrame, now: DataFrame, keys: list[str], moved_in: str, cut_off) -> DataFrame:
    """arrivals, late_additions, departures between two extracts of counted keys; null keys are keys."""
    count = lambda df, n: df.groupBy(*keys, moved_in).agg(F.count("*").alias(n))
    b, n = count(before, "was").alias("b"), count(now, "is").alias("n")
    cond = F.lit(True)
    for k in (*keys, moved_in):
        cond = cond & F.col(f"b.{k}").eqNullSafe(F.col(f"n.{k}"))
    both = b.join(n, cond, "full").select(F.coalesce(f"n.{moved_in}", f"b.{moved_in}").alias("m"), F.coalesce("was", F.lit(0)).alias("was"), F.coalesce("is", F.lit(0)).alias("is"))
    fresh = F.coalesce(F.col("m") > F.lit(cut_off), F.lit(False))
    plus = lambda x: F.coalesce(F.sum(x), F.lit(0))
    return both.agg(plus(F.when(fresh, F.col("is"))).alias("arrivals"), plus(F.when(~fresh, F.greatest(F.col("is") - F.col("was"), F.lit(0)))).alias("late_additions"), plus(F.when(~fresh, F.greatest(F.col("was") - F.col("is"), F.lit(0)))).alias("departures"))


def shrink_holds(loads: DataFrame, order: str, rows: str, floor: float = 0.8) -> DataFrame:
    """loads with `accepted` (rows of the last accepted load before) and `held`: below floor times that.  A short list of
    loads per source; the state runs over it in order."""

    def judge(items):
        start = F.struct(F.lit(None).cast("bigint").alias("accepted"), F.array().cast("array<struct<at:string,rows:bigint,accepted:bigint,held:boolean>>").alias("out"))

        def step(acc, x):
            held = F.coalesce(x["rows"] < acc["accepted"] * floor, F.lit(False))
            row = F.struct(x["at"].alias("at"), x["rows"].alias("rows"), acc["accepted"].alias("accepted"), held.alias("held"))
            return F.struct(F.when(held, acc["accepted"]).otherwise(x["rows"]).alias("accepted"), F.concat(acc["out"], F.array(row)).alias("out"))

        return F.aggregate(items, start, step, lambda acc: acc["out"])

    by = [c for c in loads.columns if c not in (order, rows)]
    packed = loads.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(order).cast("string").alias("at"), F.col(rows).cast("bigint").alias("rows")))).alias("items"))
    return packed.select(*by, F.explode(judge(F.col("items"))).alias("x")).select(*by, F.col("x.at").alias(order), F.col("x.rows").alias(rows), "x.accepted", "x.held")
