"""Market rules: best matches by value, yields of the area where most sales are registered, lettings counted once, claims."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import first_rows
from .stats import interpolated_quantiles


def nearest_value(left: DataFrame, right: DataFrame, key: str, value: str, most: float) -> DataFrame:
    """a, b, apart: of each row of left(a, key, value) the row of right(b, key, value) of its key whose value is nearest and at
    most so far off (ties: the smaller b).

    Both sides are put in one order of values; the nearest right row is the last one before or the first one after.  So a
    frequent key is sorted, not paired off."""
    one = right.where(F.col(value).isNotNull() & F.col(key).isNotNull()).groupBy(key, value).agg(F.min("b").alias("b"))
    mine = left.where(F.col(value).isNotNull() & F.col(key).isNotNull()).select("a", key, value, F.lit(None).cast(dict(right.dtypes)["b"]).alias("b"), F.lit(1).alias("side"))
    there = one.select(F.lit(None).cast(dict(left.dtypes)["a"]).alias("a"), key, value, "b", F.lit(0).alias("side"))
    pair = F.when(F.col("side") == 0, F.struct(F.col(value).alias("v"), "b"))
    up = Window.partitionBy(key).orderBy(value, "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(key).orderBy(F.col(value).desc(), "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = there.unionByName(mine).withColumn("below", F.last(pair, ignorenulls=True).over(up)).withColumn("above", F.last(pair, ignorenulls=True).over(down)).where("side = 1")
    off = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(value) - F.col(f"{c}.v")).alias("apart"), F.col(f"{c}.b").alias("b")))
    best = F.least(off("below"), off("above"))
    return both.select("a", best.alias("x")).where(F.col("x.apart") <= most).select("a", "x.b", "x.apart")


def best_of(left: DataFrame, right: DataFrame, key: str, tests: list[tuple[str, float]]) -> DataFrame:
    """a, b, by: the best right row of each left row of its key by the first value that is near enough; null without one."""
    found, rest = None, left
    for value, most in tests:
        hit = nearest_value(rest, right, key, value, most).select("a", "b", F.lit(value).alias("by"))
        found = hit if found is None else found.unionByName(hit)
        rest = left.join(found.select("a"), "a", "left_anti")
    return left.select("a").join(found, "a", "left")


def area_yields(rents: DataFrame, sales: DataFrame, least: int = 30, low: float = 1.5, high: float = 12.0) -> DataFrame:
    """area, pct, rents, sales of rents(area, psf) and sales(area, psf): median rent over median sale in per cent, for areas with
    enough of both; what lies outside the band is left out."""
    r = interpolated_quantiles(rents.where("psf IS NOT NULL AND area IS NOT NULL"), "area", "psf", {"m": 0.5}).select("area", F.col("n").alias("rents"), F.col("m").alias("rent"))
    s = interpolated_quantiles(sales.where("psf IS NOT NULL AND area IS NOT NULL"), "area", "psf", {"m": 0.5}).select(F.col("area").alias("k"), F.col("n").alias("sales"), F.col("m").alias("sale"))
    both = r.join(s, F.col("area") == F.col("k")).where((F.col("rents") >= least) & (F.col("sales") >= least))
    return both.select("area", F.round(100 * F.col("rent") / F.col("sale"), 1).alias("pct"), "rents", "sales").where(F.col("pct").between(low, high))


def card_yields(sales: DataFrame, yields: DataFrame, alias: DataFrame, charges: DataFrame, default: float) -> DataFrame:
    """label, area, route, gross, net, estimated for the labels of sales(label, area, psf).

    A label takes the yield of the registered area of more than half of its registered sales, else of the area of its own
    name, else of alias(label, area).  Net is gross less the yearly service charge over the median sale price a square foot;
    where charges(label, charge) lacks the label the default is used and said to be."""
    n = sales.where("area IS NOT NULL").groupBy("label", "area").agg(F.count("*").alias("n"))
    top = first_rows(n, ["label"], [F.col("n").desc(), F.col("area")]).join(n.groupBy("label").agg(F.sum("n").alias("all")), "label").where("2 * n > all").select("label", F.col("area").alias("a1"))
    y = yields.select("area", "pct")
    pick = lambda c, i: y.select(F.col("area").alias(c), F.col("pct").alias(f"y{i}"))
    price = interpolated_quantiles(sales.where("psf IS NOT NULL"), "label", "psf", {"psf": 0.5}).select("label", F.round("psf", 0).alias("psf"))
    out = sales.select("label").distinct().join(top, "label", "left").join(alias.select("label", F.col("area").alias("a3")), "label", "left").join(pick("a1", 1), "a1", "left").withColumn("a2", F.col("label")).join(pick("a2", 2), "a2", "left").join(pick("a3", 3), "a3", "left")
    out = out.join(price, "label", "left").join(charges.select("label", "charge"), "label", "left")
    hit = lambda values: F.coalesce(*[F.when(F.col(f"y{i}").isNotNull(), v) for i, v in enumerate(values, 1)])
    gross = F.coalesce("y1", "y2", "y3")
    net = F.round(gross - 100 * F.coalesce("charge", F.lit(default)) / F.nullif(F.col("psf"), F.lit(0.0)), 1)
    return out.select("label", hit([F.col("a1"), F.col("a2"), F.col("a3")]).alias("area"), hit([F.lit("register"), F.lit("area name"), F.lit("area alias")]).alias("route"), gross.alias("gross"), net.alias("net"), F.col("charge").isNull().alias("estimated"))


def desks(lettings: DataFrame, as_of, days: int = 30, least: int = 20, below: float = 25_000.0) -> DataFrame:
    """project of lettings(day, project, kind, reg_type, contract, rent) whose new office contracts of the last days are so many
    and so cheap that they are licences of desks."""
    recent = lettings.where((F.col("kind") == "office") & (F.col("reg_type") == "New") & F.col("day").between(F.date_sub(as_of, days), as_of) & F.col("project").isNotNull())
    n = recent.groupBy("project").agg(F.countDistinct("contract").alias("n"))
    return interpolated_quantiles(recent, "project", "rent", {"m": 0.5}).drop("n").join(n, "project").where((F.col("n") >= least) & (F.col("m") < below)).select("project", F.lit("office").alias("kind"))


def letting_activity(lettings: DataFrame, districts: DataFrame, as_of, back: int = 400, ahead: int = 31, shown: int = 3) -> tuple[DataFrame, DataFrame]:
    """(by district: day, district, area, project, kind, reg_type, contracts, median, desk; once: day, area, contracts).

    An area of several districts(area, district) is told in each; in the second table it counts once, under its first
    district.  Medians of fewer than so many contracts are withheld."""
    window = lettings.where(F.col("day").between(F.date_sub(as_of, back), F.date_add(as_of, ahead)))
    told = window.join(districts, "area", "left").withColumn("district", F.coalesce("district", F.lit("")))
    by = ["day", "district", "area", "project", "kind", "reg_type"]
    group = F.struct(*by)
    n = told.groupBy(group.alias("g")).agg(F.countDistinct("contract").alias("contracts"))
    median = interpolated_quantiles(told.select(group.alias("g"), "rent").where("rent IS NOT NULL"), "g", "rent", {"m": 0.5}).select("g", "m")
    flag = desks(lettings, as_of).withColumn("desk", F.lit(True))
    full = n.join(median, "g", "left").select("g.*", "contracts", F.when(F.col("contracts") >= shown, F.round("m", 0)).alias("median"))
    full = full.join(flag, ["project", "kind"], "left").withColumn("desk", F.coalesce("desk", F.lit(False))).select(*by, "contracts", "median", "desk")
    first = districts.groupBy("area").agg(F.min("district").alias("district"))
    once = full.join(first.withColumnRenamed("district", "first"), "area", "left").where(F.col("district") == F.coalesce("first", F.lit(""))).groupBy("day", "area").agg(F.sum("contracts").alias("contracts"))
    return full, once


@dataclass(frozen=True)
class Metric:
    """A registered figure: what it is of a source's rows, the unit it is said in, and the column of its areas if it has them."""

    id: str
    source: str
    value: Column
    unit: str
    area: str | None = None
    least: int = 1


def claims(metrics: list[Metric], sources: dict[str, DataFrame], at: str, city: str, settles: int = 1) -> DataFrame:
    """metric, scope, value, unit, sample, window_from, window_to, provisional of every registered metric: for the whole of its
    source and, where it has areas, for each with a sufficient sample.  A claim is provisional while its window's end is
    less than `settles` days before the newest row of any source."""
    out, newest = None, None
    for s in sources.values():
        last = s.agg(F.max(F.to_date(at)).alias("newest"))
        newest = last if newest is None else newest.unionByName(last)
    newest = newest.agg(F.max("newest").alias("newest"))
    for m in metrics:
        s = sources[m.source]
        figures = [m.value.cast("double").alias("value"), F.count("*").alias("sample"), F.min(F.to_date(at)).alias("window_from"), F.max(F.to_date(at)).alias("window_to")]
        rows = s.groupBy(F.lit(city).alias("scope")).agg(*figures)
        if m.area:
            rows = rows.unionByName(s.where(F.col(m.area).isNotNull()).groupBy(F.col(m.area).cast("string").alias("scope")).agg(*figures))
        rows = rows.where(F.col("sample") >= m.least).select(F.lit(m.id).alias("metric"), "scope", "value", F.lit(m.unit).alias("unit"), "sample", "window_from", "window_to")
        out = rows if out is None else out.unionByName(rows)
    return out.crossJoin(F.broadcast(newest)).withColumn("provisional", F.col("window_to") > F.date_sub("newest", settles)).drop("newest")


def canonical_values(evidence: DataFrame, authority: dict[str, list[str]], demoted: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(entity, attribute, value, source, role; conflicts: entity, attribute, values, sources) of
    evidence(entity, attribute, value, source, role).

    authority ranks the sources of each attribute; the best source's value stands (ties: the most rows, then the smaller value).
    A role in `demoted` yields to the one it maps to: such a value stands only where none of that role does.  Conflicts are
    attributes for which sources give different values."""
    pairs = [(a, s, i) for a, sources in authority.items() for i, s in enumerate(sources)]
    table = evidence.sparkSession.createDataFrame(pairs, "attribute string, source string, place int")  # the matrix of authorities
    known = evidence.where("value IS NOT NULL").join(F.broadcast(table), ["attribute", "source"])
    low = F.lit(0)
    for role in demoted:
        low = F.when(F.col("role") == role, 1).otherwise(low)
    n = known.groupBy("entity", "attribute", "value", "source", "role", "place").agg(F.count("*").alias("n")).withColumn("low", low)
    best = first_rows(n, ["entity", "attribute"], [F.col("low"), F.col("place"), F.col("n").desc(), F.col("value"), F.col("role")])
    split = known.groupBy("entity", "attribute").agg(F.array_sort(F.collect_set("value")).alias("values"), F.array_sort(F.collect_set("source")).alias("sources")).where(F.size("values") > 1)
    return best.select("entity", "attribute", "value", "source", "role"), split
