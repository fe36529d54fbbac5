"""Record linkage whose weights are estimated from the data: u from random pairs, m by expectation-maximisation.

A pair of records is compared on several fields; each comparison has levels, 0 the best, null where it says nothing.  All
that estimation needs of the pairs is how often each vector of levels occurs, a table of a few dozen rows whatever the size
of the input; the pairs themselves are counted by Spark.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from .rows import first_rows


@dataclass
class Comparison:
    """A field's levels: `level` of a pair (columns of both sides), the number of levels, and m of each level."""

    name: str
    level: Column
    m: list[float]
    u: list[float] | None = None


def name_level(a: Column, b: Column, cuts: tuple[float, ...] = (0.95, 0.88, 0.80)) -> Column:
    """0 for equal names, 1, 2 ... for a Jaro-Winkler similarity of at least each cut, then what is below all."""
    score = keys.jaro_winkler(a, b)
    out = F.lit(len(cuts) + 1)
    for i, c in reversed(list(enumerate(cuts, 1))):
        out = F.when(score >= c, i).otherwise(out)
    return F.when(a.isNotNull() & b.isNotNull(), F.when(a == b, 0).otherwise(out))


def exact_level(a: Column, b: Column) -> Column:
    return F.when(a == b, 0).when(a.isNotNull() & b.isNotNull(), 1)


def random_pairs(left: DataFrame, right: DataFrame, a: str, b: str, wanted: int, seed: int = 1) -> DataFrame:
    """About `wanted` pairs of rows drawn at random from all: both sides are dealt by a hash of their ids into so many buckets
    that a bucket's pairs add up to that.  All pairs, if they are no more than that."""
    n = max(1, left.count() * right.count() // wanted)
    bucket = lambda k, side: F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}-{side}-"), F.col(k).cast("string"))), 1, 8), 16, 10).cast("long") % n
    return left.withColumn("__bucket", bucket(a, "l")).join(right.withColumn("__bucket", bucket(b, "r")), "__bucket").drop("__bucket")


def vectors(pairs: DataFrame, comparisons: list[Comparison]) -> list[tuple[tuple, int]]:
    """(levels, pairs) of each vector of levels that occurs."""
    named = pairs.select(*[c.level.alias(c.name) for c in comparisons])
    return [(tuple(r[c.name] for c in comparisons), r["n"]) for r in named.groupBy(*[c.name for c in comparisons]).agg(F.count("*").alias("n")).collect()]


def estimate_u(found: list[tuple[tuple, int]], comparisons: list[Comparison]) -> list[list[float]]:
    """The share of each level among random pairs that say something; a level that none has counts half a pair."""
    out = []
    for i, c in enumerate(comparisons):
        n = [sum(k for v, k in found if v[i] == level) for level in range(len(c.m))]
        out.append([(x or 0.5) / max(sum(n), 1) for x in n])
    return out


def estimate_m(found: list[tuple[tuple, int]], comparisons: list[Comparison], matched: float = 0.1, rounds: int = 500) -> tuple[list[list[float]], float]:
    """(m of each comparison, share of matches) of candidate pairs, by expectation-maximisation from the given m, u held."""
    m = [list(c.m) for c in comparisons]
    total = sum(n for _, n in found)
    for _ in range(rounds):
        sums, mass = [[1e-9] * len(x) for x in m], 0.0
        for v, n in found:
            yes, no = matched, 1 - matched
            for i, level in enumerate(v):
                if level is not None:
                    yes, no = yes * m[i][level], no * comparisons[i].u[level]
            p = n * yes / (yes + no) if yes + no else 0.0
            mass += p
            for i, level in enumerate(v):
                if level is not None:
                    sums[i][level] += p
        new = [[x / sum(s) for x in s] for s in sums]
        moved = max(abs(a - b) for x, y in zip(new, m) for a, b in zip(x, y))
        m, matched = new, mass / total if total else matched
        if moved < 1e-9:
            break
    return m, matched


def weight(comparisons: list[Comparison]) -> Column:
    """log2 of the Bayes factor of a pair."""
    total = F.lit(0.0)
    for c in comparisons:
        each = F.lit(0.0)
        for i, (m, u) in enumerate(zip(c.m, c.u)):
            each = F.when(c.level == i, math.log2(m / u)).otherwise(each)
        total = total + each
    return total


def best_links(left: DataFrame, right: DataFrame, comparisons: list[Comparison], fields: list[str], blocks: list[str], prior: float, least: float = 0.05) -> DataFrame:
    """a, b, p: the most probable right row of each left row (ties: the smaller b) among those that share a block.

    left has `a`, the fields with suffix 1 and the blocks, right has `b`, the fields with suffix 2 and the blocks.  Rows that
    agree in all fields and blocks are one, so a frequent name is compared once; a pair that shares several blocks is, too."""
    # equal rows are one: the left ones share their result, the smallest id speaks for the right ones
    l = left.groupBy(*[f"{f}1" for f in fields], *blocks).agg(F.min("a").alias("x"))
    r = right.groupBy(*[f"{f}2" for f in fields], *blocks).agg(F.min("b").alias("b"))
    pairs = None
    for i, k in enumerate(blocks):
        side = r.select("b", *[f"{f}2" for f in fields], *[F.col(c).alias(f"__{c}") for c in blocks])
        met = l.join(side, F.col(k) == F.col(f"__{k}"))
        for earlier in blocks[:i]:
            met = met.where(~F.coalesce(F.col(earlier) == F.col(f"__{earlier}"), F.lit(False)))
        pairs = met if pairs is None else pairs.unionByName(met)
    odds = F.pow(F.lit(2.0), weight(comparisons)) * prior / (1 - prior)
    scored = pairs.withColumn("p", odds / (1 + odds)).where(F.col("p") >= least)
    best = first_rows(scored, ["x"], [F.round("p", 9).desc(), F.col("b")]).select("x", "b", "p")
    same = F.lit(True)
    own = l.select("x", *[F.col(c).alias(f"__{c}") for c in (*[f"{f}1" for f in fields], *blocks)])
    for c in (*[f"{f}1" for f in fields], *blocks):
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return left.join(own, same).select("a", "x").join(best, "x").select("a", "b", "p")


def decided(p: Column, accept: float = 0.95, review: float = 0.50) -> Column:
    return F.when(p >= accept, "accepted").when(p >= review, "review").otherwise("unmatched")


def cascade(left: DataFrame, right: DataFrame, decisions: DataFrame, links) -> DataFrame:
    """a, b, score, method, status of every row of left(a, name, area), in five steps.

    A decision(a, b, verdict) made by hand wins.  Else a name that one row of right(b, name, area) has: 1.0, or 0.97 where its
    area differs; a name of several, of which one has the area: 0.99, else the smallest goes to review at 0.6.  What no name
    fits is left to links(left, right) -> a, b, p."""
    hand = decisions.select("a", F.when(F.col("verdict") == "accept", F.col("b")).alias("b"), F.when(F.col("verdict") == "accept", 1.0).otherwise(0.0).alias("score"), F.lit("by hand").alias("method"), F.when(F.col("verdict") == "accept", "accepted").otherwise("rejected").alias("status"))
    rest = left.join(decisions.select("a"), "a", "left_anti")
    named = right.where("name IS NOT NULL").groupBy("name").agg(F.count("*").alias("n"), F.min("b").alias("b1"), F.min("area").alias("area1"))
    there = right.groupBy("name", "area").agg(F.count("*").alias("k"), F.min("b").alias("b2"))
    # a null area is no area in common, so the second table is joined on equal ones
    found = rest.join(named, "name").join(there, ["name", "area"], "left")
    one, own = F.col("n") == 1, F.col("k") == 1
    same = one & F.coalesce(F.col("area") == F.col("area1"), F.lit(False))
    exact = found.select(
        "a", F.when(~one & own, F.col("b2")).otherwise(F.col("b1")).alias("b"),
        F.when(same, 1.0).when(one, 0.97).when(own, 0.99).otherwise(0.6).alias("score"),
        F.when(same, "name").when(one, "name, other area").when(own, "name and area").otherwise("name of several").alias("method"),
        F.when(one | F.coalesce(own, F.lit(False)), "accepted").otherwise("review").alias("status"),
    )
    residual = rest.join(exact.select("a"), "a", "left_anti")
    p = links(residual, right).withColumnRenamed("p", "score")
    linked = residual.select("a").join(p, "a", "left").select("a", "b", F.coalesce("score", F.lit(0.0)).alias("score"), F.when(F.col("b").isNull(), "no candidate").otherwise("probable").alias("method"), decided(F.coalesce("score", F.lit(0.0))).alias("status"))
    return hand.unionByName(exact).unionByName(linked)
