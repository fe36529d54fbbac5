"""Linkage weights are found again where they were planted; steps and ties of the cascade on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import fellegi


def comparisons(**kw):
    name = fellegi.name_level(F.col("name1"), F.col("name2"))
    return [fellegi.Comparison("name", name, kw.get("m", [0.8, 0.1, 0.05, 0.03, 0.02])), fellegi.Comparison("digits", fellegi.exact_level(F.col("digits1"), F.col("digits2")), [0.97, 0.03]), fellegi.Comparison("area", fellegi.exact_level(F.col("area1"), F.col("area2")), [0.6, 0.4])]


def test_planted_m(spark):
    rng = np.random.default_rng(3)
    m = [[0.7, 0.15, 0.08, 0.05, 0.02], [0.9, 0.1], [0.55, 0.45]]
    u = [[0.01, 0.03, 0.06, 0.2, 0.7], [0.1, 0.9], [0.25, 0.75]]
    counts = {}
    for matched, n, p in ((1, 20_000, m), (0, 180_000, u)):
        levels = np.stack([rng.choice(len(x), n, p=x) for x in p])
        levels = levels.astype(object)
        levels[1, rng.random(n) < 0.2] = None  # a fifth has no digits
        for v in zip(*levels.tolist()):
            counts[v] = counts.get(v, 0) + 1
    cs = comparisons()
    for c, x in zip(cs, u):
        c.u = x
    found, share = fellegi.estimate_m(list(counts.items()), cs)
    assert abs(share - 0.1) < 0.01
    assert max(abs(a - b) for x, y in zip(found, m) for a, b in zip(x, y)) < 0.02


def test_planted_u(spark):
    rng = random.Random(2)
    words = ["ALPHA", "BRAVO", "CHARLIE", "DELTA"]
    side = lambda k, n, s: spark.createDataFrame([(i, rng.choice(words), str(rng.randint(0, 9)), rng.choice("AB")) for i in range(n)], f"{k} long, name{s} string, digits{s} string, area{s} string")
    left, right = side("a", 700, 1), side("b", 900, 2)
    pairs = fellegi.random_pairs(left, right, "a", "b", 60_000)
    n = pairs.count()
    assert abs(n / 60_000 - 1) < 0.15 and pairs.select("a", "b").distinct().count() == n
    cs = comparisons()
    u = fellegi.estimate_u(fellegi.vectors(pairs, cs), cs)
    assert abs(u[0][0] - 0.25) < 0.02 and abs(u[1][0] - 0.1) < 0.02 and abs(u[2][0] - 0.5) < 0.02 and all(x > 0 for c in u for x in c)
    assert fellegi.random_pairs(left, right.limit(5), "a", "b", 60_000).count() == 3500  # few pairs: all of them
    assert fellegi.estimate_u([], cs)[1] == [0.5, 0.5]


def test_best_links(spark):
    right = spark.createDataFrame([(1, "HARBOUR POINT 1", "1", "X", "HARBOUR"), (2, "HARBOUR POINT 2", "2", "X", "HARBOUR"), (3, "HARBOUR POINT 1", "1", "X", "HARBOUR"), (4, None, None, None, None)], "b long, name2 string, digits2 string, area2 string, first string").withColumn("area", F.col("area2"))
    left = spark.createDataFrame([(10, "HARBOR POINT 1", "1", "X", "HARBOR"), (11, "HARBOR POINT 2", "2", None, "HARBOUR"), (12, "NOTHING", None, None, None), (13, "HARBOR POINT 1", "1", "X", "HARBOR")], "a long, name1 string, digits1 string, area1 string, first string").withColumn("area", F.col("area1"))
    cs = comparisons()
    for c, u in zip(cs, [[0.001, 0.004, 0.02, 0.1, 0.875], [0.05, 0.95], [0.2, 0.8]]):
        c.u = u
    got = {r["a"]: (r["b"], r["p"]) for r in fellegi.best_links(left, right, cs, ["name", "digits", "area"], ["first", "area"], 0.25).collect()}
    assert set(got) == {10, 11, 13} and got[10] == got[13] and got[10][0] == 1 and got[11][0] == 2
    odds = (0.1 / 0.004) * (0.97 / 0.05) * (0.6 / 0.2) * (0.25 / 0.75)
    assert got[10][1] == pytest.approx(odds / (1 + odds))


def test_cascade(spark):
    right = spark.createDataFrame([(1, "ONE", "A"), (2, "TWO", "A"), (3, "TWO", "B"), (4, "MANY", "A"), (5, "MANY", "A"), (6, None, "A")], "b long, name string, area string")
    left = spark.createDataFrame([(1, "ONE", "A"), (2, "ONE", None), (3, "TWO", "B"), (4, "TWO", None), (5, "MANY", "A"), (6, "LEFT", "A"), (7, None, "A"), (8, "ONE", "A"), (9, "ONE", "A")], "a long, name string, area string")
    decisions = spark.createDataFrame([(8, 5, "accept"), (9, 1, "reject")], "a long, b long, verdict string")
    links = lambda l, r: l.where("name = 'LEFT'").select("a", F.lit(2).cast("long").alias("b"), F.lit(0.7).alias("p"))
    got = {r["a"]: tuple(r)[1:] for r in fellegi.cascade(left, right, decisions, links).collect()}
    assert got == {
        1: (1, 1.0, "name", "accepted"), 2: (1, 0.97, "name, other area", "accepted"), 3: (3, 0.99, "name and area", "accepted"), 4: (2, 0.6, "name of several", "review"), 5: (4, 0.6, "name of several", "review"),
        6: (2, 0.7, "probable", "review"), 7: (None, 0.0, "no candidate", "unmatched"), 8: (5, 1.0, "by hand", "accepted"), 9: (None, 0.0, "by hand", "rejected"),
    }
