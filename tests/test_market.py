"""Best matches by value, yields, lettings and canonical values on small tables."""

import random

from pyspark.sql import functions as F

from ledgerline.operators import market


def test_best_of(spark):
    rng = random.Random(1)
    left = [(i, rng.choice("abc") if i % 9 else None, rng.choice([None, 1.0, 2.0, 2.5, 7.0]), rng.choice([None, 0.0, 0.4, 0.9])) for i in range(80)]
    right = [(100 + i, rng.choice("abd") if i % 7 else None, rng.choice([None, 1.0, 3.0, 9.0]), rng.choice([None, 0.1, 0.5])) for i in range(40)]
    df = lambda rows, n: spark.createDataFrame(rows, f"{n} long, k string, price double, size double").repartition(3)
    got = {r["a"]: (r["b"], r["by"]) for r in market.best_of(df(left, "a"), df(right, "b"), "k", [("price", 1.0), ("size", 0.5)]).collect()}
    want = {}
    for a, k, p, s in left:
        found = [(i, abs(x[j] - v), x[0], n) for x in right if k is not None and x[1] == k for i, (n, v, j, most) in enumerate((("price", p, 2, 1.0), ("size", s, 3, 0.5))) if v is not None and x[j] is not None and abs(x[j] - v) <= most]
        want[a] = min(found)[2:] if found else (None, None)
    assert got == want and sum(b is not None for b, _ in got.values()) > 10
    hot = spark.range(40_000).select(F.col("id").alias("a"), F.lit("h").alias("k"), (F.col("id") * 1.0).alias("price"))
    assert market.nearest_value(hot, hot.withColumnRenamed("a", "b"), "k", "price", 0.0).where("a = b").count() == 40_000


def test_yields(spark):
    rents = [("north", 10.0)] * 30 + [("south", 10.0)] * 29 + [("west", 90.0)] * 40 + [(None, 1.0)]
    sales = [("Card", "north", 200.0)] * 40 + [("Card", "west", 200.0)] * 10 + [("north", None, 100.0)] * 5 + [("Other", "west", 200.0)] * 30 + [("None", None, None)]
    s = spark.createDataFrame(sales, "label string, area string, psf double")
    y = market.area_yields(spark.createDataFrame(rents, "area string, psf double"), s.select("area", "psf"))
    assert [tuple(r) for r in y.collect()] == [("north", 5.0, 30, 40)]  # south has too few, west lies outside the band
    alias = spark.createDataFrame([("Other", "north")], "label string, area string")
    charges = spark.createDataFrame([("Card", 4.0)], "label string, charge double")
    got = {r["label"]: tuple(r)[1:] for r in market.card_yields(s, y, alias, charges, 10.0).collect()}
    assert got == {"Card": ("north", "register", 5.0, 3.0, False), "north": ("north", "area name", 5.0, -5.0, True), "Other": ("north", "area alias", 5.0, 0.0, True), "None": (None, None, None, None, True)}


def test_lettings(spark):
    import datetime

    day = datetime.date(2024, 5, 10)
    desk = [(day, "A", "Desk House", "office", "New", 100 + i, 9_000.0) for i in range(20)]
    more = [(day, "A", "Real House", "office", "New", 300 + i, 90_000.0) for i in range(25)] + [(day, "B", "P", "flat", "New", 1, 5.0), (day, "B", "P", "flat", "New", 1, 7.0), (day, "C", None, "office", "Renewed", 2, None), (datetime.date(2020, 1, 1), "B", "P", "flat", "New", 9, 1.0)]
    lettings = spark.createDataFrame(desk + more, "day date, area string, project string, kind string, reg_type string, contract long, rent double")
    districts = spark.createDataFrame([("A", "east"), ("A", "west"), ("B", "west")], "area string, district string")
    full, once = market.letting_activity(lettings, districts, F.lit(day))
    rows = {(r["district"], r["project"]): (r["contracts"], r["median"], r["desk"]) for r in full.collect()}
    assert rows == {("east", "Desk House"): (20, 9000.0, True), ("west", "Desk House"): (20, 9000.0, True), ("east", "Real House"): (25, 90000.0, False), ("west", "Real House"): (25, 90000.0, False), ("west", "P"): (1, None, False), ("", None): (1, None, False)}
    assert {r["area"]: r["contracts"] for r in once.collect()} == {"A": 45, "B": 1, "C": 1}


def test_canonical(spark):
    rows = [(1, "name", "a", "map", "O"), (1, "name", "b", "reg", "S"), (2, "name", "x", "map", "O"), (2, "name", "y", "map", "O"), (2, "name", "y", "map", "O"), (3, "name", "s", "reg", "S"), (4, "name", None, "reg", "O"), (5, "floors", "9", "web", "O")]
    e = spark.createDataFrame(rows, "entity long, attribute string, value string, source string, role string")
    best, split = market.canonical_values(e, {"name": ["reg", "map"]}, {"S": "O"})
    assert {r["entity"]: (r["value"], r["source"]) for r in best.collect()} == {1: ("a", "map"), 2: ("y", "map"), 3: ("s", "reg")}
    assert {r["entity"]: (r["values"], r["sources"]) for r in split.collect()} == {1: (["a", "b"], ["map", "reg"]), 2: (["x", "y"], ["map"])}
