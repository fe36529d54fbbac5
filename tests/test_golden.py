"""Gates, field answers, content ids, evidence and churn on small tables."""

from pyspark.sql import functions as F

from ledgerline.operators import golden


def test_gate(spark):
    df = spark.range(3)
    got = {r["rule"]: (r["offenders"], r["verdict"]) for r in golden.gate({"a": df.where("id > 5"), "b": df, "c": df}, {"c"}).collect()}
    assert got == {"a": (0, "PASS"), "b": (3, "FAIL"), "c": (3, "known")}


def test_field_answers(spark):
    claims = [(1, 55.0, 25.0, "beach", "public", 1000.0), (2, 55.0, 25.0, "beach", "public", 100.0), (3, 55.0, 25.0, "beach", "members", 100.0), (4, 55.0, 25.0, "park", "public", None), (5, None, 25.0, "beach", "public", 10.0), (6, 55.0, 25.0, "pool", "public", 10.0), (7, 55.0, 25.0, None, None, 10.0), (8, 55.0, 25.0, "beach", None, 120.0)]
    places = [(1, 55.0, 25.001, "beach", "members"), (2, 55.0, 25.009, "beach", "public"), (3, 55.0, 25.002, "park", None)]
    got = {r["a"]: (None if r["metres"] is None else round(r["metres"]), r["holds"]) for r in golden.field_answers(spark.createDataFrame(claims, "a int, lon double, lat double, kind string, access string, claimed double"), spark.createDataFrame(places, "b int, lon double, lat double, kind string, access string")).collect()}
    assert got == {1: (995, True), 2: (995, False), 3: (111, True), 4: (None, False), 5: (None, False), 6: (None, False), 8: (111, False)}


def test_content_ids_last(spark):
    rows = [(1, "a", "x"), (2, "b", "y"), (3, "b", "z"), (4, "b", "z"), (5, None, "x")]
    make = lambda r: {x["k"]: x["id"] for x in golden.content_ids(spark.createDataFrame(r, "k int, c string, f string"), "k", [F.col("c")], [F.col("f")], "p-").collect()}
    one = make(rows)
    assert len(set(one.values())) == 5 and one[4] == f"{one[3]}-4"
    more = make([*rows, (6, "c", "q"), (7, "b", "z")])
    assert all(more[k] == one[k] for k in one) and len(set(more.values())) == 7


def test_evidence(spark):
    schema = "job string, entity int, value string, status string, since int, until int"
    e = spark.createDataFrame([("j", 1, "a", "asserted", 1, None), ("j", 2, None, "asserted", 1, None), ("k", 1, "a", "asserted", 1, None), ("j", 3, "old", "superseded", 0, 1)], schema)
    out = golden.asserted(e, spark.createDataFrame([(2, None), (2, None), (3, "old"), (None, "n")], "entity int, value string"), "j", 5)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([("j", 1, "a", "superseded", 1, 5), ("j", 2, None, "asserted", 1, None), ("k", 1, "a", "asserted", 1, None), ("j", 3, "old", "superseded", 0, 1), ("j", 3, "old", "asserted", 5, None)], key=str)


def test_churn(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id int")
    steps = spark.createDataFrame([(1, 2), (2, 3), (4, 5), (5, 4), (6, 7), (7, 8), (8, 7), (9, None)], "id int, by int")
    assert tuple(golden.churn(ids(*range(1, 11)), ids(3, 10), steps).first()) == (10, 8, 2, True)
    assert tuple(golden.churn(ids(1, 2, 3), ids(1, 2, 3), steps).first()) == (3, 0, 0, False)


def test_extracts(spark):
    df = lambda rows: spark.createDataFrame(rows, "k string, v int")
    was, now = df([("a", 1), ("a", 1), ("b", 1), ("c", 1), (None, 2), ("d", 1)]), df([("a", 1), ("a", 1), ("b", 2), ("c", 1), ("c", 1), (None, 2), ("e", 1)])
    assert {r["k"]: r["reason"] for r in golden.extracts_compared(was, now, "k").collect()} == {"a": "same", "b": "content", "c": "count", None: "same", "d": "count", "e": "count"}


def test_claims_of_a_place_are_looked_up_once(spark):
    """Two hundred claims at two places, amenities at one place: the first amenity stands for all of a place, claims are placed before they are paired."""
    claims = spark.createDataFrame([(i, [55.0, 55.01, None][i % 3], 25.0, "park", "members", 1000.0) for i in range(200)], "a int, lon double, lat double, kind string, access string, claimed double")
    amenities = spark.createDataFrame([(b, 55.005, 25.0, "park", "members" if b == 4 else "public") for b in range(4, 90)], "b int, lon double, lat double, kind string, access string")
    got = golden.field_answers(claims, amenities)
    assert {r["a"]: (r["metres"] and round(r["metres"]), r["holds"]) for r in got.collect()} == {i: [(504, False), (504, False), (None, False)][i % 3] for i in range(200)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan.rpartition("Generate")[2].split("LogicalRDD")[0], "every claim is paired"


def test_golden_gate_looks_up_places_not_claims(spark, sf):
    from ledgerline.plans import gatekeeping  # noqa: F401
    from ledgerline.plans.registry import QUERIES

    plan = QUERIES["golden_gate"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan.rpartition("Generate")[2].split("Relation")[0], "every claim is paired"
