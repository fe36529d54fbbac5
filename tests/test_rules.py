"""Rules that SQL does not state, against plain Python; awkward rows; plans without a single task."""

import difflib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import geo, keys, roles
from ledgerline.operators import contracts, linkage, rows, space, stats
from ledgerline.plans import contracts as _contracts, feeds, identity, market, more, registers, registry, relational  # noqa: F401
from ledgerline.sources import lake, readers


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_parcel_spellings(spark):
    spelt = ["6830847", "6830847.00", "683-847", "683.847", "4238153.2", "0117.645", "0", "0.0", "0-38", "921-11059", " 6830847 ", "", None, "n/a", "12-34", "1234567-12", "683-", "1.", "921.11059"]
    want = [6830847, 6830847, 6830847, 6830847, None, 1170645, None, None, None, 92111059, 6830847, None, None, None, 120034, None, None, 1, 92111059]
    assert column(spark, spelt, keys.parcel_key) == want
    assert column(spark, ["4238153.2", "683-847", "0.0", None, "1234.5"], keys.parent_parcel_key) == [4238153, 6830847, None, None, 12340005]
    assert column(spark, [6816177, 92111059, None], keys.community_of, "long") == [681, 921, None]


def test_words_that_look_fabricated(spark):
    assert column(spark, ["MIGD", "JAN", "SEPT", "CLOSED", "XKCD", "QWRT", "TOWER", "xkcd", "", None], keys.is_word_fake) == [False, False, False, False, True, True, False, False, False, False]
    assert column(spark, ["123456789012", "BCDFGHJKLMNP1", "AEIOUAEIOUAEIO", None], keys.is_long_fill) == [False, True, False, False]


def test_jaro_winkler_against_duckdb(spark):
    rng = random.Random(4)
    pairs = [("".join(rng.choice("abcdeé ") for _ in range(rng.randint(0, 14))), "".join(rng.choice("abcdeé ") for _ in range(rng.randint(0, 14)))) for _ in range(800)] + [("", ""), ("martha", "marhta"), ("a", "a"), ("dixon", "dicksonx")]
    got = keys.jaro_winkler_scores([a for a, _ in pairs], [b for _, b in pairs])
    for (a, b), g in zip(pairs, got):
        if a.isascii() and b.isascii() and a and b:
            assert abs(duckdb.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0] - g) < 1e-9, (a, b)
    df = spark.createDataFrame([("ab", "ab"), (None, "a"), ("é", "é"), ("", "a")], "a string, b string")
    assert [r[0] for r in df.select(keys.jaro_winkler(F.col("a"), F.col("b"))).collect()] == [1.0, None, 1.0, 0.0]


def test_wording(spark, sf):
    got = {r["p_partkey"]: r["ratio"] for r in registry.QUERIES["wording_similarity"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/part.parquet").collect():
        assert got[r["p_partkey"]] == round(difflib.SequenceMatcher(None, r["p_name"].lower(), r["p_type"].lower()).ratio(), 6)


def test_edits_and_containment(spark):
    rng = random.Random(2)
    left = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 6)))) for i in range(40)]
    right = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 6)))) for i in range(40)]
    l, r = spark.createDataFrame(left, "a int, x string"), spark.createDataFrame(right, "b int, y string")
    for edits in (1, 2):
        want = {(x["a"], x["b"]) for x in l.crossJoin(r).where(F.levenshtein("x", "y") <= edits).collect()}
        assert {tuple(x) for x in linkage.within_edits(l, r, edits).collect()} == want
    assert {tuple(x) for x in linkage.contained(l, r).collect()} == {(i, j) for i, x in left for j, y in right if x and x in y}
    assert linkage.within_edits(l.limit(0), r).count() == 0


def collapse(readings):
    accepted, out = None, []
    for i, (at, n) in enumerate(readings):
        held = accepted is not None and accepted >= 10 and n < 0.5 * accepted and not any(abs(m - n) <= 0.25 * max(n, 1) for _, m in readings[i + 1 :])
        out.append((at, n, accepted, held))
        accepted = accepted if held else n
    return out


def test_collapse_holds(spark):
    rng = random.Random(1)
    data = {g: [(f"{i:02}", rng.choice([0, 3, 9, 10, 20, 40, 41, 100])) for i in range(rng.randint(1, 9))] for g in range(60)}
    df = spark.createDataFrame([(g, at, n) for g, items in data.items() for at, n in items], "g int, at string, n long").repartition(3)
    got = {}
    for r in contracts.collapse_holds(df, "g", "at", "n").collect():
        got.setdefault(r["g"], []).append((r["at"], r["n"], r["accepted"], r["held"]))
    assert {g: sorted(v) for g, v in got.items()} == {g: collapse(items) for g, items in data.items()}


def test_shrink_holds(spark, sf):
    loads = {}
    for r in spark.read.parquet(f"{sf}/events.parquet").groupBy("event_type", F.to_date("ts").cast("string").alias("day")).count().collect():
        loads.setdefault(r["event_type"], []).append((r["day"], r["count"]))
    want = []
    for kind, items in loads.items():
        accepted = None
        for day, n in sorted(items):
            held = accepted is not None and n < 0.8 * accepted
            want.append((kind, day, n, accepted, held))
            accepted = accepted if held else n
    got = registry.QUERIES["shrink_contract"](spark, sf).select("event_type", "day", "n", "accepted", "held").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_anchored_clusters(spark, sf):
    l = spark.read.parquet(f"{sf}/lineitem.parquet").collect()
    by = {}
    for r in l:
        by.setdefault(r["l_partkey"], []).append((r["l_orderkey"], r["l_orderkey"] * 10 + r["l_linenumber"], r["l_quantity"] * 30, r["l_extendedprice"]))
    want = []
    for items in by.values():
        anchors = []
        for _, item, s, p in sorted(items):
            found = next((a for a, x, y in anchors if abs(s - x) <= max(0.03 * x, 25) and abs(p - y) <= max(0.02 * y, 2000)), None)
            want.append((item, item if found is None else found))
            if found is None:
                anchors.append((item, s, p))
    assert sorted(map(tuple, registry.QUERIES["anchored_clusters"](spark, sf).collect())) == sorted(want)


def test_fingerprint_ignores_order(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet")
    one = stats.fingerprint(df).first()
    assert one == stats.fingerprint(df.repartition(7).orderBy(F.rand(3))).first() != stats.fingerprint(df.limit(20)).first()
    assert stats.fingerprint(df.unionAll(df)).first() != one


def test_probabilistic_links_accept_only_near_names(spark, sf):
    names = {r["p_partkey"]: r for r in spark.read.parquet(f"{sf}/part.parquet").collect()}
    found = registry.QUERIES["probabilistic_links"](spark, sf).collect()
    assert found and all(0.05 <= r["p"] <= 1 for r in found)
    for r in found:
        if r["status"] == "accepted":
            assert keys.jaro_winkler_scores([names[r["a"]]["p_name"] + "s"], [names[r["b"]]["p_name"]])[0] >= 0.8


def test_numbered_and_as_of(spark, tmp_path):
    df = spark.createDataFrame([(i * 7 % 50, i) for i in range(200)], "v int, i int").repartition(6)
    order = [F.col("v").desc(), F.col("i")]
    got = {r["i"]: r["place"] for r in rows.numbered(df, order, "place", str(tmp_path)).collect()}
    assert got == {i: k + 1 for k, (_, i) in enumerate(sorted((-(i * 7 % 50), i) for i in range(200)))}
    left = spark.createDataFrame([("a", 5, 1), ("a", 1, 2), ("b", 9, 3), (None, 9, 4)], "k string, at int, n int")
    right = spark.createDataFrame([("a", 2, 10), ("a", 5, 11), ("a", 5, 12), ("b", 10, 13), (None, 1, 14)], "k string, at int, v int")
    assert {r["n"]: r["v"] for r in rows.as_of(left, right, "k", "at", "v").collect()} == {1: 12, 2: None, 3: None, 4: 14}


def test_concentration_with_ties_and_nulls(spark):
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(100)] + [(200, None), (201, None)], "k int, v double")
    top = sorted((float(i % 5) for i in range(100)), reverse=True)
    r = stats.concentration(df, "k", "v").first()
    assert (r["top_10_pct"], r["top_1_pct"]) == (round(sum(top[:11]) / sum(top), 6), round(sum(top[:2]) / sum(top), 6))
    assert tuple(stats.concentration(df.limit(0), "k", "v").first()) == (None, None)


def test_no_single_task(spark, sf):
    for name in ("index_percentiles", "exclusive_quartiles", "interpolated_quantiles", "concentration", "best_name_match", "points_in_polygons", "near_names", "as_of_value"):
        plan = registry.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Cartesian|BroadcastNestedLoopJoin(?!.*isFinal)", plan) or name == "concentration", name
        assert not re.search(r"Window \[[^\]]*\], \[(?!\w)", plan), name


def test_places(spark):
    square = spark.createDataFrame([("s", i, x, y) for i, (x, y) in enumerate([(55.0, 25.0), (55.1, 25.0), (55.1, 25.1), (55.0, 25.1)])], "poly string, v int, lon double, lat double")
    points = spark.createDataFrame([(1, 55.05, 25.05), (2, 55.105, 25.05), (3, 56.0, 26.0), (4, None, 25.0)], "p int, lon double, lat double")
    centres = spark.createDataFrame([("c", 55.11, 25.05)], "b string, lon double, lat double")
    assert {tuple(r) for r in space.claimed(points, square, centres).collect()} == {(1, "s", "polygon"), (2, "c", "centre")}
    m = space.ring_measures(square).first()
    assert abs(m["square_metres"] / (11132.0 * 11057.4 * 0.9062) - 1) < 0.001 and (round(m["lon"], 6), round(m["lat"], 6)) == (55.05, 25.05)
    far = spark.createDataFrame([(1, 10.0, 69.0)], "a int, lon double, lat double")
    near = spark.createDataFrame([(1, 10.02, 69.0), (2, 10.03, 69.0)], "b int, lon double, lat double")
    assert [r["b"] for r in space.within(far, near, 1000).collect()] == [1]  # two hundredths of a degree are 798 m so far north
    assert column(spark, [0.0, 44.0, 46.0, 350.0, 180.0], geo.sector, "double") == ["N", "NE", "NE", "N", "S"]


def test_refusals(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).write.csv(f"{root}/e1/part-0", header=True)
    with pytest.raises(FileNotFoundError):
        readers.finished_parts(spark, root, [("e1", "ok", ["part-0", "part-1"])])
    with pytest.raises(FileNotFoundError):
        readers.newest_stamp(spark, root, "orders")
    with pytest.raises(FileNotFoundError):
        readers.fullest_daily(spark, root, "rents", 1)
    with pytest.raises(lake.Held):
        lake.views(spark, {"x_view": "SELECT * FROM not_there_at_all"})
    store = lake.Lake(spark, f"{root}/lake")
    store.publish({"t": spark.range(5)})
    store._fs().createNewFile(store._path("_claims/2"))
    with pytest.raises(lake.Held):  # another publisher took the number
        store.publish({"t": spark.range(6)})
    assert store.table("t").count() == 5 and store.snapshots() == [1]


def test_phrases(spark):
    bank = spark.createDataFrame([("a", "school fee", False), ("a", "school", True), ("b", "balcony", True), ("b", None, False)], "question string, phrase string, weak boolean")
    texts = spark.createDataFrame([(1, "The School fee?"), (2, "a balcony"), (3, None), (4, ""), (5, "preschool")], "id int, text string")
    got = {r["id"]: (r["question"], r["score"], r["hits"]) for r in linkage.phrase_scores(texts, bank, 0.55).collect()}
    assert got == {1: ("a", 0.88, 2), 2: ("b", 0.53, 1)}


def test_roles(spark):
    from ledgerline.functions import roles

    said = [
        (None, "osm", None, "UNKNOWN"), ("", "places", None, "UNKNOWN"), ("Tower 4", "osm", None, "STRUCTURAL_ID"), ("K7", "places", None, "STRUCTURAL_ID"), ("Heron Court", "places", None, "BUILDING_NAME"), ("Heron", "osm", None, "BUILDING_NAME"), ("Heron", "places", None, "FRAGMENT"),
        ("Heron", "places", "housing_complex", "BUILDING_NAME"), ("Heron East", "places", "metro_station", "INFRASTRUCTURE"), ("Heron East", "places", "parking_garage", "AMENITY"), ("Heron East", "places", None, "UNKNOWN"), ("Dr. A. Heron", "osm", None, "PERSON"), ("Ada Heron - life coach", "places", None, "PERSON"),
        ("Luxury 3BR, fully furnished", "osm", None, "ADVERTISEMENT"), ("The Group LLC", "osm", None, "FRAGMENT"), ("Unit 12, Heron", "places", None, "ADDRESS"), ("Land 88", "register", None, "PLOT_ID"), ("Heron Bakery", "places", None, "TENANT"), ("Grill at Heron Court", "places", None, "VENUE"), ("...", "osm", None, "BUILDING_NAME"),
    ]
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(said)], "i int, n string, s string, c string")
    got = {r["i"]: r["role"] for r in df.select("i", roles.role_of(F.col("n"), F.col("s"), F.col("c")).alias("role")).collect()}
    assert [got[i] for i in range(len(said))] == [r[3] for r in said]
    register = spark.createDataFrame([("Heron Court",), ("heron court",), ("Court",), ("A b c d e f g h i j",), (None,)], "name string")
    names = spark.createDataFrame([(1, "Bakery in HERON  court!"), (2, "Heron Court"), (3, None), (4, "The a B c d e f g h i j shop"), (5, "a b c d e f g h i"), (6, "Courtyard of nothing")], "a int, name string")
    assert {r["a"]: r["parent"] for r in roles.parents(names, register).collect()} == {1: "Heron Court", 2: "Court", 3: None, 4: "A b c d e f g h i j", 5: None, 6: None}


def test_probabilistic_links_compare_each_pair_of_names_once(spark, sf):
    parts = spark.read.parquet(f"{sf}/part.parquet").collect()
    bayes = lambda x, m, u: m[x] / u[x]
    want = {}
    for x in (r for r in parts if r["p_partkey"] % 20 == 0):
        found = []
        for y in (r for r in parts if r["p_name"].split(" ")[0] == x["p_name"].split(" ")[0]):
            j = keys.jaro_winkler_scores([x["p_name"] + "s"], [y["p_name"]])[0]
            odds = bayes(sum(j < c for c in (0.95, 0.88, 0.8)), [0.8, 0.12, 0.05, 0.03], [0.01, 0.02, 0.05, 0.92]) * bayes(int(x["p_size"] % 5 != y["p_size"] % 5), [0.6, 0.4], [0.2, 0.8]) / (len(parts) - 1)
            found += [(-round(odds / (1 + odds), 9), y["p_partkey"])] if odds / (1 + odds) >= 0.05 else []
        if found:
            want[x["p_partkey"]] = (min(found)[1], round(-min(found)[0], 6))
    got = registry.QUERIES["probabilistic_links"](spark, sf)
    assert {r["a"]: (r["b"], r["p"]) for r in got.collect()} == want
    below = got._jdf.queryExecution().optimizedPlan().toString().split("ArrowEvalPython")[1]
    assert below.count("Aggregate") >= 2, "names are compared row by row"


def test_one_edit_names_of_equal_names_and_late_keys(spark, tmp_path):
    """Equal names are no edit apart, a name of many customers is compared once, and the first key is below 100000, as in the SQL."""
    rows = [(1, "abc", 1), (2, "abc", 1), (3, "abd", 1), (4, "abd", 2), (200000, "abe", 1), (300000, "abf", 1), (99999, "bc", 1), (6, None, 1), (7, "abd", None)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    duckdb.sql(f"CREATE OR REPLACE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    want = duckdb.sql(registry.ORACLES["one_edit_names"]).fetchall()
    assert len(want) > 5
    assert sorted(map(tuple, registry.QUERIES["one_edit_names"](spark, str(tmp_path)).select("a", "b").collect())) == sorted(want)


def test_a_name_of_many_rows_has_its_parent_looked_up_once(spark):
    names = spark.createDataFrame([(i, ["Olive Diner at Red Ring", "Red Ring", None][i % 3]) for i in range(300)], "a int, name string")
    got = roles.parents(names, spark.createDataFrame([("red ring",), ("ring",), ("at",)], "name string"))
    assert sorted(map(tuple, got.collect())) == [(i, ["red ring", "ring", None][i % 3]) for i in range(300)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan.rpartition("Generate")[2].split("LogicalRDD")[0], "words are taken from every row"


def test_place_spine_pairs_nothing(spark, sf):
    plan = registry.QUERIES["place_spine"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    for count in plan.split("Aggregate"):
        assert not ("c_custkey" in count and "s_suppkey" in count), "customers are paired with suppliers"
