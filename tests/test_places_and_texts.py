"""Unions by authority, edge distances, name forms, slugs, JSON in text and sketches against plain Python."""

import json
import math
import random
import unicodedata

from pyspark.sql import functions as F

from ledgerline.functions import names
from ledgerline.operators import sketches, slugs, space
from ledgerline.sources import embedded

LON, LAT = 111_320.0, 110_574.0


def metres(a, b):
    return math.hypot((a[0] - b[0]) * LON * math.cos(math.radians(a[1])), (a[1] - b[1]) * LAT)


def test_authority(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([1, 2, 2, 3, 3, 3]), 55 + rng.randint(0, 40) * 0.0007, 25 + rng.randint(0, 40) * 0.0007) for i in range(400)]
    rows += [(1000 + i, 3, 55.01, 25.01) for i in range(300)] + [(2000 + i, 1, 55.01, 25.01) for i in range(300)] + [(5000, 2, None, 25.0), (5001, None, 55.0, 25.0)]
    kept = []
    for rank in (1, 2, 3):
        kept += [r for r in rows if r[1] == rank and (r[2] is None or not any(k[2] is not None and k[1] < rank and metres(r[2:], k[2:]) < 150 for k in kept))]
    df = spark.createDataFrame(rows, "p long, rank int, lon double, lat double").repartition(4)
    got = space.authority_kept(df, 150)
    assert {r["p"] for r in got.collect()} == {r[0] for r in kept} and got.columns == df.columns
    sites = [(55 + rng.randint(0, 40) * 0.0007, 25 + rng.randint(0, 40) * 0.0007, rng.choice([None, 1.0, 5.0, 9.0])) for _ in range(60)] + [(None, 1.0, 99.0)]
    out = space.largest_within(df, spark.createDataFrame(sites, "lon double, lat double, v double"), ["v"], 150)
    want = {r[0]: max((s[2] for s in sites if None not in (*s, *r[2:]) and metres(r[2:], s[:2]) < 150), default=None) for r in rows}
    assert {r["p"]: r["v"] for r in out.collect()} == want
    assert space.authority_kept(df.limit(0), 150).count() == 0


def test_edge_distance(spark):
    rings = {1: [(55.0, 25.0), (55.4, 25.001), (55.4, 25.003), (55.0, 25.002)], 2: [(55.1, 25.02), (55.11, 25.02), (55.105, 25.03)], 3: [(55.2, 60.0), (55.5, 60.0), (55.5, 60.01)], 4: [(55.0, 24.9), (55.0, 24.9), (55.0, 24.9)]}
    rng = random.Random(2)
    points = {i: (55 + rng.random() * 0.5, 24.99 + rng.random() * 0.05) for i in range(300)} | {1000 + i: (55.2 + rng.random() * 0.3, 59.99 + rng.random() * 0.03) for i in range(60)} | {2000: (55.001, 24.9)}
    v = spark.createDataFrame([(p, i, *xy) for p, ring in rings.items() for i, xy in enumerate(ring)], "poly int, v int, lon double, lat double")
    df = spark.createDataFrame([(p, *xy) for p, xy in points.items()] + [(9, None, 25.0)], "p int, lon double, lat double")

    def far(p, ring):
        k, best, inside = math.cos(math.radians(p[1])) * LON, math.inf, False
        for a, b in zip(ring, ring[1:] + ring[:1]):
            ax, ay, ux, uy = (a[0] - p[0]) * k, (a[1] - p[1]) * LAT, (b[0] - a[0]) * k, (b[1] - a[1]) * LAT
            t = max(0.0, min(1.0, -(ax * ux + ay * uy) / (ux * ux + uy * uy))) if ux or uy else 0.0
            best = min(best, math.hypot(ax + t * ux, ay + t * uy))
            inside ^= (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]
        return 0.0 if inside else best

    want = {(p, g): round(d, 3) for p, xy in points.items() for g, ring in rings.items() if (d := far(xy, ring)) <= 500}
    got = {(r["p"], r["poly"]): round(r["metres"], 3) for r in space.edge_distance(df, v, 500).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 0.01 for k in want) and len(want) > 60


def test_names(spark):
    said = ["Église Saint-Jean", "ﬁne Ĳssel ½", "ＷＩＤＥ １２", "Straße ŉ Ǆ", "مبنى Tower", "", None, "naïve ǅ … №5", "A of the Bay", "The Tower", "Tower by the Lake Residences"]
    df = spark.createDataFrame(list(enumerate(said)), "i int, x string")
    cols = {"folded": names.folded, "key": names.name_key, "under": names.underscored, "bare": names.without_filler, "stem": names.stem}
    got = {r["i"]: r for r in df.select("i", *[f(F.col("x")).alias(n) for n, f in cols.items()]).collect()}
    for i, x in enumerate(said):
        plain = unicodedata.normalize("NFKD", x or "").encode("ascii", "ignore").decode()
        assert (got[i]["folded"] or "") == plain and got[i]["key"] == "".join(c for c in plain.lower() if c.isalnum())
    assert got[8]["bare"] == "Bay" and got[9]["stem"] == "" and got[10]["stem"] == "lake" and got[0]["under"] == "eglise_saint_jean" and got[6]["folded"] is None and got[6]["key"] == ""


def test_slugs(spark):
    register = [("willowresidences", "brook"), ("willowresidencescopperhill", "copper"), ("lanternyard4", "four"), ("lanternyard4", "zz"), ("short", "short"), ("", "none"), (None, "none"), ("harbourgate", "gate"), ("harbourgatetwo", "gate")]
    asked = [(1, "Lantern Yard 4, The Arcade"), (2, "Willow Residences at Copper Hill"), (3, "Willow Residences North"), (4, "short street"), (5, None), (6, ""), (7, "Harbour Gate Nine"), (8, "LANTERN YARD 4"), (9, "Lantern Yard 40"), (10, "The Harbour of Gate, by x"), (11, "Unknown name of nothing")]
    got = {r["a"]: (r["slug"], r["stage"]) for r in slugs.resolved(spark.createDataFrame(asked, "a int, name string"), spark.createDataFrame(register, "key string, slug string")).collect()}
    assert got == {
        1: ("four", "before the comma"), 2: ("copper", "without joining words"), 3: (None, None), 4: (None, None), 5: (None, None), 6: (None, None), 7: ("gate", "beginning"), 8: ("four", "exact"), 9: ("four", "beginning"), 10: ("gate", "without joining words, before the comma"), 11: (None, None),
    }


def plain_objects(text):
    out, depth, start, quoted, i = [], 0, 0, False, 0
    while i < len(text):
        c = text[i]
        if quoted:
            if c == "\\":
                i += 1
            elif c == '"':
                quoted = False
        elif c == '"':
            quoted = '"' in text[i + 1 :] and closes(text, i)
        elif c == "{":
            start, depth = (i if not depth else start), depth + 1
        elif c == "}" and depth:
            depth -= 1
            if not depth:
                out.append(text[start : i + 1])
        i += 1
    return out


def closes(text, i):
    """Does the quote at i have an end?  One without is no quote."""
    i += 1
    while i < len(text):
        if text[i] == "\\":
            i += 1
        elif text[i] == '"':
            return True
        i += 1
    return False


def test_embedded(spark):
    rng = random.Random(5)
    texts = [None, "", "{", "}", "}{}", '{"a": "}"} x {b}', '{"a": {"b": [1, {"c": "\\"}"}]}} {', 'it"s {1}', '"{" {"{"}'] + ["".join(rng.choice('{}"\\ab ') for _ in range(rng.randint(1, 25))) for _ in range(400)] + ["{" * 3000 + "}" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = {r["i"]: r["o"] for r in df.select("i", embedded.objects(F.col("x")).alias("o")).collect()}
    assert got == {i: plain_objects(x or "") for i, x in enumerate(texts)}
    page = '<script type="application/ld+json">{"@graph": [{"@type": "A", "n": 1, "in": {"@type": ["B", "C"], "n": 2}}]}</script><script>{}</script><SCRIPT defer type="application/ld+json"> [1, {"@type": "C", "n": 3}] </SCRIPT><script type="application/ld+json">{"@type": "A"</script>'
    pages = spark.createDataFrame([(1, page), (2, None), (3, "<p>")], "id int, html string").select("id", F.explode(embedded.blocks(F.col("html"))).alias("t"))
    assert pages.count() == 3
    nodes = embedded.nodes(pages.select("id", F.try_parse_json("t").alias("v")))
    found = {k: sorted(json.loads(r[0])["n"] for r in embedded.typed(nodes, [k]).select(F.to_json("node")).collect()) for k in "ABC"}
    assert found == {"A": [1], "B": [2], "C": [2, 3]}


def test_sketches(spark):
    rows = spark.range(60_000).select((F.col("id") % 10).alias("day"), (F.col("id") % 7919).alias("u"), (F.col("id") * 7 % 60_000).cast("double").alias("v"))
    parts = sketches.sketched(rows, ["day"], "u", "v")
    r = sketches.merged(parts.withColumn("all", F.lit(1)), ["all"], [0.1, 0.5, 0.9]).first()
    assert r["n"] == 60_000 and abs(r["distinct"] / 7919 - 1) < 4 * 1.04 / 64
    assert all(abs(q / 60_000 - p) < 0.02 for q, p in zip(r["quantiles"], (0.1, 0.5, 0.9)))
    few = sketches.merged(parts.where("day < 3").withColumn("all", F.lit(1)), ["all"], [0.5]).first()
    assert few["n"] == 18_000


def test_edges_are_measured_once_a_place_and_shape(spark):
    """Sixty points at two places and thirty rings of two shapes: all pairs are told, the distances are measured before they are dealt."""
    corners = [(0, 55.0, 25.0), (1, 55.01, 25.0), (2, 55.01, 25.01), (3, 55.0, 25.01)]
    rings = spark.createDataFrame([(p, v, x + p % 2, y) for p in range(30) for v, x, y in corners], "poly int, v int, lon double, lat double")
    places = [(55.005, 25.005), (55.0, 25.011), (None, 25.0)]
    points = spark.createDataFrame([(i, *places[i % 3]) for i in range(90)], "p int, lon double, lat double")
    got = space.edge_distance(points, rings, 800)
    assert {(r["p"], r["poly"]): round(r["metres"], 1) for r in got.collect()} == {(i, p): [0.0, 110.6][i % 3] for i in range(90) if i % 3 < 2 for p in range(0, 30, 2)}
    assert got.count() == 900
    assert "SQRT" not in got._jdf.queryExecution().optimizedPlan().toString().upper()
