"""Anchored clusters by rounds against the plain replay; groups by evidence, rule by rule."""

import random
import uuid

import numpy as np
from pyspark.sql import functions as F

from ledgerline.operators import anchors, groups
from ledgerline.plans import identities, more, registry  # noqa: F401

SCHEMA = "item long, bucket string, at long, size double, price double, furnished string, lat double, lon double"


def plain(rows, geo):
    out, found = {}, {}
    for item, bucket, at, size, price, furnished, lat, lon in sorted(rows, key=lambda r: (r[2], r[0])):
        if bucket is None or size is None or price is None or size < 0 or price < 0 or (geo and (lat is None or lon is None)):
            out[item] = item
            continue
        for a, s, p, f, y, x in found.setdefault(bucket, []):
            far = 0.0
            if geo:
                import math

                far = math.hypot((lon - x) * anchors.METRES_LON * math.cos(math.radians((lat + y) / 2)), (lat - y) * anchors.METRES_LAT)
            if abs(s - size) <= max(0.03 * max(s, size), 25) and abs(p - price) <= max(0.02 * max(p, price), 2000) and (not f or not furnished or f.lower() == furnished.lower()) and far <= 150:
                out[item] = a
                break
        else:
            found[bucket].append((item, size, price, furnished, lat, lon))
            out[item] = item
    return out


def made(seed, n, geo):
    rng = random.Random(seed)
    rows = [(i, "hot" if rng.random() < 0.5 else rng.choice("abc"), rng.randint(0, n // 3), rng.choice([400, 820, 2000]) + rng.randint(-60, 60), rng.choice([60_000, 900_000]) + rng.randint(-9000, 9000), rng.choice([None, "", "Yes", "yes", "no"]), 25 + rng.randint(0, 9) * 0.0006, 55 + rng.randint(0, 9) * 0.0006) for i in range(n)]
    rows = [tuple(float(x) if k in (3, 4) else x for k, x in enumerate(r)) for r in rows]
    return rows + [(n + 1, None, 1, 5.0, 5.0, None, 25.0, 55.0), (n + 2, "hot", 1, None, 5.0, None, 25.0, 55.0), (n + 3, "hot", 1, 5.0, -1.0, None, 25.0, 55.0), (n + 4, "hot", 0, 500.0, 60_000.0, "yes", None, 55.0)] + [(n + 10 + i, "hot", 7, 777.0, 77_777.0, "no", 25.0, 55.0) for i in range(50)]


def test_clusters(spark, tmp_path):
    def store(df):
        path = str(tmp_path / uuid.uuid4().hex)
        df.write.parquet(path)
        return spark.read.parquet(path)

    for geo, n in ((False, 300), (True, 160)):
        rows = made(5, n, geo)
        df = spark.createDataFrame(rows, SCHEMA).repartition(4)
        want = plain(rows, geo)
        for most in (20_000, 90):
            got = {r["item"]: r["anchor"] for r in anchors.clusters(df, store, geo, most).collect()}
            assert got == want, (geo, most)
    assert anchors.clusters(df.limit(0), store).count() == 0


def test_groups(spark):
    developers = [(1, "HERON Estates"), (2, "Heron Point LLC"), (3, "The Heron Fund"), (4, "The heron Trust"), (5, "Quiet One"), (6, "Quiet Two"), (7, "Quiet Three"), (8, "Heronry"), (9, "Heron and Egret"), (10, "Quiet Four"), (11, None), (12, "Quiet Five"), (13, "Quiet Six")]
    projects = [(100, "Bay One", 1), (101, "Bay Two", 4), (102, "Cliff A", 5), (103, "Cliff B", 5), (104, "Cliff C", 5), (105, "Heron Lake", 6), (106, "Dune A", 7), (107, "Dune B", 7), (108, "Dune C", 7), (109, "Twin", 10), (110, "Twin", 12), (111, "Marsh", 9), (112, None, 13)]
    seeds = [("h", "bay one"), ("h", "BAY-TWO"), ("h", "Cliff A"), ("h", "cliff b"), ("h", "Heron Lake"), ("h", "Dune A"), ("h", "Twin"), ("h", ""), ("e", "Marsh"), ("h", None)]
    aliases = [("h", "Heron"), ("e", "Egret"), ("e", "")]
    hand = [("h", 13, "accepted"), ("h", 2, "rejected")]
    got = groups.grouped(spark.createDataFrame(developers, "dev long, name string"), spark.createDataFrame(aliases, "grp string, alias string"), spark.createDataFrame(seeds, "grp string, name string"), spark.createDataFrame(projects, "cid long, name string, dev long"), spark.createDataFrame(hand, "grp string, dev long, verdict string"))
    assert {(r["grp"], r["dev"]): tuple(r)[2:] for r in got.collect()} == {
        ("h", 1): ("register name and portfolio", 1.0, "accepted", "rule"), ("h", 2): ("hand", 1.0, "rejected", "hand"), ("h", 3): ("brand inside another name", 0.5, "review", "rule"), ("h", 4): ("brand inside the name and portfolio", 0.9, "accepted", "rule"),
        ("h", 5): ("portfolio", 0.667, "accepted", "rule"), ("h", 6): ("portfolio project with the brand", 1.0, "accepted", "rule"), ("h", 7): ("portfolio, too few", 0.333, "review", "rule"), ("h", 13): ("hand", 1.0, "accepted", "hand"),
        ("h", 9): ("register name, claimed by 2 groups", 0.95, "review", "rule"), ("e", 9): ("brand inside the name and portfolio, claimed by 2 groups", 0.9, "review", "rule"),
    }
    sales = [(1, 100, None), (2, 106, "Cliff A"), (3, None, "CLIFF a"), (4, None, "Reef Gardens 3"), (5, None, "Reef Egret"), (6, None, "Twin"), (7, None, None), (8, None, "Other")]
    members = spark.createDataFrame([("h", 1), ("h", 5), ("h", 9), ("e", 9)], "grp string, dev long")
    more = spark.createDataFrame([*seeds, ("h", "Reef")], "grp string, name string")
    placed = groups.attributed(spark.createDataFrame(sales, "id long, cid long, name string"), members, spark.createDataFrame(projects, "cid long, name string, dev long"), more, spark.createDataFrame(aliases, "grp string, alias string"))
    assert {r["id"]: (r["grp"], r["route"]) for r in placed.collect()} == {1: ("h", "key"), 2: ("h", "name"), 3: ("h", "name"), 4: ("h", "portfolio"), 5: (None, None), 6: (None, None), 7: (None, None), 8: (None, None)}


def test_no_parts_are_paired_with_suppliers(spark, sf):
    plan = registry.QUERIES["developer_groups"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_sale_is_placed_by_its_key_and_name_alone(spark):
    """Two thousand sales of three names, a null key and name among them; answers equal one by one, plans ask each name once."""
    sales = [(i, *[(100, None), (None, "Reef Tower"), (None, None), (7, "Twin")][i % 4]) for i in range(2000)]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    projects = frame([(100, "Bay One", 1), (109, "Twin", 2), (110, "Twin", 1)], "cid long, name string, dev long")
    got = groups.attributed(frame(sales, "id long, cid long, name string"), frame([("h", 1)], "grp string, dev long"), projects, frame([("h", "Reef")], "grp string, name string"), frame([("h", "Heron")], "grp string, alias string"))
    assert {r["id"]: (r["grp"], r["route"]) for r in got.collect()} == {i: [("h", "key"), ("h", "portfolio"), (None, None), (None, None)][i % 4] for i in range(2000)}
    # sales are read for one join alone, the rest is done on their distinct keys and names
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD [id#") == 1


def test_islands_of_a_large_bucket_need_no_rounds(spark, tmp_path, monkeypatch):
    """Forty places far apart share a bucket that no task may hold; each of them is replayed by itself."""
    rng = random.Random(3)
    rows = [(i, "hot", rng.randint(0, 90), float(rng.randint(30, 1500)), float(rng.randint(900, 90_000)), rng.choice([None, "yes", "no"]), 25 + i % 40 * 0.004, 55 + i % 40 * 0.0002) for i in range(600)]

    def store(df):
        path = str(tmp_path / uuid.uuid4().hex)
        df.write.parquet(path)
        return spark.read.parquet(path)

    def rounds(*_):
        raise AssertionError("the bucket went by rounds")

    monkeypatch.setattr(anchors, "_rounds", rounds)
    got = {r["item"]: r["anchor"] for r in anchors.clusters(spark.createDataFrame(rows, SCHEMA).repartition(4), store, True, 90).collect()}
    assert got == plain(rows, True)


def test_small_buckets_share_a_pack(spark, sf):
    """Groups of Python are packs of rows, not one a bucket, and a pack's buckets are replayed side by side."""
    plan = registry.QUERIES["anchored_clusters"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInPandas [pack" in plan
    rng = random.Random(4)
    rows = sorted((rng.randint(0, 60), i, float(rng.randint(30, 1500)), float(rng.randint(900, 30_000))) for i in range(900))
    for larger in (True, False):
        unit, item, size, price = map(np.array, zip(*rows))
        none = np.full(900, -1)
        got, found, want = anchors.replay(unit, size, price, none, size, size, False, larger), {}, []
        for i, (u, _, s, p) in enumerate(rows):
            of = (lambda a, b: max(a, b)) if larger else (lambda a, b: a)
            a = next((a for a in found.get(u, []) if abs(size[a] - s) <= max(0.03 * of(size[a], s), 25) and abs(price[a] - p) <= max(0.02 * of(price[a], p), 2000)), i)
            if a == i:
                found.setdefault(u, []).append(i)
            want.append(a)
        assert got.tolist() == want
