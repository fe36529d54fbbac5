"""Merges of extracts into stored versions, interval algebra, and what a lost writer leaves behind."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import spans, versions
from ledgerline.sources.lake import Held
from ledgerline.sources.register import Manifest, Register

DAY = datetime.date(2020, 1, 1)
day = lambda n: DAY + datetime.timedelta(days=n)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, d date")


def store(spark, path):
    return Register(spark, str(path), "k", ["v", "d"], "d")


def files(root):
    return {p.relative_to(root): p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def test_merges_equal_the_rebuild(spark, tmp_path):
    rng = random.Random(1)
    r, pulls = store(spark, tmp_path / "r"), []
    now = {k: ("a", day(k % 90)) for k in range(400)}
    for n in (1, 2, 3, 4):
        if n > 1:
            for k in rng.sample(sorted(now), 60):
                now[k] = (rng.choice("ab"), now[k][1])
            del now[rng.choice(sorted(now))]
            now[1000 + n] = ("new", day(n))
        pulls += [(k, v, d, n) for k, (v, d) in now.items()]
        r.merge(frame(spark, [(k, v, d) for k, (v, d) in now.items()]), f"e{n}", n, "export")
    whole = versions.versions(spark.createDataFrame(pulls, "k long, v string, d date, p int"), "k", ["v", "d"], "p")
    got = r.versions().select("k", "v", "d", "recorded_from", "recorded_to")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((*x[:3], *map(lambda y: None if y is None else int(y), x[3:]))) for x in whole.collect())
    assert r.merge(frame(spark, []), "e4", 9).source == "e4"  # loaded already
    assert {x["k"] for x in r.versions().where("vanished").collect()} == {k for k in range(400) if k not in now}


def test_untouched_months_keep_their_files(spark, tmp_path):
    root = tmp_path / "r"
    r = store(spark, root)
    rows = [(k, "a", day(k)) for k in range(120)] + [(500, "no day", None)]
    r.merge(frame(spark, rows), "w1", 1, "window")
    before, manifest = files(root), r.manifest()
    changed = [(k, "b" if k == 75 else "a", d) for k, _, d in rows if k in range(61, 91)]
    load = r.merge(frame(spark, changed + [(900, "c", day(70))]), "w2", 2, "export")
    assert load.new == 31  # another series knows none of them
    load = r.merge(frame(spark, [(k, "b" if k == 75 else v, d) for k, v, d in rows]), "w3", 3, "window")
    assert (load.status, load.new, load.closed, load.vanished) == ("loaded", 1, 1, 0)
    after, now = files(root), r.manifest()
    assert all(after[p] == t for p, t in before.items())
    same = {m for m in manifest.open if manifest.open[m] == now.open[m]}
    assert same == {m for m in manifest.open if not m.endswith("2020-03")} and "window/none" in same
    assert r.versions("window").where("recorded_to IS NOT NULL").select("k", "v").first() == (75, "a")
    # the first day of a window is cut through: what is missing from it is not judged; days outside are not looked at
    load = r.merge(frame(spark, [(k, "a", d) for k, _, d in rows if k in range(10, 115) and k not in (10, 20)]), "w4", 4, "window")
    assert load.vanished == 1 and load.closed == 2
    assert {x["k"] for x in r.versions("window").where("vanished").collect()} == {20}


def test_repeated_keys_and_spellings(spark, tmp_path):
    r = Register(spark, str(tmp_path / "r"), "k", ["v", "at"], "at")
    rows = [(1, "a", "2020-01-05T10:00"), (1, "b", "2020-01-05T10:00"), (1, "b", "2020-01-05T10:00"), (None, "n", None)]
    df = spark.createDataFrame(rows, "k long, v string, at string")
    assert r.series_of(df) == "export" and r.series_of(df.where("v = 'a'"), "at") == "window"
    r.merge(df, "x1", 1, dates=["at"])
    spaced = df.withColumn("at", F.replace("at", F.lit("T"), F.lit(" "))).withColumn("v", F.concat(F.lit(" "), "v"))
    assert r.series_of(spaced, "at") == "export"
    load = r.merge(spaced, "x2", 2, dates=["at"])
    assert (load.new, load.closed) == (0, 0)
    assert sorted(str(x[0]) for x in r.versions().select("txn_key").collect()) == ["", "1", "1#2", "1#3"]


def test_holds(spark, tmp_path):
    r = store(spark, tmp_path / "r")
    rows = [(k, "a", day(k % 50)) for k in range(1000)]
    r.merge(frame(spark, rows), "w1", 1, "window")
    assert r.merge(frame(spark, rows[:700]), "w2", 2, "window").note.startswith("shrank")
    assert r.merge(frame(spark, []), "w3", 3, "window").note == "no rows"
    lacks = [x for x in rows if x[0] % 10]
    held = r.merge(frame(spark, lacks), "w4", 4, "window")
    assert held.status == "held" and held.note.startswith("vanish: 80 of 960")
    assert r.merge(frame(spark, [x for x in rows if x[0] % 11]), "w5", 5, "window").note.endswith("of them from the extract before too")
    assert r.merge(frame(spark, [x for x in rows if x[0] % 11]), "w6", 6, "window").status == "loaded"
    assert r.loads().where("status = 'held'").count() == 4 and r.versions().where("vanished").count() == len([x for x in rows if x[0] % 11 == 0 and x[2] > DAY])


def test_a_writer_that_dies(spark, tmp_path):
    root = tmp_path / "r"
    r = store(spark, root)
    r.merge(frame(spark, [(1, "a", day(1))]), "e1", 1, "export")
    (root / "manifests" / "2").write_text('{"number": 2, "open": {"exp')  # cut off
    assert r.manifest().number == 1 and r.versions().count() == 1
    r.merge(frame(spark, [(1, "b", day(1))]), "e2", 2, "export")
    assert r.manifest().number == 3 and r.versions().count() == 2
    seen = r.manifest()
    r.merge(frame(spark, [(1, "c", day(1))]), "e3", 3, "export")
    with pytest.raises(Held):  # a writer that read before
        r._commit(seen, Manifest())
    assert r.current().select("v").first()[0] == "c"
    with pytest.raises(Held):
        store(spark, tmp_path / "none").versions()


def test_spans(spark):
    rng = random.Random(3)
    left = [(g, (a := rng.randint(0, 40)), a + rng.randint(-1, 9)) for g in range(12) for _ in range(rng.randint(0, 5))]
    right = [(g, (a := rng.randint(0, 40)), a + rng.randint(-1, 9)) for g in range(12) for _ in range(rng.randint(0, 5))]
    df = lambda rows: spark.createDataFrame([(g, day(a), day(b)) for g, a, b in rows], "g long, first date, last date").repartition(3)
    days = lambda rows: {(g, d) for g, a, b in rows for d in range(a, b + 1)}
    back = lambda out: [(r["g"], (r["first"] - DAY).days, (r["last"] - DAY).days) for r in out.collect()]
    for got, want in ((back(spans.union(df(left), ["g"])), days(left)), (back(spans.difference(df(left), df(right), ["g"])), days(left) - days(right))):
        assert days(got) == want
        assert sum(b - a + 1 for _, a, b in got) == len(want)  # disjoint
        assert not any(g == h and a == e + 1 for g, a, _ in got for h, _, e in got)  # no neighbours
    asked = spark.createDataFrame([(g, day(d), 7) for g in [*range(13), None] for d in range(60)] + [(1, None, 7)], "g long, d date, x int")
    got = {(r["g"], r["d"] and (r["d"] - DAY).days) for r in spans.covered(asked, df(left), ["g"], "d", "held").where("held").collect()}
    assert got == {x for x in days(left) if x[1] < 60}
    assert spans.covered(asked, df(left), ["g"], "d", "held").count() == asked.count()
    assert spans.union(df([]), ["g"]).count() == 0 and spans.difference(df(left), df([]), ["g"]).count() == spans.union(df(left), ["g"]).count()


def test_lake_claims_expiry_and_single_evaluation(spark, tmp_path):
    import os
    import time

    from ledgerline.sources import lake

    store = lake.Lake(spark, str(tmp_path / "lake"))
    noisy = spark.range(50).withColumn("x", F.rand())  # another table each time that it is evaluated
    assert store.publish({"t": noisy}) == 1
    from ledgerline.operators.stats import fingerprint

    wrote = fingerprint(store.table("t")).first()
    assert store._current()["t"][2] == f"{wrote['rows']}/{wrote['xor']}/{wrote['total']}"
    same = spark.range(45)
    store.publish({"t": same.withColumn("x", F.lit(0.5))})
    assert store.publish({"t": same.withColumn("x", F.lit(0.5))}) is None and len(list((tmp_path / "lake" / "t").iterdir())) == 2  # the copy is gone again
    claim = tmp_path / "lake" / "_claims" / "3"
    claim.touch()
    with pytest.raises(Held):  # someone is at it
        store.publish({"t": spark.range(46)})
    assert store.snapshots() == [1, 2] and len(list((tmp_path / "lake" / "t").iterdir())) == 2
    os.utime(claim, (time.time() - 2 * lake.STALE,) * 2)  # whoever it was is dead
    assert store.publish({"t": spark.range(46)}) == 3
    reading = store.table("t", version=3)
    (tmp_path / "lake" / "_log-1").mkdir()  # an expiry that died before its log was whole
    assert store.snapshots() == [1, 2, 3]
    (tmp_path / "lake" / "_log-1").rmdir()
    assert store.expire(keep=1) == 2 and store.snapshots() == [3] and reading.count() == 46
    assert store.publish({"t": spark.range(47)}) == 4 and store.table("t").count() == 47 and store.table("t", version=3).count() == 46
