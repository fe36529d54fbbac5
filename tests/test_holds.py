"""Collapsed counts: the running judge, the batch and the stream against the plain rule."""

import datetime
import random

from pyspark.sql import functions as F

from ledgerline.operators import contracts
from ledgerline.streaming import holds, windows


def plain(readings, released=()):
    accepted, out = None, []
    for i, (at, n) in enumerate(readings):
        held = accepted is not None and accepted >= 10 and n < 0.5 * accepted and not any(abs(m - n) <= 0.25 * max(n, 1) for _, m in readings[i + 1 :])
        out.append((at, n, accepted, held))
        accepted = accepted if held else n
    return out


def units(seed, n=60, most=12):
    rng = random.Random(seed)
    return {g: [(i, rng.choice([0, 3, 4, 9, 10, 20, 21, 40, 41, 100, 105])) for i in range(rng.randint(1, most))] for g in range(n)}


def test_judge():
    for g, readings in units(1, 1500, 14).items():
        judge, last = holds.Judge(), {}
        for k, (at, n) in enumerate(readings, 1):
            for r in judge.add(at, n):
                last[r[0]] = r[1:]
            assert [last[i] for i in range(k)] == plain(readings[:k])
            judge = holds.Judge().restore(judge.text())
    judge = holds.Judge()
    for i in range(50_000):
        judge.add(i, 100 - (i % 40))
    assert not judge.open  # nothing is kept of what cannot change


def test_batch(spark):
    data = units(2)
    rows = [(g, at, n) for g, items in data.items() for at, n in items]
    df = spark.createDataFrame(rows, "g int, at int, n long").repartition(5)
    got = {}
    for r in contracts.collapse_holds(df, "g", "at", "n").collect():
        got.setdefault(r["g"], []).append((r["at"], r["n"], r["accepted"], r["held"]))
    assert {g: sorted(v) for g, v in got.items()} == {g: plain(items) for g, items in data.items()}
    assert contracts.collapse_holds(df.limit(0), "g", "at", "n").count() == 0
    one = spark.range(0, 20_000).select(F.lit(None).cast("int").alias("g"), F.col("id").cast("int").alias("at"), (100 - F.col("id") % 7 * 12).alias("n"))
    assert contracts.collapse_holds(one, "g", "at", "n").count() == 20_000


def test_stream_out_of_order_and_restarted(spark, tmp_path):
    data, start = units(3, 25), datetime.datetime(2024, 1, 1)
    rows = [(f"u{g}", start + datetime.timedelta(days=at), n) for g, items in data.items() for at, n in items]
    rng = random.Random(4)
    spark.conf.set(*holds.STORE)
    source, folder = tmp_path / "in", str(tmp_path / "work")
    schema = "unit string, at timestamp, n long"
    source.mkdir()

    def run(part, name):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(source / name))
        df = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(source))
        return windows.drained(holds.stream(df), folder, "append")  # a new query each time, from the checkpoint

    # readings come in disorder within ten days, in three runs of the stream
    rows.sort(key=lambda r: (r[1] + datetime.timedelta(days=rng.uniform(0, 9)), r[0]))
    for k in range(3):
        run(rows[k * len(rows) // 3 : (k + 1) * len(rows) // 3], f"p{k}")
    told = run([("end", start + datetime.timedelta(days=400), 1)], "p3")
    got = {}
    for r in holds.latest(told).where("unit <> 'end'").collect():
        got.setdefault(r["unit"], []).append(((r["at"] - start).days, r["n"], r["accepted"], r["held"]))
    assert {g: sorted(v) for g, v in got.items()} == {f"u{g}": plain(items) for g, items in data.items()}
    assert told.count() > len(rows) - 1  # some were told again
