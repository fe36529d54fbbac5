"""Centroids, toxic passages and conversation repair against plain Python, and on awkward rows."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import centroids, conversation_repair, queries, toxicity

# ---- centroids


def kmeans(rows, k=16, rounds=3, seed=1):
    rows = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    ranked = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest()))
    m = [v for _, v in ranked[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(m))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in rows]
        m = [[sum(r[1][i] for r, o in zip(rows, own) if o == j) // own.count(j) for i in range(64)] if j in own else m[j] for j in range(len(m))]
    found = [(i, *near(v)[::-1]) for i, v in rows]
    inertia = {j: sum(d for _, c, d in found if c == j) for j in range(len(m))}
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, m[c])).encode()).hexdigest()) for i, c, d in found), key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, cluster int, v string")


def test_centroids_awkward_rows(spark):
    rng = random.Random(3)
    as_float = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i, as_float(rng.gauss(i % 3, 0.4) for _ in range(64))) for i in range(60)]
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (70, None), (71, [1.0] * 63), (72, [None] + [1.0] * 63), (73, [math.nan] + [1.0] * 63), (74, [math.inf] + [0.0] * 63), (75, []), (76, [0.0] * 64), (77, [-0.0] * 64)]
    got = [tuple(r) for r in centroids.digests(vectors(spark, rows).repartition(5)).collect()]
    assert sorted(got, key=str) == kmeans(rows)
    few = rows[:3]
    assert sorted((tuple(r) for r in centroids.digests(vectors(spark, few)).collect()), key=str) == kmeans(few)
    assert centroids.digests(vectors(spark, [])).count() == 0
    assert centroids.digests(vectors(spark, rows[63:64])).count() == 0
    with pytest.raises(Exception, match="would not fit 64 bits"):
        centroids.digests(vectors(spark, [(1, [1e9] * 64)])).count()


def test_bounds_are_below_distances():
    rng = np.random.default_rng(1)
    for scale in (3, 1000, 1 << 26):
        x, m = rng.integers(-scale, scale, (300, 64)), rng.integers(-scale, scale, (16, 64))
        m[0] = x[0]
        x[1:200] = m[rng.integers(0, 16, 199)] + rng.integers(-scale // 3 - 1, scale // 3 + 1, (199, 64))
        true = ((x[:, None, :] - m[None]) ** 2).sum(axis=2)
        form = centroids.compressed(x, 8)
        assert (centroids.lower_bounds(*form, centroids.compressed(m, 8)) <= true).all()
        best, distance, computed = centroids.nearest(x, *form, m)
        assert (distance == true.min(axis=1)).all() and (best == true.argmin(axis=1)).all()
        assert computed < 0.8 * true.size  # the rest was screened


# ---- toxic passages


def maximal(scores):
    """By definition: the best segment (shortest, first), then the same left and right of it."""
    best = max(((sum(scores[a:b]), -(b - a), -a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    a, b = -best[2], -best[2] - best[1]
    return maximal(scores[:a]) + [(best[0], a, b)] + [(x, s + b, e + b) for x, s, e in maximal(scores[b:])]


def test_segments():
    rng = random.Random(2)
    for _ in range(400):
        scores = [rng.choice([-3, -2, -1, 1, 2, 5]) for _ in range(rng.randint(0, 14))]
        got = [(x, s, e) for x, s, e in toxicity.segments(np.array(scores, float))]
        assert sorted(x for x, _, _ in got) == sorted(x for x, _, _ in maximal(scores))
        assert all(abs(sum(scores[s:e]) - x) < 1e-9 for x, s, e in got) and all(a[2] <= b[1] for a, b in zip(got, got[1:]))
        # no proper prefix or suffix of a segment is worth nothing or less
        assert all(sum(scores[s:k]) > 0 and sum(scores[k:e]) > 0 for _, s, e in got for k in range(s + 1, e))
    assert len(toxicity.segments(np.tile([1.0, -2.0], 50_000))) == 50_000
    assert len(toxicity.segments(np.ones(100_000))) == 1


def test_toxicity_held_out(spark, sf):
    sf = sf.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = queries.op12_toxicity(spark, sf).join(labels, "doc_id", "left").toPandas()
    assert len(found) == docs.count()
    assert [bool(h) for h in found.held_out] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id]
    held = found[found.held_out & found.toxic.notna()]
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    # about a fifteenth of the toxic labels stand at texts without any toxic word
    assert (toxic.predicted == 1).mean() > 0.88 and (clean.predicted == 1).mean() < 0.005
    assert ((found.score >= 0.7) == (found.predicted == 1)).all() and found.score.between(0, 1).all()


def test_toxicity_awkward_rows(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["an", "re", "ti", "ou", "é"]) for _ in range(rng.randint(2, 5)))
    bad = lambda n: " ".join(rng.choice(["villain", "Rotter", word()]) for _ in range(n))
    rows = [(i, bad(40) if i % 3 == 0 else " ".join(word() for _ in range(40))) for i in range(300)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(300)] + [(5, 0, None), (None, 1, 1), (9999, 0, 1), (7, 0, 7)]
    long_ = " ".join(word() for _ in range(20_000))
    odd = [(1000, None), (1001, ""), (1002, "..."), (None, "villain villain"), (3, bad(40)), (3, bad(40)), (1003, long_), (1004, long_ + " rotter villain rotter villain " + long_), (1005, "villain " * 5000)]
    table = lambda r: spark.createDataFrame([(i, t, "en", 5, 1.0, 2) for i, t in r], "doc_id long, text string, lang string, toxic int, score double, tokens int").repartition(3)
    marks = lambda r: spark.createDataFrame(r, "doc_id long, quality int, toxic int")
    found = {}
    for r in toxicity.scored(table(rows + odd), marks(labels)).collect():
        found.setdefault(r["doc_id"], []).append(r)
    assert sum(map(len, found.values())) == len(rows) + len(odd) and len(found[3]) == 3
    assert all(r["predicted"] == (i % 3 == 0) for i in range(300) for r in found[i])
    assert [found[i][0]["predicted"] for i in (1000, 1001, 1002, 1003, 1004, 1005)] == [0, 0, 0, 0, 1, 1] and not found[None][0]["held_out"]
    assert found[1000][0]["score"] == found[1001][0]["score"] == found[1002][0]["score"]
    model = toxicity.fit(table(rows), marks(labels))
    spans = toxicity.passages(table(odd), model).where("doc_id = 1004").collect()
    text = odd[7][1]
    assert any("rotter villain rotter villain" in text[r["start"] : r["end"]] for r in spans) and sum(r["end"] - r["start"] for r in spans) < 200
    for none in ([], [(1, 0, 0), (2, 0, 0)], [(i, 0, 1) for i in range(9)]):
        got = {r["score"] for r in toxicity.scored(table(rows), marks(none)).collect()}
        assert len(got) == 1 and round(got.pop()) == (len(none) == 9)
    assert toxicity.scored(table([]), marks(labels)).count() == 0


def test_longer_features_keep_the_weight_of_their_beginning():
    # a word of six levels that only toxic texts hold, and a last level that other texts hold too
    rows = [(k, k - 1, k, 160, 0) for k in range(4, 10)] + [(10, 9, 10, 4, 0), (11, 9, 10, 60, 60)]
    found = toxicity.pd.DataFrame(rows, columns=["key", "parent", "level", "toxic", "other"])
    weight = toxicity._weights(found, 0.1, toxicity.PRIOR, toxicity.ERRORS)
    assert (np.diff(weight[:7]) >= 0).all() and weight[0] > 3.5 and weight[7] < weight[5] - 1


def test_toxicity_of_few_words_in_long_texts(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["an", "re", "ti", "ou", "st", "er", "ing", "ble", "nd", "ha"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(1500):
        text = [word() for _ in range(rng.randint(150, 500))]
        for _ in range(rng.randint(2, 3) if i % 10 == 0 else 0):
            text.insert(rng.randrange(len(text)), rng.choice(["scoundrelly", "worthlessly", "disgustedly", "stinkingest"]))
        rows.append((i, " ".join(text)))
    found = toxicity.scored(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(1500)], "doc_id long, quality int, toxic int")).where("held_out").collect()
    caught, wrong = ([r["predicted"] for r in found if (r["doc_id"] % 10 == 0) == y] for y in (True, False))
    assert len(caught) > 30 and np.mean(caught) > 0.9 and np.mean(wrong) < 0.02


# ---- conversation repair


def plain(rows):
    """Cheapest and ASCII-least audit over all edits, row by row, and the repaired turns."""
    best = {"": (0, "", ())}
    after = lambda end: {"": "su", "s": "u", "u": "a", "a": "u"}[end]

    def offer(table, end, value):
        if end not in table or value[:2] < table[end][:2]:
            table[end] = value

    def insert(table):
        for _ in range(2):
            for end, (c, e, t) in list(table.items()):
                for to in after(end).replace("s", ""):
                    offer(table, to, (c + 2, e + "I", t + (({"u": "user", "a": "assistant"}[to], ""),)))
        return table

    seen = set()
    for role, text in rows:
        ink = text.strip(" \t\n\v\f\r")
        fault = "b" if not ink else "d" if (role, text) in seen else "t" if ink[-1] not in ".!?" else " "
        seen.add((role, text))
        new = {}
        for end, (c, e, t) in insert(best).items():
            offer(new, end, (c + 3, e + "D", t))
            if fault in " t":
                for to in after(end):
                    if to == role[:1]:
                        offer(new, to, (c + (fault == "t"), e + "K", t + ((role, text),)))
                    elif to != "s":
                        offer(new, to, (c + 2 + (fault == "t"), e + "R", t + (({"u": "user", "a": "assistant"}[to], text),)))
        best = new
    return min(v for end, v in insert(best).items() if end in ("", "a"))


def test_search_against_all_edits():
    rng = random.Random(6)
    for n in itertools.chain(range(5), [6, 7, 8, 12, 30] * 60):
        rows = [(rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", "usher"]), rng.choice(["", " ", "a.", "b!", "c", "d?", f"{rng.random()}.", "e."])) for _ in range(n)]
        cost, audit, _ = plain(rows)
        for block in (1, 2, 5, 512):
            repair, seen = conversation_repair.Repair(block), set()
            for role, text in rows:
                ink = text.strip(" \t\n\v\f\r")
                repair.add(role[:1], "b" if not ink else "d" if (role, text) in seen else "t" if ink[-1] not in ".!?" else " ")
                seen.add((role, text))
            assert repair.result() == (cost, audit), (rows, block)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "f") for r in rows], "conv_id long, turn long, role string, text string, pos string, kind int, dealt int, fault string").repartition(3)


def broken(rows):
    """The damage, row by row; sorted as the operator orders rows."""
    out = []
    for conv, turn, role, text in rows:
        dealt = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if dealt == 1:
            text = ""
        if dealt == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        out += [(conv, turn, "user" if dealt == 4 else role, text)] * {0: 0, 3: 2}.get(dealt, 1)
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def expected(rows):
    out = {r[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in rows}
    for conv, group in itertools.groupby(broken(rows), key=lambda r: r[0]):
        group = list(group)
        turns, faults, seen = [r[1] for r in group if r[1] is not None], [], set()
        for _, _, role, text in group:
            ink = text.strip(" \t\n\v\f\r")
            faults.append("b" if not ink else "d" if (role, text) in seen else "t" if ink[-1] not in ".!?" else " ")
            seen.add((role, text))
        cost, audit, told = plain([r[2:] for r in group])
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(group, group[1:]))
        text = "\n".join(f"{r}:{t}" for r, t in told)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in "bdt"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def test_repair_awkward_rows(spark):
    rng = random.Random(7)
    rows = [(c, rng.choice([None, 0, 1, 2, 3, 4, 9, -2]), rng.choice([None, "user", "assistant", "system", "", "élan"]), rng.choice([None, "", " \t", "Yes.", "No", "Ça va ?", "x\n", "...", "é. \x1f"])) for c in [None, *range(80)] for _ in range(rng.randint(1, 9))]
    rows += [(500, t, ("user", "assistant")[t % 2], f"{t}." if t % 7 else f"{t}") for t in range(3000)] + [(501, 1, "user", "same.")] * 40 + [(502, None, "tool", "x." * 50_000)]
    want = expected(rows)
    source = conversations(spark, rows)
    hurt = conversation_repair.damaged(source)
    assert sorted(map(str, map(tuple, hurt.collect()))) == sorted(map(str, broken(rows)))
    got = {r[0]: tuple(r)[1:] for r in conversation_repair.repaired(hurt, source).collect()}
    assert got == want
    told = {}
    for r in conversation_repair.turns(hurt).collect():
        told.setdefault(r["conv_id"], []).append((r["place"], f"{r['role']}:{r['text']}"))
    for conv, row in want.items():
        assert hashlib.sha256("\n".join(t for _, t in sorted(told.get(conv, []))).encode()).hexdigest() == row[-1]
    parts = conversation_repair.edits(conversation_repair.judged(hurt), chunk=7).orderBy("conv_id", "pos").collect()
    joined = {}
    for r in parts:
        joined[r["conv_id"]] = joined.get(r["conv_id"], "") + r["audit"]
    assert joined == {c: w[6] for c, w in want.items() if c in joined} and sum(len(v) > 7 for v in joined.values()) > 1
    assert conversation_repair.repaired(conversation_repair.damaged(source.limit(0)), source.limit(0)).count() == 0


def test_long_conversation(spark):
    """Twenty thousand turns whose roles fit nowhere: both parities stay open from the first row to the last."""
    rows = [(1, t, "tool", f"{t}.") for t in range(20_000)]
    source = conversations(spark, rows)
    got = conversation_repair.repaired(source, source).first()
    assert got["cost"] == 40_000 and got["audit"] == "R" * 20_000 and got["gaps"] == 0


def test_products_beyond_64_bits_are_refused(spark):
    from ledgerline.llm import mtree

    rows = [(0, [3e7] * 64), (50, [3e7] * 64), (1, [1.0] * 64)]
    with pytest.raises(Exception, match="may not fit 64 bits"):
        mtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
