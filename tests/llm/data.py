"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing names, no rows."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, found string, row string, part int, uid long, count long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def prose(rng, n):
    return " ".join("".join(rng.choice(["an", "re", "ti", "ou", "sch", "é", "th"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def texts():
    rng = random.Random(5)
    base, passage = prose(rng, 300), prose(rng, 120)
    near = base.split()
    near[40] = "changed"
    long_ = " ".join([prose(rng, 1500), passage, prose(rng, 1500)])
    return [
        (1, base), (2, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "one two"), (None, "no key " + passage), (None, None), (7, long_), (8, passage + "\n" + passage), (9, "a" * 1200), (10, "ab" * 700 + "!"),
        (11, "... !!!"), (12, "... !!!"), (13, "\x1c\x85 odd\x00 ｆｕｌｌ İ ǅ <|endoftext|> it's 12"), (14, base.upper()), (15, "mail me: a.b@x-y.com.  +1 (771) 555-1655; 4111 1111 1111 1111 10.0.0.256 10.0.0.255"), (15, "other text, same key"), (-3, "é" * 900),
    ]


def table(spark, rows=None):
    rows = texts() if rows is None else rows
    made = spark.createDataFrame([(i, t, None, "s", None, "x", "y", 1, 2, 3) for i, t in rows], SCHEMA)
    return made.repartition(3, F.col("n_chars"), F.col("text")) if rows else made
