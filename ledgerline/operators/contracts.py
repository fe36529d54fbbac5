"""Contracts of feeds and extracts: what may be used, and why the rest is held."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..streaming import holds

#: MiB at which downloads are capped
CAPS = (64, 128, 256, 512, 1024, 2048, 4096)


def feed_status(feeds: DataFrame, shrink: float = 0.8, fresh_days: int = 14) -> DataFrame:
    """feeds(key, reported, loaded, in_table, distinct_rows, accepted, age) with status and reason.  Unknown figures judge nothing."""
    reported, loaded, there, accepted = (F.coalesce(F.col(c), F.lit(0)) for c in ("reported", "loaded", "in_table", "accepted"))
    rules = [
        ((reported > 0) & ((there == 0) | (loaded == 0)), "held", "nothing loaded"),
        (F.col("in_table") != F.col("loaded"), "held", "table differs"),
        (F.col("distinct_rows") < F.col("in_table"), "held", "repeats reached the table"),
        ((accepted > 0) & (F.col("loaded") < shrink * accepted), "held", "shrank"),
        (F.col("age") > fresh_days, "stale", "old"),
        (F.col("reported") > F.col("loaded"), "ok-deduplicated", "source repeats"),
    ]
    status, reason = F.lit("ok"), F.lit("")
    for when, s, r in reversed(rules):
        status, reason = F.when(when, s).otherwise(status), F.when(when, r).otherwise(reason)
    return feeds.withColumn("status", status).withColumn("reason", reason)


def collapse_holds(readings: DataFrame, group: str, at: str, n: str, floor: int = 10, shrink: float = 0.5, agree: float = 0.25) -> DataFrame:
    """readings with `accepted` (the count accepted before) and `held`: below `shrink` of an accepted count of at least `floor`,
    unless a later reading is within `agree` of it.  Readings of one time are taken by their count."""
    return holds.judged(readings, group, at, n, floor=floor, shrink=shrink, agree=agree)


def manifest_status(files: DataFrame) -> DataFrame:
    """status of files(listed, parts, published, cut, failed, fetched, extract): parts on disk against parts published."""
    status = (
        F.when((F.col("listed") > 0) & (F.col("parts") == 0), "missing").when(F.col("published").isNull(), F.when(F.col("cut"), "partial").otherwise("unverified"))
        .when(F.col("failed") | F.col("cut") | (F.col("parts") < F.col("published")), "partial").when(F.col("extract") > F.col("fetched"), "behind").otherwise("complete")
    )
    return files.withColumn("status", status)


def cut_short(name: Column, size: Column, tail: Column) -> Column:
    """Why a file looks cut off, from its size and its last characters; empty if it ends whole."""
    low, end = F.lower(name), F.lower(F.rtrim(F.regexp_replace(tail, r"\s+$", "")))
    return (
        F.when(size.isin(*[m << 20 for m in CAPS]), "a download cap").when(low.endswith(".kml") & ~end.endswith("</kml>"), "never closes").when(low.endswith(".json") & ~end.rlike(r"[\]}]$"), "never closes")
        .when(low.endswith(".csv") & (size > 0) & ~tail.rlike(r"[\r\n]$"), "the last line has no end").otherwise("")
    )


def bridge_agrees(checks: DataFrame, a: str, b: str, share: float = 0.99, least: int = 100) -> bool:
    """Do two keys agree on enough of enough rows that know both, for one to stand in for the other?"""
    both = checks.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    seen = both.agg(F.count("*").alias("n"), F.count(F.when(F.col(a) == F.col(b), 1)).alias("agree")).first()
    return seen["n"] >= least and seen["agree"] >= share * seen["n"]


def roles(columns: list[str], patterns: dict[str, str]) -> dict[str, str]:
    """The role of each column whose name fits a pattern; the first pattern that fits decides."""
    return {c: next(r for r, p in patterns.items() if re.search(p, c)) for c in columns if any(re.search(p, c) for p in patterns.values())}


def match_rate(df: DataFrame, column: str, spine: DataFrame) -> DataFrame:
    """n, matched: rows with a value, and those whose value the spine (one column) knows."""
    known = spine.toDF("__k").where("__k IS NOT NULL").distinct().withColumn("__in", F.lit(1))
    j = df.select(F.col(column).alias("__v")).where("__v IS NOT NULL").groupBy("__v").agg(F.count("*").alias("__n")).join(known, F.col("__v") == F.col("__k"), "left")
    return j.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("__in") == 1, F.col("__n"))), F.lit(0)).alias("matched"))


def scorecard(answers: DataFrame, thin: int = 5, wrong: float = 0.2) -> DataFrame:
    """verdict, questions, answers for answers(question, answers, wrong): FAIL, THIN or PASS."""
    verdict = F.when((F.col("answers") == 0) | (F.col("wrong") > wrong * F.col("answers")), "FAIL").when(F.col("answers") < thin, "THIN").otherwise("PASS")
    return answers.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("questions"), F.sum("answers").alias("answers"))


def filled(sources: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """(value, source) of the first source that has a value."""
    source = F.lit(None)
    for name, x in reversed(sources):
        source = F.when(x.isNotNull(), name).otherwise(source)
    return F.coalesce(*[x for _, x in sources]), source
