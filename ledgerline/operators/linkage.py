"""Record linkage by Fellegi-Sunter scores, anchored clusters, and joins with a confidence."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys
from . import anchors
from .rows import first_rows


def match_weight(level: Column, m: list[float], u: list[float]) -> Column:
    """log2 of the Bayes factor of an agreement level (0: best); a null level carries no evidence."""
    w = F.lit(None)
    for i, (a, b) in reversed(list(enumerate(zip(m, u)))):
        w = F.when(level == i, math.log2(a / b)).otherwise(w)
    return F.coalesce(w.cast("double"), F.lit(0.0))


def probability(weight: Column, prior: Column) -> Column:
    odds = F.pow(F.lit(2.0), weight) * prior / (1 - prior)
    return odds / (1 + odds)


def levels(score: Column, cuts: list[float]) -> Column:
    """0 for a score of at least cuts[0], 1 for cuts[1] ...; len(cuts) below all."""
    out = F.lit(len(cuts))
    for i, c in reversed(list(enumerate(cuts))):
        out = F.when(score >= c, i).otherwise(out)
    return F.when(score.isNotNull(), out)


def best_names(names: DataFrame, least: float = 0.8) -> DataFrame:
    """a, b, score: for every row of names(k, n, block) the other row of its block with the most similar name by Jaro-Winkler, at
    `least` similar (ties: the smaller key).  Only different names are compared, so the work is the square of those of a block."""
    first = names.groupBy("block", "n").agg(F.min("k").alias("k1"))
    # a name's own second row is the match of its first one, and the first that of all others
    second = names.join(first, ["block", "n"]).where("k <> k1").groupBy("block", "n").agg(F.min("k").alias("k2"))
    x, y = first.toDF("block", "n", "x1"), first.toDF("block", "o", "y1")
    pairs = x.join(y, "block").where("n <> o").withColumn("j", keys.jaro_winkler(F.col("n"), F.col("o"))).where(F.col("j") >= least)
    other = first_rows(pairs, ["block", "n"], [F.round("j", 9).desc(), F.col("y1")]).select("block", "n", "y1", "j")
    known = first.join(second, ["block", "n"], "left").join(other, ["block", "n"], "left")
    b = F.when(F.col("k") != F.col("k1"), F.col("k1")).otherwise(F.coalesce("k2", "y1"))
    score = F.when(F.col("k2").isNotNull(), F.lit(1.0)).otherwise(F.col("j"))
    return names.join(known, ["block", "n"]).select(F.col("k").alias("a"), b.alias("b"), score.alias("score")).where("b IS NOT NULL")


def _deletions(x: Column, edits: int) -> Column:
    """The text and what is left of it after up to so many single deletions."""
    out = F.array(x)
    for _ in range(edits):
        shorter = F.flatten(F.transform(out, lambda s: F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))).otherwise(F.array(s))))
        out = F.array_distinct(F.concat(out, shorter))
    return out


def within_edits(left: DataFrame, right: DataFrame, edits: int = 1, same: tuple[str, ...] = ()) -> DataFrame:
    """a, b of left(a, x) and right(b, y) whose texts are at most so many edits apart, and whose columns `same` are equal: such
    texts have a deletion variant in common, so they meet in an equi-join."""
    l, r = (d.select("*", F.explode(_deletions(F.col(c), edits)).alias("k")) for d, c in ((left, "x"), (right, "y")))
    return l.join(r, ["k", *same]).where(F.levenshtein("x", "y") <= edits).select("a", "b").distinct()


def contained(short: DataFrame, long_: DataFrame) -> DataFrame:
    """a, b of short(a, x) and long_(b, y) where x, not empty, stands in y.  The parts of y are joined with x; names are short."""
    n = F.length("y")
    starts = long_.where(n > 0).select("b", "y", F.explode(F.sequence(F.lit(1), n)).alias("i"))
    parts = starts.select("b", F.explode(F.transform(F.sequence(F.lit(1), F.length("y") - F.col("i") + 1), lambda k: F.substring("y", F.col("i"), k))).alias("x"))
    return short.where(F.length("x") > 0).join(parts, "x").select("a", "b").distinct()


def name_cascade(left: DataFrame, right: DataFrame) -> DataFrame:
    """a, b, method: left(a, x) matched with right(b, y) by the same name; else by the only name that holds it or that it holds;
    else by the only name one edit away.  Names without a match have a null b."""
    exact = left.join(right, F.col("x") == F.col("y")).select("a", "b", F.lit("same name").alias("method"))
    rest = left.join(exact.select("a").distinct(), "a", "left_anti")
    turned = contained(right.toDF("a", "x"), rest.toDF("b", "y")).toDF("b", "a").select("a", "b")
    only = lambda pairs, method: pairs.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("b")).where("n = 1").select("a", "b", F.lit(method).alias("method"))
    inside = contained(rest, right).union(turned).distinct()
    one = only(inside, "name inside")
    left_over = rest.join(one.select("a"), "a", "left_anti")
    near = within_edits(left_over, right).join(left.select("a", "x"), "a").join(right, "b").where(F.levenshtein("x", "y") == 1).select("a", "b")
    found = exact.unionByName(one).unionByName(only(near, "one letter"))
    return left.select("a").join(found, "a", "left")


def phrase_scores(texts: DataFrame, bank: DataFrame, floor: float) -> DataFrame:
    """id, question, score, hits: each text's best question by the phrases of bank(question, phrase, weak) that stand in it.

    Each phrase found is worth 0.15 over 0.55, a longest one 0.03 a further word, up to 0.95; one weak phrase alone stays below
    the floor.  Texts become runs of words as long as the longest phrase and are joined with the phrases."""
    words = lambda c: F.filter(F.split(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "), " "), lambda w: w != "")
    keys_ = bank.select("question", "weak", words(F.col("phrase")).alias("w")).select("question", "weak", F.array_join("w", " ").alias("phrase"), F.size("w").alias("n")).where("n > 0").distinct()
    sizes = [r[0] for r in keys_.select("n").distinct().collect()]  # word counts of phrases: a few numbers
    w = texts.select("id", words(F.coalesce("text", F.lit(""))).alias("w"))

    def of(n: int) -> Column:
        """All runs of n words."""
        return F.when(F.size("w") >= n, F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))).otherwise(F.array().cast("array<string>"))

    runs = F.flatten(F.array(*map(of, sizes)))
    hits = w.select("id", F.explode(F.array_distinct(runs)).alias("phrase")).join(keys_, "phrase")
    each = hits.groupBy("id", "question").agg(F.count("*").alias("hits"), F.max("n").alias("longest"), F.min("weak").alias("all_weak"))
    score = F.when(F.col("all_weak") & (F.col("hits") == 1), F.lit(floor - 0.02)).otherwise(F.least(F.lit(0.95), 0.55 + 0.15 * F.col("hits") + 0.03 * (F.col("longest") - 1)))
    return first_rows(each.withColumn("score", score), ["id"], [F.col("score").desc(), F.col("question")]).select("id", "question", F.round("score", 3).alias("score"), "hits")


def unit_matches(sheet: DataFrame, register: DataFrame, tolerance: float = 0.03, tail: int = 3) -> DataFrame:
    """a, b, method: units of sheet(a, project, number, size) found in register(b, project, number, size).  In the project, the
    number's digits and a size within the tolerance; else its last digits and the size.  A unit is matched only where one is
    left to choose; several are 'ambiguous', none is a null method."""
    of = lambda df, k, n: df.select(k, "project", F.regexp_replace("number", "[^0-9]", "").alias(f"d{n}"), F.col("size").alias(f"s{n}"))
    l, r = of(sheet, "a", 1), of(register, "b", 2)
    fits = F.abs(F.col("s1") - F.col("s2")) <= tolerance * F.col("s2")

    def stage(left: DataFrame, key1: Column, key2: Column, method: str) -> DataFrame:
        j = left.withColumn("k", key1).where("k <> ''").join(r.withColumn("k", key2), ["project", "k"]).where(fits)
        g = j.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("b"))
        return g.select("a", F.when(F.col("n") == 1, F.col("b")).alias("b"), F.when(F.col("n") == 1, method).otherwise("ambiguous").alias("method"))

    exact = stage(l, F.col("d1"), F.col("d2"), "number")
    rest = l.join(exact.select("a"), "a", "left_anti")
    end = lambda c: F.when(F.length(c) >= tail, F.right(F.col(c), F.lit(tail)))
    return sheet.select("a").join(exact.unionByName(stage(rest, end("d1"), end("d2"), "tail")), "a", "left")


def resolved(evidence: DataFrame, authority: list[str], survey: list[str], order: list[str], structural: list[str]) -> DataFrame:
    """entity, role, value, grade, score, sources for evidence(entity, role, value, source, score, confidence).

    Of each role the best value wins: six points more if several sources give it (values compared without case, marks and
    spaces), then confidence; the first role of `order` that has a value names the entity.  Roles outside `order` never do."""
    e = evidence.where(F.col("role").isin(order) & (F.col("score") > 0)).withColumn("same", keys.squeezed(F.col("value")))
    top = F.max_by(F.struct("value", "source"), F.struct("score", "confidence", "value", "source")).alias("top")
    g = e.groupBy("entity", "role", "same").agg(top, F.max(F.struct("score", "confidence")).alias("best"), F.array_sort(F.collect_set("source")).alias("sources"))
    g = g.withColumn("score", F.col("best.score") + F.when(F.size("sources") > 1, 6).otherwise(0))
    place = F.array_position(F.array(*map(F.lit, order)), F.col("role"))
    chosen = first_rows(g.withColumn("place", place), ["entity"], [F.col("place"), F.col("score").desc(), F.col("best.confidence").desc(), F.col("same")])
    source = F.col("top.source")
    grade = F.when(source.isin(authority), "VERIFIED").when(F.col("role").isin(structural), "STRUCTURALLY_IDENTIFIED").when(source.isin(survey), "MATCHED").otherwise("INFERRED")
    return chosen.select("entity", "role", F.col("top.value").alias("value"), grade.alias("grade"), "score", F.array_join("sources", ",").alias("sources"))


def anchored_clusters(rows: DataFrame, bucket: str, order: str, item: str, size: str, price: str) -> DataFrame:
    """item, anchor: in order, each row joins the first anchor of its bucket whose size is within max(3 %, 25) and price within
    max(2 %, 2000) of the anchor's, or becomes an anchor."""
    from ..sources.lake import stored

    named = rows.select(F.col(item).alias("item"), F.col(bucket).alias("bucket"), F.col(order).alias("at"), F.col(size).alias("size"), F.col(price).alias("price"), *[F.lit(None).cast(k).alias(c) for c, k in (("furnished", "string"), ("lat", "double"), ("lon", "double"))])
    return anchors.clusters(named, stored, larger=False)
