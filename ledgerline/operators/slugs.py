"""Looking up names in a register of keys: exact, before the comma, without joining words, then by an unambiguous beginning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import name_key, without_filler
from .rows import first_rows


def prefix_index(register: DataFrame, least: int = 9) -> DataFrame:
    """prefix, targets, slug of register(key, slug): every beginning of a key from `least` letters on, how many slugs lie under
    it, and the slug if the beginning is a key itself.  Its size is that of the register times the length of keys."""
    keys = register.where("key IS NOT NULL AND key <> ''").groupBy("key").agg(F.min("slug").alias("slug"))
    long_ = keys.where(F.length("key") >= least)
    cut = long_.select("slug", F.explode(F.transform(F.sequence(F.lit(least), F.length("key")), lambda n: F.substring(F.col("key"), F.lit(1), n))).alias("prefix"))
    return cut.groupBy("prefix").agg(F.countDistinct("slug").alias("targets")).join(keys.select(F.col("key").alias("prefix"), "slug"), "prefix", "left")


def resolved(names: DataFrame, register: DataFrame, least: int = 9) -> DataFrame:
    """a, slug, stage of names(a, name) in register(key, slug).  A later stage is asked only where the earlier ones found nothing;
    the longest key that begins the name is refused if it begins the keys of several slugs."""
    keys = register.where("key IS NOT NULL AND key <> ''").groupBy("key").agg(F.min("slug").alias("slug"))
    head = F.split_part("name", F.lit(","), F.lit(1))
    tries = [("exact", name_key(F.col("name"))), ("before the comma", name_key(head)), ("without joining words", name_key(without_filler(F.col("name")))), ("without joining words, before the comma", name_key(without_filler(head)))]
    asked = names.select("a", F.coalesce("name", F.lit("")).alias("name"))
    each = asked.select("a", F.posexplode(F.array(*[k for _, k in tries])).alias("place", "key")).where("key <> ''")
    hit = first_rows(each.join(keys, "key"), ["a"], [F.col("place")]).select("a", "slug", F.element_at(F.array(*[F.lit(n) for n, _ in tries]), F.col("place") + 1).alias("stage"))
    k = asked.select("a", name_key(F.col("name")).alias("k")).where(F.length("k") >= least).join(hit.select("a"), "a", "left_anti")
    begins = k.select("a", F.explode(F.transform(F.sequence(F.lit(least), F.length("k")), lambda n: F.substring(F.col("k"), F.lit(1), n))).alias("prefix"))
    index = prefix_index(register, least).where("slug IS NOT NULL")
    longest = first_rows(begins.join(index, "prefix"), ["a"], [F.length("prefix").desc()]).where("targets = 1")
    found = hit.unionByName(longest.select("a", "slug", F.lit("beginning").alias("stage")))
    return names.select("a").join(found, "a", "left")
