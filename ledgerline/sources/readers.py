"""Readers that land everything as text, JSON envelopes, and the choice of the extract to read.

Which extract is read is decided from names and counts on the driver (a folder's entries); the rows stay in Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """CSV parts (plain or gzip) with a header, every column as text; columns that a part lacks are null.  A byte-order
    mark before the first header goes."""

    def one(path: str) -> DataFrame:
        df = spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE").csv(path)
        return df.toDF(*[c.lstrip("﻿") for c in df.columns])

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(one, paths))


def json_envelope(spark: SparkSession, path: str, records: str = "results") -> DataFrame:
    """The records of an envelope {..., results: [...]}, or of a plain array."""
    df = spark.read.option("multiLine", True).json(path)
    return df.select(F.explode(records).alias("r")).select("r.*") if records in df.columns else df


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str, keep_repeats: bool = False) -> DataFrame:
    df = spark.read.schema(schema).json(path)
    return df if keep_repeats else df.dropDuplicates()


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Structs to columns, at every depth; arrays stay."""
    while any(isinstance(f.dataType, T.StructType) for f in df.schema):
        out = []
        for f in df.schema:
            if isinstance(f.dataType, T.StructType):
                out += [F.col(f"`{f.name}`").getField(k).alias(f"{f.name}{sep}{k}") for k in f.dataType.names]
            else:
                out.append(F.col(f"`{f.name}`"))
        df = df.select(out)
    return df


def newest_complete(manifest: DataFrame, parts: DataFrame) -> DataFrame:
    """Parts of the newest extract of each source whose parts are all there: manifest(source, extract, n_parts),
    parts(source, extract, path).  Extracts that lack a part are passed over."""
    there = parts.groupBy("source", "extract").agg(F.countDistinct("path").alias("there"))
    whole = manifest.join(there, ["source", "extract"]).where("there >= n_parts")
    best = whole.groupBy("source").agg(F.max("extract").alias("extract"))
    return parts.join(best, ["source", "extract"], "left_semi")


def entries(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder, of any store that Spark reads; none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(path)) if fs.exists(path) else []


def newest_stamp(spark: SparkSession, folder: str, name: str, stamp: str | None = None) -> str:
    """The extract <name>_<stamp> of this run, or else the newest <name>_<date> that is no year-to-date one."""
    there = entries(spark, folder)
    if stamp and f"{name}_{stamp}" in there:
        return f"{folder}/{name}_{stamp}"
    dated = [(m[1], x) for x in there if (m := re.fullmatch(rf"{re.escape(name)}_(\d{{4}}-\d{{2}}-\d{{2}})", x))]
    if not dated:
        raise FileNotFoundError(f"{folder}: no extract of {name}")
    return f"{folder}/{max(dated)[1]}"


def finished_parts(spark: SparkSession, root: str, manifest: Iterable[tuple[str, str, list[str]]]) -> list[str]:
    """Paths of all parts of the newest finished extract of manifest (extract, status, parts).  A part that is listed but not
    there is an error: it is never passed over."""
    done = max(((e, parts) for e, status, parts in manifest if status == "ok"), default=None)
    if done is None:
        raise FileNotFoundError(f"{root}: no finished extract")
    there = set(entries(spark, f"{root}/{done[0]}"))
    if lost := [p for p in done[1] if p not in there]:
        raise FileNotFoundError(f"{root}/{done[0]}: {lost} not there")
    return [f"{root}/{done[0]}/{p}" for p in done[1]]


def fullest_daily(spark: SparkSession, folder: str, name: str, least: int) -> str:
    """Of the newest day on which a finished variant <name>_<date>[_variant] has at least `least` rows, the one with most rows."""
    days: dict[str, list[str]] = {}
    for x in entries(spark, folder):
        if m := re.fullmatch(rf"{re.escape(name)}_(\d{{4}}-\d{{2}}-\d{{2}})(_\w+)?", x):
            if "_SUCCESS" in entries(spark, f"{folder}/{x}"):  # still being written otherwise
                days.setdefault(m[1], []).append(f"{folder}/{x}")
    for day in sorted(days, reverse=True):
        n, path = max((text_csv(spark, path).count(), path) for path in days[day])
        if n >= least:
            return path
    raise FileNotFoundError(f"{folder}: no {name} with {least} rows")


def projected_json(spark: SparkSession, paths: list[str], schema: str, keep: Column) -> DataFrame:
    """The wanted fields of many JSON files, filtered as they are read."""
    return spark.read.schema(schema).json(paths).where(keep)


def geojson_vertices(spark: SparkSession, path: str, key: str) -> DataFrame:
    """key, ring, v, lon, lat: the vertices of the polygons of a feature collection; features without the key are left out."""
    features = spark.read.option("multiLine", True).schema(f"features array<struct<properties: struct<{key}: string>, geometry: struct<coordinates: array<array<array<double>>>>>>").json(path).select(F.explode("features").alias("f"))
    rings = features.where(F.col(f"f.properties.{key}").isNotNull()).select(F.col(f"f.properties.{key}").alias(key), F.posexplode("f.geometry.coordinates").alias("ring", "points"))
    return rings.select(key, "ring", F.posexplode("points").alias("v", "p")).select(key, "ring", "v", F.element_at("p", 1).alias("lon"), F.element_at("p", 2).alias("lat"))


def kml_rings(spark: SparkSession, path: str) -> DataFrame:
    """name, ring (array of lon, lat structs) of each placemark of KML files."""
    marks = spark.read.text(path, wholetext=True).select(F.explode(F.regexp_extract_all("value", F.lit("(?s)<Placemark>(.*?)</Placemark>"), F.lit(1))).alias("m"))
    points = F.filter(F.split(F.regexp_extract("m", "(?s)<coordinates>(.*?)</coordinates>", 1), r"\s+"), lambda p: p.contains(","))
    pair = lambda p: F.struct(F.split(p, ",")[0].try_cast("double").alias("lon"), F.split(p, ",")[1].try_cast("double").alias("lat"))
    return marks.select(F.regexp_extract("m", "(?s)<name>(.*?)</name>", 1).alias("name"), F.transform(points, pair).alias("ring"))


def precedence(best: DataFrame, sample: DataFrame) -> DataFrame:
    """key, env, rows for manifests (key, status, rows) of two environments: the first where it is ok, or is not but holds more
    rows; the second where it is ok; else whichever there is, the first before the second."""
    b, s = best.toDF("key", "b_status", "b_rows"), sample.toDF("key", "s_status", "s_rows")
    env = (
        F.when(F.col("b_status") == "ok", "best").when(F.coalesce("b_rows", F.lit(0)) > F.coalesce("s_rows", F.lit(0)), "best_partial").when(F.col("s_status") == "ok", "sample")
        .when(F.col("b_status").isNotNull(), "best").otherwise("sample")
    )
    return b.join(s, "key", "full").withColumn("env", env).select("key", "env", F.when(F.col("env") == "sample", F.col("s_rows")).otherwise(F.col("b_rows")).alias("rows"))


def healed(known: DataFrame, pulls: Iterable[DataFrame], key: str, floor: int = 50, share: float = 0.002) -> DataFrame:
    """The union of pulls, each adding the rows that are new, until at most max(floor, share of known) known keys are missing."""
    have, total = None, known.count()
    for pull in pulls:
        have = pull if have is None else have.unionByName(pull.join(have.select(key), key, "left_anti"))
        if known.join(have.select(key), key, "left_anti").count() <= max(floor, share * total):
            break
    return have


def spilled(spark: SparkSession, folder: str, run_date: str, schema: str) -> DataFrame:
    """The rows that a run left in its spill folder; none if it left nothing."""
    path = f"{folder}/run_date={run_date}"
    return spark.read.schema(schema).json(path) if entries(spark, path) else spark.createDataFrame([], schema)


def last_label(title: Column) -> Column:
    """What follows the last comma of a series' title."""
    return F.trim(F.element_at(F.split(title, ","), -1))
