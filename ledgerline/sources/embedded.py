"""JSON that stands in pages: blocks of script elements, objects of balanced braces in any text, and a walk over what they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = r'("(?:[^"\\]|\\.)*"|[{}]|[^"{}]+|")'
_BLOCK = r'(?is)<script[^>]+type="{kind}"[^>]*>(.*?)</script>'


def blocks(html: Column, kind: str = "application/ld+json") -> Column:
    """The contents of the script elements of a type, whole as they stand."""
    pattern = _BLOCK.replace("{kind}", kind.replace("+", r"\+").replace(".", r"\."))
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(pattern), F.lit(1))


def objects(text: Column) -> Column:
    """The outermost objects of balanced braces in a text, in order.  Braces inside quoted strings do not count, a closing brace
    without an open one is passed over, an object that never closes is none.

    The text is cut into strings, braces and what lies between; depths are added up along them."""
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), F.lit(1))
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("depth"), F.lit(0).alias("open"), F.array().cast("array<struct<a:int,n:int>>").alias("found"))

    def step(s: Column, t: Column) -> Column:
        opens, closes = t == "{", (t == "}") & (s["depth"] > 0)
        depth = s["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        done = closes & (depth == 0)
        span = F.struct((s["open"] + 1).alias("a"), (s["i"] - s["open"] + 1).alias("n"))
        return F.struct((s["i"] + 1).alias("i"), depth.alias("depth"), F.when(opens & (s["depth"] == 0), s["i"]).otherwise(s["open"]).alias("open"), F.when(done, F.concat(s["found"], F.array(span))).otherwise(s["found"]).alias("found"))

    spans = F.aggregate(tokens, start, step, lambda s: s["found"])
    return F.transform(spans, lambda x: F.array_join(F.slice(tokens, x["a"], x["n"]), ""))


def nodes(values: DataFrame, depth: int = 12) -> DataFrame:
    """id, path, node (VARIANT) of every object and array within values(id, v VARIANT), to a depth of so many steps."""
    level = values.select("id", F.lit("$").alias("path"), F.col("v").alias("node")).where("node IS NOT NULL")
    out = level
    spark = values.sparkSession
    for _ in range(depth):
        level.createOrReplaceTempView("ledgerline_nodes")
        below = spark.sql("SELECT id, path || '.' || coalesce(x.key, CAST(x.pos AS STRING)) AS path, x.value AS node FROM ledgerline_nodes, LATERAL variant_explode(node) x WHERE schema_of_variant(x.value) RLIKE '^(OBJECT|ARRAY)'")
        out, level = out.unionByName(below), below
    spark.catalog.dropTempView("ledgerline_nodes")
    return out


def typed(found: DataFrame, kinds: list[str]) -> DataFrame:
    """Objects of nodes() whose @type is one of the kinds, alone or in a list."""
    kind = F.try_variant_get("node", "$['@type']", "string")
    listed = F.try_variant_get("node", "$['@type']", "array<string>")
    return found.where(kind.isin(kinds) | F.coalesce(F.arrays_overlap(listed, F.array(*map(F.lit, kinds))), F.lit(False)))
