"""Names, slugs, JSON inside pages, and sketches that are merged over days."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names
from ..operators import sketches, slugs
from ..sources import embedded
from .registry import Tables, query

# marks on the names of parts: every seventh has an accent, every eleventh a ligature, every thirteenth wide digits
_MARKED = "CASE WHEN p_partkey % 7 = 0 THEN replace(p_name, 'e', 'é') WHEN p_partkey % 11 = 0 THEN p_name || ' ﬁn' WHEN p_partkey % 13 = 0 THEN p_name || ' １２' ELSE p_name END"
_PLAIN = "CASE WHEN p_partkey % 7 = 0 THEN p_name WHEN p_partkey % 11 = 0 THEN p_name || ' fin' WHEN p_partkey % 13 = 0 THEN p_name || ' 12' ELSE p_name END"


@query("I05", f"""WITH n AS (SELECT p_partkey, {_PLAIN} AS plain FROM part)
    SELECT p_partkey, plain AS folded, regexp_replace(lower('The Tower of ' || plain), '[^a-z0-9]', '', 'g') AS key, 'the_tower_of_' || regexp_replace(lower(plain), '[^a-z0-9]+', '_', 'g') AS underscored, 'Tower ' || plain AS bare, 'of' || regexp_replace(lower(plain), '[^a-z0-9]', '', 'g') AS stem FROM n""")
def normal_forms(t: Tables):
    """The normal forms of names with marks, ligatures and wide digits."""
    n = t.part.select("p_partkey", F.expr(_MARKED).alias("name"))
    whole = F.concat(F.lit("The Tower of "), F.col("name"))
    return n.select("p_partkey", names.folded(F.col("name")).alias("folded"), names.name_key(whole).alias("key"), names.underscored(whole).alias("underscored"), names.without_filler(names.folded(whole)).alias("bare"), names.stem(whole).alias("stem"))


_SHEETS = "keys AS (SELECT 'supplierhall' || s_suppkey || CASE s_suppkey % 4 WHEN 0 THEN 'bay' WHEN 1 THEN 'northgate' ELSE '' END AS key, 'slug-' || s_suppkey AS slug FROM supplier)"
_ASKED = """CASE c_custkey % 6 WHEN 0 THEN 'Supplier Hall ' || c_custkey || ' Bay' WHEN 1 THEN 'Supplier-Hall ' || c_custkey || ' Northgate, Harbour' WHEN 2 THEN 'The Supplier Hall of ' || c_custkey WHEN 3 THEN 'Supplier Hall ' || c_custkey || ' West Wing' WHEN 4 THEN 'Supplier Hall' ELSE 'Supplier Hall at ' || c_custkey || ' and Bay, by the sea' END"""


@query("K59", f"""WITH {_SHEETS}, asked AS (SELECT c_custkey AS a, {_ASKED} AS name FROM customer),
    k AS (SELECT a, name, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS k1, regexp_replace(lower(split_part(name, ',', 1)), '[^a-z0-9]', '', 'g') AS k2, list_filter(string_split(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w NOT IN ('', 'a', 'and', 'at', 'by', 'in', 'of', 'on', 'the')) AS w3, list_filter(string_split(regexp_replace(lower(split_part(name, ',', 1)), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w NOT IN ('', 'a', 'and', 'at', 'by', 'in', 'of', 'on', 'the')) AS w4 FROM asked),
    b AS (SELECT k.a, x.key, x.slug FROM k JOIN keys x ON length(x.key) >= 9 AND starts_with(k1, x.key) QUALIFY row_number() OVER (PARTITION BY k.a ORDER BY length(x.key) DESC) = 1),
    p AS (SELECT a, slug FROM b WHERE (SELECT count(DISTINCT z.slug) FROM keys z WHERE starts_with(z.key, b.key)) = 1)
    SELECT k.a, coalesce(e1.slug, e2.slug, e3.slug, e4.slug, p.slug) AS slug, CASE WHEN e1.slug IS NOT NULL THEN 'exact' WHEN e2.slug IS NOT NULL THEN 'before the comma' WHEN e3.slug IS NOT NULL THEN 'without joining words' WHEN e4.slug IS NOT NULL THEN 'without joining words, before the comma' WHEN p.slug IS NOT NULL THEN 'beginning' END AS stage
    FROM k LEFT JOIN keys e1 ON e1.key = k1 LEFT JOIN keys e2 ON e2.key = k2 LEFT JOIN keys e3 ON e3.key = array_to_string(w3, '') LEFT JOIN keys e4 ON e4.key = array_to_string(w4, '') LEFT JOIN p ON p.a = k.a""")
def slug_resolution(t: Tables):
    """Names asked for in five ways against the slugs of suppliers."""
    k = F.col("s_suppkey")
    key = F.concat(F.lit("supplierhall"), k.cast("string"), F.when(k % 4 == 0, "bay").when(k % 4 == 1, "northgate").otherwise(""))
    register = t.supplier.select(key.alias("key"), F.concat(F.lit("slug-"), k.cast("string")).alias("slug"))
    return slugs.resolved(t.customer.select(F.col("c_custkey").alias("a"), F.expr(_ASKED).alias("name")), register)


_JSON = """'<script id=x type="application/ld+json">{"@graph": [{"@type": "Page", "id": ' || page_id || ', "note": "a } in \\\\"quotes\\\\""}, {"@type": ["Thing", "List"], "items": [{"@type": "Item", "n": ' || page_id % 7 || '}]}]}</script>' || CASE WHEN page_id % 5 = 0 THEN '<script type="application/ld+json">{"@type": "Page", "id": </script>' ELSE '' END"""


@query("A20", """SELECT page_id, page_id AS said, page_id % 7 AS n, 1 + CAST(page_id % 5 = 0 AS INTEGER) AS blocks, CAST(page_id % 5 = 0 AS INTEGER) AS broken, 1 + len(regexp_extract_all(html, 'p\\{margin:0\\}')) AS objects FROM pages""")
def embedded_json(t: Tables):
    """Pages that carry JSON after their own text: blocks of a type, typed objects at any depth, broken blocks, and balanced
    braces of the whole page, styles included."""
    pages = t.pages.select("page_id", F.concat("html", F.expr(_JSON)).alias("html"))
    found = pages.select("page_id", embedded.blocks(F.col("html")).alias("blocks"), F.size(embedded.objects(F.col("html"))).alias("objects"))
    read = found.select(F.col("page_id").alias("id"), F.explode("blocks").alias("text")).withColumn("v", F.try_parse_json("text"))
    nodes = embedded.nodes(read.select("id", "v"), 4)
    said = embedded.typed(nodes, ["Page"]).select(F.col("id").alias("page_id"), F.try_variant_get("node", "$.id", "bigint").alias("said"))
    items = embedded.typed(nodes, ["Item"]).select(F.col("id").alias("page_id"), F.try_variant_get("node", "$.n", "bigint").alias("n"))
    broken = read.groupBy(F.col("id").alias("page_id")).agg(F.count(F.when(F.col("v").isNull(), 1)).cast("int").alias("broken"))
    return found.join(said, "page_id").join(items, "page_id").join(broken, "page_id").select("page_id", "said", "n", F.size("blocks").alias("blocks"), "broken", "objects")


@query("E36", """WITH d AS (SELECT event_type, count(*) AS n FROM events WHERE dayofyear(ts) BETWEEN 5 AND 24 GROUP BY 1) SELECT event_type, n, true AS distinct_close, true AS median_close FROM d""")
def merged_sketches(t: Tables):
    """Sketches of each day and type, merged over twenty days, against exact figures of the same rows."""
    e = t.events.withColumn("day", F.dayofyear("ts"))
    asked = F.col("day").between(5, 24)
    parts = sketches.sketched(e, ["event_type", "day"], "user_id", "value")
    told = sketches.merged(parts.where(asked), ["event_type"], [0.47, 0.53])
    exact = e.where(asked).groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.percentile("value", 0.5).alias("median"))
    close = F.abs(F.col("distinct") - F.col("users")) <= F.greatest(F.lit(2), 0.06 * F.col("users"))
    return told.join(exact, "event_type").select("event_type", "n", close.alias("distinct_close"), F.col("median").between(F.col("quantiles")[0], F.col("quantiles")[1]).alias("median_close"))
