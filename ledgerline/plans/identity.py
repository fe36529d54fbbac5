"""Names, aliases, identities and places."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geo, keys, roles
from ..operators import linkage, rows, space
from .market import _DIST, _HEX, _LEFT, _RIGHT, _both, _points
from .registry import Tables, query

_SPELT = "CASE n_nationkey % 4 WHEN 0 THEN n_name WHEN 1 THEN n_name || ' STATION' WHEN 2 THEN left(n_name, 1) || substr(n_name, 3) ELSE 'Z' || n_name || 'Q' END"


@query("K20,I27", f"""WITH l AS (SELECT n_nationkey AS a, {_SPELT} AS x FROM nation), r AS (SELECT n_nationkey AS b, n_name AS y FROM nation), e AS (SELECT a, b FROM l JOIN r ON x = y),
    c AS (SELECT a, min(b) AS b FROM l, r WHERE a NOT IN (SELECT a FROM e) AND (contains(x, y) OR contains(y, x)) GROUP BY 1 HAVING count(*) = 1),
    o AS (SELECT a, min(b) AS b FROM l, r WHERE a NOT IN (SELECT a FROM e UNION SELECT a FROM c) AND levenshtein(x, y) = 1 GROUP BY 1 HAVING count(*) = 1)
    SELECT l.a, f.b, method FROM l LEFT JOIN (SELECT a, b, 'same name' AS method FROM e UNION ALL SELECT a, b, 'name inside' FROM c UNION ALL SELECT a, b, 'one letter' FROM o) f ON f.a = l.a""")
def station_names(t: Tables):
    """Misspelt and lengthened names against the register: exact, then contained and unique, then one letter away."""
    left = t.nation.select(F.col("n_nationkey").alias("a"), F.expr(_SPELT).alias("x"))
    return linkage.name_cascade(left, t.nation.select(F.col("n_nationkey").alias("b"), F.col("n_name").alias("y")))


@query("I27", "SELECT DISTINCT a.c_custkey AS a, b.c_custkey AS b FROM customer a JOIN customer b ON a.c_custkey < b.c_custkey AND a.c_nationkey = b.c_nationkey AND levenshtein(a.c_name, b.c_name) = 1 WHERE a.c_custkey < 100000")
def one_edit_names(t: Tables):
    """Customers of a nation whose names are one edit apart, by a join on deletion variants; a name that many customers of a
    nation have is compared once.  As in the SQL, the first of two has a key below 100000."""
    c = t.customer.select("c_custkey", "c_nationkey", "c_name")
    named = lambda df, k, x: df.select(F.struct("c_nationkey", "c_name").alias(k), F.col("c_name").alias(x), "c_nationkey").distinct()
    early = c.where("c_custkey < 100000")
    near = linkage.within_edits(named(early, "a", "x"), named(c, "b", "y"), same=("c_nationkey",)).where("a.c_name <> b.c_name")
    near = near.select("a.c_nationkey", F.col("a.c_name").alias("x"), F.col("b.c_name").alias("y"))
    first = early.select("c_nationkey", F.col("c_name").alias("x"), F.col("c_custkey").alias("a"))
    second = c.select("c_nationkey", F.col("c_name").alias("y"), F.col("c_custkey").alias("b"))
    return near.join(first, ["c_nationkey", "x"]).join(second, ["c_nationkey", "y"]).where("a < b").select("a", "b").distinct()


@query("I28")
def wording_similarity(t: Tables):
    """How alike each part's name and type are worded; tests hold it against the rule itself."""
    names = t.part.select("p_name", "p_type").distinct()
    scored = names.withColumn("ratio", F.round(keys.wording(F.lower("p_name"), F.lower("p_type")), 6))
    return t.part.select("p_partkey", "p_name", "p_type").join(scored, ["p_name", "p_type"]).select("p_partkey", "ratio")


_BANK = [("q1", "the", True), ("q1", "of the", False), ("q2", "and", True), ("q2", "in the", False), ("q3", "the", True), ("q3", "and", True), ("q3", "this work is licensed", False)]
_BANK_SQL = ", ".join(f"('{q}', '{p}', {str(w).lower()}, {len(p.split())})" for q, p, w in _BANK)


@query("I29", f"""WITH b(q, p, weak, n) AS (VALUES {_BANK_SQL}), t AS (SELECT conv_id, turn, ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')) || ' ' AS s FROM conversations),
    h AS (SELECT conv_id, turn, q, count(*) AS hits, max(n) AS longest, bool_and(weak) AS all_weak FROM t JOIN b ON contains(s, ' ' || p || ' ') GROUP BY 1, 2, 3),
    c AS (SELECT *, CASE WHEN all_weak AND hits = 1 THEN 0.53 ELSE least(0.95, 0.55 + 0.15 * hits + 0.03 * (longest - 1)) END AS score FROM h)
    SELECT conv_id, turn, q AS question, round(CAST(score AS DOUBLE), 3) AS score, hits FROM c QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY score DESC, q) = 1""")
def phrase_matches(t: Tables):
    bank = t.spark.createDataFrame(_BANK, "question string, phrase string, weak boolean")
    texts = t.conversations.select(F.struct("conv_id", "turn").alias("id"), "text").dropDuplicates()
    return linkage.phrase_scores(texts, bank, 0.55).select("id.conv_id", "id.turn", "question", "score", "hits")


@query("I33,K67", "SELECT p_partkey, n_name FROM part JOIN nation ON false UNION ALL SELECT s_suppkey, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE regexp_matches(' ' || lower(s_name) || ' ' || lower(n_name) || ' ', '[^a-z0-9]' || lower(n_name) || '[^a-z0-9]')")
def whole_word_aliases(t: Tables):
    """Suppliers whose label holds their nation's name as a whole word."""
    s = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
    return s.where(keys.has_word(F.concat_ws(" ", "s_name", "n_name"), F.col("n_name"))).select(F.col("s_suppkey").alias("p_partkey"), "n_name")



@query("I25,I05", "SELECT doc_id, regexp_matches(coalesce(text, ''), '[؀-ۿ]') AS arabic, left(regexp_replace(lower(regexp_replace(coalesce(lang, ''), '[^A-Za-z0-9]', '', 'g')), '[^a-z0-9]', '', 'g'), 8) AS lang_key FROM documents")
def scripts_of_texts(t: Tables):
    return t.documents.select("doc_id", keys.has_arabic(F.coalesce("text", F.lit(""))).alias("arabic"), F.substring(keys.squeezed(F.coalesce("lang", F.lit(""))), 1, 8).alias("lang_key"))


@query("I31,I32", """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name END AS parent, CASE WHEN p_size % 5 = 0 THEN 1.0 WHEN p_size <= 10 THEN 0.9 WHEN p_size <= 25 THEN 0.75 WHEN p_size <= 50 THEN 0.55 ELSE 0.3 END::DOUBLE AS factor FROM part""")
def parents_of_names(t: Tables):
    """The building that a venue's name points at, and how far its distance lowers the confidence."""
    name = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Cafe at the "), "p_name")).otherwise(F.col("p_name"))
    parent = F.nullif(F.regexp_extract(name, r"(?i)\b(?:at|in|inside)\s+(?:the\s+)?(.+)$", 1), F.lit(""))
    return t.part.select("p_partkey", parent.alias("parent"), geo.spatial_factor(F.col("p_size"), F.col("p_size") % 5 == 0).alias("factor"))


@query("K16", "SELECT DISTINCT p_partkey AS key, alias, kind FROM (SELECT p_partkey, p_name AS alias, 'registered' AS kind FROM part UNION ALL SELECT p_partkey, upper(p_name) || ' TOWER', 'sales' FROM part WHERE p_size >= 25)")
def alias_harvest(t: Tables):
    """Registered names, and the sales names of accepted links that differ from them."""
    registered = t.part.select(F.col("p_partkey").alias("key"), F.col("p_name").alias("alias"), F.lit("registered").alias("kind"))
    links = t.part.select(F.col("p_partkey").alias("key"), F.concat(F.upper("p_name"), F.lit(" TOWER")).alias("alias"), F.when(F.col("p_size") >= 25, "accepted").otherwise("review").alias("decision"), "p_name")
    sales = links.where((F.col("decision") == "accepted") & (keys.name_norm(F.col("p_name")) != F.col("alias"))).select("key", "alias", F.lit("sales").alias("kind"))
    return registered.unionByName(sales).distinct()


@query("K17", """WITH e AS (SELECT o_orderpriority AS label, c_nationkey AS area, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2), s AS (SELECT *, sum(n) OVER (PARTITION BY label) AS total FROM e)
    SELECT label, area AS top, CAST(total AS BIGINT) AS total, round(n / total, 3) AS share, area = ascii(label) % 25 AS agrees, area <> ascii(label) % 25 AND n / total >= 0.03 AND total >= 50 AS proposed FROM s QUALIFY row_number() OVER (PARTITION BY label ORDER BY n DESC, area) = 1""")
def alias_evidence(t: Tables):
    """For each label the area that most of its rows are linked to, and whether the alias file agrees."""
    e = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).groupBy(F.col("o_orderpriority").alias("label"), F.col("c_nationkey").alias("area")).agg(F.count("*").alias("n"))
    total = e.groupBy("label").agg(F.sum("n").alias("total"))
    top = rows.first_rows(e, ["label"], [F.col("n").desc(), F.col("area")]).join(total, "label")
    agrees, share = F.col("area") == F.ascii("label") % 25, F.col("n") / F.col("total")
    return top.select("label", F.col("area").alias("top"), "total", F.round(share, 3).alias("share"), agrees.alias("agrees"), (~agrees & (share >= 0.03) & (F.col("total") >= 50)).alias("proposed"))


_SCORES = "CASE WHEN p_size % 3 = 0 THEN 100 WHEN p_size % 3 = 1 THEN 92 ELSE 50 END"


@query("K25", f"""WITH e AS (SELECT p_brand AS entity, CASE p_partkey % 4 WHEN 0 THEN 'NAME' WHEN 1 THEN 'PROJECT' WHEN 2 THEN 'PLOT' ELSE 'TENANT' END AS role, CASE WHEN p_partkey % 2 = 0 THEN upper(p_type) ELSE p_type END AS value,
        CASE p_size % 3 WHEN 0 THEN 'unit' WHEN 1 THEN 'map' ELSE 'advert' END AS source, {_SCORES} AS score, p_partkey % 10 / 10.0 AS confidence FROM part),
    g AS (SELECT entity, role, regexp_replace(lower(value), '[^a-z0-9]', '', 'g') AS same, arg_max({{'v': value, 's': source}}, {{'a': score, 'b': confidence, 'c': value, 'd': source}}) AS top, max({{'a': score, 'b': confidence}}) AS best, list_sort(list(DISTINCT source)) AS sources
        FROM e WHERE role <> 'TENANT' GROUP BY 1, 2, 3),
    s AS (SELECT *, best.a + CASE WHEN len(sources) > 1 THEN 6 ELSE 0 END AS score FROM g)
    SELECT entity, role, top.v AS value, CASE WHEN top.s = 'unit' THEN 'VERIFIED' WHEN role = 'PLOT' THEN 'STRUCTURALLY_IDENTIFIED' WHEN top.s = 'map' THEN 'MATCHED' ELSE 'INFERRED' END AS grade, score, array_to_string(sources, ',') AS sources
    FROM s QUALIFY row_number() OVER (PARTITION BY entity ORDER BY list_position(['NAME', 'PROJECT', 'PLOT'], role), score DESC, best.b DESC, same) = 1""")
def role_resolver(t: Tables):
    """The name of each entity by its best role, with a bonus for sources that agree, and a grade."""
    k = F.col("p_partkey")
    e = t.part.select(
        F.col("p_brand").alias("entity"), F.element_at(F.array(*map(F.lit, ("NAME", "PROJECT", "PLOT", "TENANT"))), (k % 4 + 1).cast("int")).alias("role"), F.when(k % 2 == 0, F.upper("p_type")).otherwise(F.col("p_type")).alias("value"),
        F.element_at(F.array(F.lit("unit"), F.lit("map"), F.lit("advert")), (F.col("p_size") % 3 + 1).cast("int")).alias("source"), F.expr(_SCORES).alias("score"), (k % 10 / 10.0).alias("confidence"),
    )
    return linkage.resolved(e, ["unit"], ["map"], ["NAME", "PROJECT", "PLOT"], ["PLOT"])


@query("K32", """WITH g AS (SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, round(o_totalprice, 0) AS price, list_sort(list(DISTINCT o_orderpriority)) AS labels FROM orders GROUP BY 1, 2, 3)
    SELECT md5(concat_ws(chr(31), o_custkey, day, CAST(price AS BIGINT))) AS signature, array_to_string(labels, '|') AS labels, len(labels) > 1 AS ambiguous FROM g""")
def contract_signatures(t: Tables):
    """Contracts told apart by what they say and not by their label: the labels of one signature are listed."""
    price = F.round("o_totalprice", 0).cast("bigint").cast("string")
    signature = F.md5(F.concat_ws("\x1f", F.col("o_custkey").cast("string"), F.to_date("o_orderdate").cast("string"), price))
    labels = F.array_sort(F.collect_set("o_orderpriority"))
    g = t.orders.groupBy(signature.alias("signature")).agg(labels.alias("labels"))
    return g.select("signature", F.array_join("labels", "|").alias("labels"), (F.size("labels") > 1).alias("ambiguous"))


# places

_VERTICES = f"v(poly, v, lon, lat) AS (SELECT poly, v, CAST(lon AS DOUBLE), CAST(lat AS DOUBLE) FROM ({_HEX}) x(poly, v, lon, lat)), e AS (SELECT poly, lon AS x1, lat AS y1, coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS x2, coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS y2 FROM v WINDOW w AS (PARTITION BY poly ORDER BY v))"
_INSIDE = "i AS (SELECT a, poly FROM l, e WHERE (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY 1, 2 HAVING count(*) % 2 = 1)"


def _vertices(t: Tables):
    return t.spark.sql(f"SELECT poly, v, CAST(lon AS DOUBLE) AS lon, CAST(lat AS DOUBLE) AS lat FROM ({_HEX}) AS x(poly, v, lon, lat)")


@query("D19", f"""WITH {_LEFT}, {_RIGHT}, {_VERTICES}, {_INSIDE}, n AS (SELECT a, b, {_DIST} AS m FROM l, r WHERE a NOT IN (SELECT a FROM i))
    SELECT a AS p, poly AS place, 'polygon' AS method FROM i UNION ALL (SELECT a, b, 'centre' FROM n WHERE m <= 3000 QUALIFY row_number() OVER (PARTITION BY a ORDER BY m, b) = 1)""")
def nearest_unclaimed(t: Tables):
    points, centres = _both(t)
    return space.claimed(points.withColumnRenamed("a", "p"), _vertices(t), centres)


@query("I17", f"""WITH {_LEFT}, {_VERTICES}, {_INSIDE}, n AS (SELECT a, poly, min({_DIST.replace('r.', 'v.')}) AS m FROM l, v GROUP BY 1, 2)
    SELECT n.a AS p, n.poly, CASE WHEN i.a IS NULL THEN round(m, 1) ELSE 0.0 END AS metres FROM n LEFT JOIN i ON i.a = n.a AND i.poly = n.poly WHERE m <= 4000 OR i.a IS NOT NULL""")
def ring_distances(t: Tables):
    out = space.vertex_distance(_points(t.customer, "c_custkey", "p"), _vertices(t), 4000)
    return out.withColumn("metres", F.round("metres", 1))


@query("K63,K23", f"""WITH {_VERTICES}, c AS (SELECT poly, avg(lon) AS lon, avg(lat) AS lat FROM v GROUP BY 1), s AS (SELECT poly, abs(sum(x1 * y2 - x2 * y1)) / 2 AS deg FROM e GROUP BY 1)
    SELECT poly, round(lon, 6) AS lon, round(lat, 6) AS lat, round(deg * 111320.0 * 110574.0 * cos(radians(lat)) / 1e6, 3) AS square_km, 'P-' || left(sha1(printf('%.6f,%.6f', lon, lat)), 10) AS id FROM c JOIN s USING (poly)""")
def polygon_measures(t: Tables):
    m = space.ring_measures(_vertices(t))
    return m.select("poly", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), F.round(F.col("square_metres") / 1e6, 3).alias("square_km"), geo.centroid_id(F.lit("P"), F.col("lon"), F.col("lat")).alias("id"))


@query("I18", f"""WITH {_RIGHT}, d AS (SELECT b, (degrees(atan2((lon - 55.27) * 111320.0 * cos(radians(25.2)), (lat - 25.2) * 110574.0)) + 360) % 360 AS g FROM r), s AS (SELECT b, g, ['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'][CAST(floor((g + 22.5) / 45) AS INTEGER) % 8 + 1] AS sector FROM d),
    o AS (SELECT sector, g, CASE WHEN g - lag(g) OVER w <= 2 THEN 0 ELSE 1 END AS new FROM s WINDOW w AS (PARTITION BY sector ORDER BY g)) SELECT sector, count(*) AS n, CAST(sum(new) AS BIGINT) AS spans FROM o GROUP BY 1""")
def bearings(t: Tables):
    """Directions from the centre by sector; directions at most two degrees apart are one span."""
    g = geo.bearing(F.lit(55.27), F.lit(25.2), F.col("lon"), F.col("lat"))
    s = _points(t.supplier, "s_suppkey", "b").select(g.alias("g")).withColumn("sector", geo.sector(F.col("g")))
    new = F.when(F.col("g") - F.lag("g").over(Window.partitionBy("sector").orderBy("g")) <= 2, 0).otherwise(1)
    return s.withColumn("new", new).groupBy("sector").agg(F.count("*").alias("n"), F.sum("new").alias("spans"))


@query("E37", f"""WITH {_LEFT}, c AS (SELECT CAST(floor(lon / 0.05) AS BIGINT) AS x, CAST(floor(lat / 0.05) AS BIGINT) AS y, count(*) AS n FROM l GROUP BY 1, 2), k AS (SELECT dx, dy, 1.0 / pow(2, abs(dx) + abs(dy)) AS w FROM (VALUES (-1), (0), (1)) a(dx), (VALUES (-1), (0), (1)) b(dy))
    SELECT x + dx AS cx, y + dy AS cy, sum(n * w) AS density FROM c, k GROUP BY 1, 2""")
def point_density(t: Tables):
    return space.density(_points(t.customer, "c_custkey", "a"), 0.05)


@query("K60", f"""WITH {_LEFT}, {_RIGHT}, n AS (SELECT a, min({_DIST}) AS m FROM l, r GROUP BY 1) SELECT a, CASE WHEN m <= 500 THEN 'plausible' WHEN m <= 2000 THEN 'check' ELSE 'implausible' END AS verdict FROM n""")
def amenity_plausibility(t: Tables):
    """Points that claim an amenity, judged by how far the nearest one is."""
    points, centres = _both(t)
    near = space.nearest(points, centres, 2000).select("a", "metres")
    return points.select("a").join(near, "a", "left").select("a", F.when(F.col("metres") <= 500, "plausible").when(F.col("metres") <= 2000, "check").otherwise("implausible").alias("verdict"))


@query("C17", "SELECT s_suppkey, CASE WHEN s_suppkey % 50 = 0 THEN NULL ELSE round(25 + (s_suppkey * 91 % 1000) / 2000.0, 4) END AS lat, CASE WHEN s_suppkey % 50 = 0 THEN NULL ELSE round(55 + (s_suppkey * 37 % 1000) / 1000.0, 4) END AS lon FROM supplier")
def swapped_axes(t: Tables):
    """Coordinates of which some are swapped and some are nonsense: put right where the ranges tell, else null."""
    p = _points(t.supplier, "s_suppkey", "s_suppkey")
    k, north, east = F.col("s_suppkey"), lambda x: x.between(24.6, 25.5), lambda x: x.between(54.8, 56.0)
    said = p.select(k, F.when(k % 50 == 0, 0.0).when(k % 3 == 0, F.col("lon")).otherwise(F.col("lat")).alias("a"), F.when(k % 3 == 0, F.col("lat")).otherwise(F.col("lon")).alias("b"))
    swap = east(F.col("a")) & north(F.col("b"))
    put = said.select(k, F.when(swap, F.col("b")).otherwise(F.col("a")).alias("lat"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("lon"))
    good = north(F.col("lat")) & east(F.col("lon"))
    return put.select(k, F.when(good, F.round("lat", 4)).alias("lat"), F.when(good, F.round("lon", 4)).alias("lon"))


# names of every kind by the rest of the key; the source by the size; the category that stands beside two of them
_NAMED = """CASE p_partkey % 13 WHEN 0 THEN 'Block ' || p_size WHEN 1 THEN 'Parcel 77/' || p_size WHEN 2 THEN p_size || ' Harbour Street' WHEN 3 THEN 'Prof. ' || p_brand WHEN 4 THEN 'Quince House reception'
    WHEN 5 THEN 'Olive Tree Diner at Quince House' WHEN 6 THEN 'Swift Laundry' WHEN 7 THEN 'Saffron Residences' WHEN 8 THEN 'The Company Ltd' WHEN 9 THEN 'Lovely 2 bhk, sea view' WHEN 10 THEN 'Cedar' WHEN 11 THEN 'North Tram Depot' ELSE 'Amber Gardens' END"""
_CATEGORY = "CASE p_partkey % 13 WHEN 10 THEN 'office_building' WHEN 12 THEN 'public_parking' END"
_EXPECTED = """CASE p_partkey % 13 WHEN 0 THEN 'STRUCTURAL_ID' WHEN 1 THEN 'PLOT_ID' WHEN 2 THEN 'ADDRESS' WHEN 3 THEN 'PERSON' WHEN 8 THEN 'FRAGMENT' WHEN 9 THEN 'ADVERTISEMENT'
    ELSE CASE WHEN p_size % 3 = 0 THEN 'BUILDING_NAME' WHEN p_size % 3 = 1 THEN 'PROJECT_NAME' ELSE CASE p_partkey % 13 WHEN 4 THEN 'AMENITY' WHEN 5 THEN 'VENUE' WHEN 6 THEN 'TENANT' WHEN 7 THEN 'BUILDING_NAME' WHEN 10 THEN 'BUILDING_NAME' WHEN 11 THEN 'INFRASTRUCTURE' ELSE 'AMENITY' END END END"""


@query("I30", f"SELECT p_partkey, role, role IN ('BUILDING_NAME', 'STRUCTURAL_ID', 'PROJECT_NAME', 'PLOT_ID', 'ADDRESS') AS eligible FROM (SELECT p_partkey, {_EXPECTED} AS role FROM part)")
def roles_of_names(t: Tables):
    """Names of every kind, from a source of outlines, of projects or of points, with a category or without."""
    source = F.when(F.col("p_size") % 3 == 0, "osm").when(F.col("p_size") % 3 == 1, "projects").otherwise("places")
    named = t.part.select("p_partkey", F.expr(_NAMED).alias("name"), source.alias("source"), F.expr(_CATEGORY).alias("category"))
    role = roles.role_of(F.col("name"), F.col("source"), F.col("category"))
    return named.select("p_partkey", role.alias("role"), roles.eligible(role).alias("eligible"))


@query("I31", """WITH names AS (SELECT p_partkey, p_size % 3 AS k, p_name FROM part), known AS (SELECT DISTINCT p_name AS n FROM part WHERE p_size % 2 = 0),
    said AS (SELECT p_partkey, CASE k WHEN 0 THEN 'Olive Diner at ' || p_name WHEN 1 THEN p_name ELSE upper(p_name) || ' - Car Park' END AS s FROM names),
    w AS (SELECT p_partkey, s, list_filter(string_split(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM said),
    runs AS (SELECT p_partkey, len(w) AS all_, i, unnest(range(1, len(w) - i + 2)) AS k, w FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM w)),
    held AS (SELECT p_partkey, n, k FROM runs JOIN known ON array_to_string(w[i : i + k - 1], ' ') = lower(n) WHERE k < all_)
    SELECT p.p_partkey, h.n AS parent FROM part p LEFT JOIN (SELECT * FROM held QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY k DESC, length(n) DESC, n) = 1) h ON h.p_partkey = p.p_partkey""")
def parent_names(t: Tables):
    """The registered name (of parts of even size) that stands inside a venue's or a facility's name."""
    k = F.col("p_size") % 3
    said = F.when(k == 0, F.concat(F.lit("Olive Diner at "), "p_name")).when(k == 1, F.col("p_name")).otherwise(F.concat(F.upper("p_name"), F.lit(" - Car Park")))
    return roles.parents(t.part.select(F.col("p_partkey").alias("a"), said.alias("name")), t.part.where("p_size % 2 = 0").select(F.col("p_name").alias("name"))).toDF("p_partkey", "parent")
