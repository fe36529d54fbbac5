"""Market statistics, geography, linkage and text."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geo, keys
from ..operators import linkage, rows, space, stats
from ..sources import lake
from .registry import Tables, query


@query("C05,E01,E05,E10,C11", """SELECT l_returnflag AS area, count(*) AS sales, round(sum(l_extendedprice), 2) AS value, round(median(l_extendedprice / l_quantity), 2) AS median_unit, min(strftime(o_orderdate, '%G-W%V')) AS first_week
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity BETWEEN 1 AND 45 AND l_linestatus = 'O' GROUP BY 1 HAVING count(*) >= 20""")
def pulse_headline(t: Tables):
    """Flagship: gated sales with their week, per area with at least twenty."""
    good = t.lineitem.where(F.col("l_quantity").between(1, 45) & (F.col("l_linestatus") == "O")).join(t.orders.select("o_orderkey", "o_orderdate"), F.col("o_orderkey") == F.col("l_orderkey"))
    return good.groupBy(F.col("l_returnflag").alias("area")).agg(F.count("*").alias("sales"), F.round(F.sum("l_extendedprice"), 2).alias("value"), F.round(F.median(F.col("l_extendedprice") / F.col("l_quantity")), 2).alias("median_unit"), F.min(keys.iso_week(F.col("o_orderdate"))).alias("first_week")).where("sales >= 20")


@query("K36,C10", """WITH s AS (SELECT l_suppkey % 25 AS area, median(l_extendedprice / l_quantity) AS sale, count(*) AS n FROM lineitem GROUP BY 1), r AS (SELECT o_custkey % 25 AS area, median(o_totalprice) / 1000 AS rent, count(*) AS m FROM orders GROUP BY 1),
    y AS (SELECT area, n, m, round(rent / sale * 100, 2) AS yield FROM s JOIN r USING (area)) SELECT area, yield, CASE WHEN n < 30 OR m < 30 THEN 'thin' WHEN yield NOT BETWEEN 1.5 AND 12 THEN 'implausible' END AS excluded FROM y""")
def gross_yield(t: Tables):
    s = t.lineitem.groupBy((F.col("l_suppkey") % 25).alias("area")).agg(F.median(F.col("l_extendedprice") / F.col("l_quantity")).alias("sale"), F.count("*").alias("n"))
    r = t.orders.groupBy((F.col("o_custkey") % 25).alias("area")).agg((F.median("o_totalprice") / 1000).alias("rent"), F.count("*").alias("m"))
    y = s.join(r, "area").withColumn("yield", F.round(F.col("rent") / F.col("sale") * 100, 2))
    return y.select("area", "yield", F.when((F.col("n") < 30) | (F.col("m") < 30), "thin").when(~F.col("yield").between(1.5, 12), "implausible").alias("excluded"))


@query("K44,K43,F08", """SELECT n_regionkey, c_mktsegment, n, round(n / total, 4) AS share FROM (SELECT n_regionkey, c_mktsegment, count(*) AS n, sum(count(*)) OVER (PARTITION BY n_regionkey) AS total FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2) WHERE n / total >= 0.15""")
def market_names(t: Tables):
    n = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey", "c_mktsegment").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("n_regionkey"))
    return n.withColumn("s", share).where("s >= 0.15").select("n_regionkey", "c_mktsegment", "n", F.round("s", 4).alias("share"))


@query("K37", """SELECT l_suppkey, year(l_shipdate) AS y, round(sum(l_tax * l_extendedprice), 2) AS charge FROM lineitem GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY y DESC) = 1""")
def latest_charge(t: Tables):
    c = t.lineitem.groupBy("l_suppkey", F.year("l_shipdate").alias("y")).agg(F.round(F.sum(F.col("l_tax") * F.col("l_extendedprice")), 2).alias("charge"))
    return rows.first_rows(c, ["l_suppkey"], [F.col("y").desc()])


@query("K38", "SELECT p_partkey, p_size * 10 AS launched, CAST(coalesce(sold, 0) AS BIGINT) AS sold, CAST(greatest(p_size * 10 - coalesce(sold, 0), 0) AS BIGINT) AS remaining FROM part LEFT JOIN (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS sold FROM lineitem GROUP BY 1) ON l_partkey = p_partkey")
def remaining_inventory(t: Tables):
    sold = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").cast("bigint").alias("sold"))
    s = F.coalesce("sold", F.lit(0))
    return t.part.join(sold, F.col("l_partkey") == F.col("p_partkey"), "left").select("p_partkey", (F.col("p_size") * 10).alias("launched"), s.alias("sold"), F.greatest(F.col("p_size") * 10 - s, F.lit(0)).alias("remaining"))


@query("C09,K47", """WITH m AS (SELECT p_brand, median(p_retailprice) AS med FROM part GROUP BY 1) SELECT p_brand, p_partkey, p_retailprice FROM part JOIN m USING (p_brand) WHERE p_retailprice BETWEEN 0.85 * med AND 1.15 * med QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey DESC) <= 6""")
def plausible_latest(t: Tables):
    m = t.part.groupBy("p_brand").agg(F.median("p_retailprice").alias("med"))
    near = t.part.join(m, "p_brand").where(F.col("p_retailprice").between(0.85 * F.col("med"), 1.15 * F.col("med"))).select("p_brand", "p_partkey", "p_retailprice")
    return rows.first_rows(near, ["p_brand"], [F.col("p_partkey").desc()], 6)


@query("E27,E28", """WITH s AS (SELECT l_suppkey, count(*) AS n, avg(CASE WHEN l_shipdate <= o_orderdate + INTERVAL 60 DAY THEN 1.0 ELSE 0 END) AS on_time FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1 HAVING count(*) >= 20)
    SELECT l_suppkey, n, round(on_time, 4) AS on_time, rank() OVER (ORDER BY round(on_time, 4) DESC, n DESC, l_suppkey) AS place FROM s""")
def delivery_score(t: Tables):
    on_time = F.avg(F.when(F.col("l_shipdate") <= F.col("o_orderdate") + F.expr("INTERVAL 60 DAY"), 1.0).otherwise(0.0))
    s = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("l_suppkey").agg(F.count("*").alias("n"), F.round(on_time, 4).alias("on_time")).where("n >= 20")
    placed = rows.numbered(s, [F.col("on_time").desc(), F.col("n").desc(), F.col("l_suppkey")], "place", lake.shared_dir(t.spark))
    return placed.withColumn("place", F.col("place").cast("long"))


# geography: points made from keys
_PT = "55 + ({k} * 37 % 1000) / 1000.0 AS lon, 25 + ({k} * 91 % 1000) / 2000.0 AS lat"
_LEFT, _RIGHT = f"l AS (SELECT c_custkey AS a, {_PT.format(k='c_custkey')} FROM customer)", f"r AS (SELECT s_suppkey AS b, {_PT.format(k='s_suppkey')} FROM supplier)"
_DIST = "sqrt(power((l.lon - r.lon) * 111320.0 * cos(radians(l.lat)), 2) + power((l.lat - r.lat) * 110574.0, 2))"


def _points(df, key: str, name: str):
    k = F.col(key)
    return df.select(k.alias(name), (55 + (k * 37 % 1000) / 1000.0).alias("lon"), (25 + (k * 91 % 1000) / 2000.0).alias("lat"))


def _both(t: Tables):
    return _points(t.customer, "c_custkey", "a"), _points(t.supplier, "s_suppkey", "b")


@query("D12,D14,D15,I16,K56", f"WITH {_LEFT}, {_RIGHT}, d AS (SELECT a, b, {_DIST} AS m FROM l, r) SELECT a, b, round(m, 1) AS metres FROM d WHERE m <= 3000 QUALIFY row_number() OVER (PARTITION BY a ORDER BY m, b) = 1")
def nearest_within(t: Tables):
    return space.nearest(*_both(t), 3000).withColumn("metres", F.round("metres", 1))


@query("D13,D16", f"WITH {_LEFT}, {_RIGHT} SELECT a, count(*) AS n FROM l, r WHERE {_DIST} <= 5000 GROUP BY 1")
def radius_counts(t: Tables):
    return space.within(*_both(t), 5000).groupBy("a").agg(F.count("*").alias("n"))


@query("D21,K48", f"WITH {_LEFT}, {_RIGHT} SELECT a FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE {_DIST} <= 4000)")
def no_neighbour(t: Tables):
    left, right = _both(t)
    return space.without_neighbour(left, right, 4000).select("a")


_HEX = "VALUES " + ", ".join(f"({p}, {v}, {55.2 + p * 0.25 + dx}, {25.15 + (p % 2) * 0.15 + dy})" for p in range(3) for v, (dx, dy) in enumerate([(0.1, 0.0), (0.05, 0.09), (-0.05, 0.09), (-0.1, 0.0), (-0.05, -0.09), (0.05, -0.09)]))


@query("D17,D18,F07", f"""WITH {_LEFT}, v(poly, v, lon, lat) AS (SELECT poly, v, CAST(lon AS DOUBLE), CAST(lat AS DOUBLE) FROM ({_HEX}) x(poly, v, lon, lat)), e AS (SELECT poly, lon AS x1, lat AS y1, coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS x2, coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS y2 FROM v WINDOW w AS (PARTITION BY poly ORDER BY v))
    SELECT a AS p, poly FROM l, e WHERE (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY 1, 2 HAVING count(*) % 2 = 1""")
def points_in_polygons(t: Tables):
    vertices = t.spark.sql(f"SELECT poly, v, CAST(lon AS DOUBLE) AS lon, CAST(lat AS DOUBLE) AS lat FROM ({_HEX}) AS x(poly, v, lon, lat)")
    return space.in_polygon(_points(t.customer, "c_custkey", "p"), vertices)


@query("I15,I16", f"WITH {_RIGHT} SELECT b, round(2 * 6371000 * asin(sqrt(least(1.0, power(sin(radians(25.2 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(25.2)) * power(sin(radians(55.27 - lon) / 2), 2)))), 0) AS metres FROM r")
def haversine_distances(t: Tables):
    return _points(t.supplier, "s_suppkey", "b").select("b", F.round(geo.haversine(F.col("lon"), F.col("lat"), F.lit(55.27), F.lit(25.2)), 0).alias("metres"))


# text and linkage
@query("I01,I04,I06,I07", "SELECT c_custkey, nullif(trim(regexp_replace(upper(c_name), '[^A-Z0-9]+', ' ', 'g')), '') AS name, array_to_string(regexp_extract_all(c_name, '(\\d+)', 1), ' ') AS digits, TRY_CAST(array_to_string(regexp_extract_all(c_name, '(\\d+)', 1), '') AS BIGINT) AS number FROM customer")
def names_and_keys(t: Tables):
    return t.customer.select("c_custkey", keys.name_norm(F.col("c_name")).alias("name"), keys.digit_runs(F.col("c_name")).alias("digits"), keys.number_key(F.replace(keys.digit_runs(F.col("c_name")), F.lit(" "), F.lit(""))).alias("number"))


@query("I10,K07", "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS d, CAST(o_orderkey AS VARCHAR) AS n FROM orders")
def canonical_values(t: Tables):
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    as_text = F.when(F.col("o_orderkey") % 3 == 0, F.concat(d, F.lit("T00:00:00.000Z"))).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "dd-MM-yyyy")).otherwise(F.concat(d, F.lit(" 00:00:00")))
    return t.orders.select("o_orderkey", keys.canonical_text(as_text).alias("d"), keys.canonical_text(F.concat(F.col("o_orderkey").cast("string"), F.lit(".00"))).alias("n"))


@query("I26,D31,K15", """WITH p AS (SELECT p_partkey AS k, p_name AS n, split_part(p_name, ' ', 1) AS block FROM part), s AS (SELECT a.k AS a, b.k AS b, jaro_winkler_similarity(a.n, b.n) AS j FROM p a JOIN p b ON a.block = b.block AND a.k <> b.k)
    SELECT a, b, round(j, 6) AS score FROM s WHERE j >= 0.8 QUALIFY row_number() OVER (PARTITION BY a ORDER BY round(j, 9) DESC, b) = 1""")
def best_name_match(t: Tables):
    """The best match of every part among those whose names begin with the same word."""
    p = t.part.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("n"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("block"))
    return linkage.best_names(p).withColumn("score", F.round("score", 6))


@query("I27,K20", "SELECT a.n_nationkey AS a, b.n_nationkey AS b FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey AND levenshtein(a.n_name, b.n_name) <= 2")
def near_names(t: Tables):
    names = t.nation.select("n_nationkey", "n_name")
    return linkage.within_edits(names.toDF("a", "x"), names.toDF("b", "y"), 2).where("a < b")


@query("K13", """WITH l AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 4 = 0 THEN p_name || ' x' ELSE p_name END AS n, p_size % 5 AS area FROM part), r AS (SELECT p_name AS n, min(p_partkey) AS k2, min(p_size % 5) AS area2, count(*) AS c FROM part GROUP BY 1)
    SELECT k, CASE WHEN c = 1 THEN k2 END AS match, CASE WHEN c = 1 AND area = area2 THEN 1.0 WHEN c = 1 THEN 0.97 WHEN c > 1 THEN 0.6 END::DOUBLE AS score, CASE WHEN c = 1 THEN 'accepted' WHEN c > 1 THEN 'review' ELSE 'unmatched' END AS status FROM l LEFT JOIN r USING (n)""")
def linkage_cascade(t: Tables):
    l = t.part.select(F.col("p_partkey").alias("k"), F.when(F.col("p_partkey") % 4 == 0, F.concat("p_name", F.lit(" x"))).otherwise(F.col("p_name")).alias("n"), (F.col("p_size") % 5).alias("area"))
    r = t.part.groupBy(F.col("p_name").alias("n")).agg(F.min("p_partkey").alias("k2"), F.min(F.col("p_size") % 5).alias("area2"), F.count("*").alias("c"))
    j = l.join(r, "n", "left")
    return j.select("k", F.when(F.col("c") == 1, F.col("k2")).alias("match"), F.when((F.col("c") == 1) & (F.col("area") == F.col("area2")), 1.0).when(F.col("c") == 1, 0.97).when(F.col("c") > 1, 0.6).alias("score"), F.when(F.col("c") == 1, "accepted").when(F.col("c") > 1, "review").otherwise("unmatched").alias("status"))


@query("F17,K24", """WITH e AS (SELECT p_brand AS entity, p_type AS v, p_size % 3 AS src, p_retailprice / 10000 AS conf, p_partkey AS id FROM part), a(src, weight) AS (VALUES (0, 10), (1, 30), (2, 20))
    SELECT entity, v, weight FROM e JOIN a USING (src) QUALIFY row_number() OVER (PARTITION BY entity ORDER BY weight DESC, conf DESC, id) = 1""")
def authority_winner(t: Tables):
    authority = t.spark.createDataFrame([(0, 10), (1, 30), (2, 20)], "src int, weight int")
    e = t.part.select(F.col("p_brand").alias("entity"), F.col("p_type").alias("v"), (F.col("p_size") % 3).alias("src"), (F.col("p_retailprice") / 10000).alias("conf"), F.col("p_partkey").alias("id"))
    return rows.first_rows(e.join(F.broadcast(authority), "src"), ["entity"], [F.col("weight").desc(), F.col("conf").desc(), F.col("id")]).select("entity", "v", "weight")


@query("K28,D25", """WITH v AS (SELECT 'customer' AS t, c_nationkey AS k FROM customer UNION SELECT 'supplier', s_nationkey FROM supplier UNION SELECT 'nation', n_nationkey FROM nation UNION SELECT 'region', r_regionkey FROM region), n AS (SELECT t, count(*) AS n FROM v GROUP BY 1)
    SELECT a.t AS a, b.t AS b, count(*) AS shared FROM v a JOIN v b ON a.k = b.k AND a.t < b.t JOIN n x ON x.t = a.t JOIN n y ON y.t = b.t GROUP BY 1, 2, x.n, y.n HAVING count(*) >= 3 AND count(*) >= 0.5 * least(x.n, y.n)""")
def shared_code_lists(t: Tables):
    v = t.customer.select(F.lit("customer").alias("t"), F.col("c_nationkey").alias("k")).union(t.supplier.select(F.lit("supplier"), "s_nationkey")).union(t.nation.select(F.lit("nation"), "n_nationkey")).union(t.region.select(F.lit("region"), "r_regionkey")).distinct()
    n = v.groupBy("t").agg(F.count("*").alias("n"))
    pairs = v.toDF("a", "k").join(v.toDF("b", "k"), "k").where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    return pairs.join(n.toDF("a", "an"), "a").join(n.toDF("b", "bn"), "b").where("shared >= 3 and shared >= 0.5 * least(an, bn)").select("a", "b", "shared")


@query("A20,I07", "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, CAST(len(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS BIGINT) AS links FROM pages")
def html_title_and_links(t: Tables):
    return t.pages.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.size(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).cast("bigint").alias("links"))


@query("A06,I23", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY 1")
def json_properties(t: Tables):
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("k"))


@query("I34", "SELECT l_returnflag, round(avg(l_quantity), 2) AS half_up, round_even(avg(l_discount), 3) AS half_even, CAST(floor(avg(l_extendedprice) + 0.5) AS BIGINT) AS whole FROM lineitem GROUP BY 1")
def roundings(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.avg("l_quantity"), 2).alias("half_up"), F.bround(F.avg("l_discount"), 3).alias("half_even"), F.floor(F.avg("l_extendedprice") + 0.5).cast("bigint").alias("whole"))


@query("C17,C18,C19", "SELECT s_suppkey, CASE WHEN s_acctbal BETWEEN 0 AND 5000 THEN s_acctbal END AS clamped, nullif(s_nationkey, 0) AS nation FROM supplier")
def sentinels(t: Tables):
    return t.supplier.select("s_suppkey", F.when(F.col("s_acctbal").between(0, 5000), F.col("s_acctbal")).alias("clamped"), F.nullif("s_nationkey", F.lit(0)).alias("nation"))


@query("C20", "SELECT doc_id, regexp_matches(coalesce(text, ''), '[^\\s@]+@[^\\s@]+\\.[a-z]+') AS has_mail FROM documents")
def personal_data_guard(t: Tables):
    return t.documents.select("doc_id", F.coalesce("text", F.lit("")).rlike(r"[^\s@]+@[^\s@]+\.[a-z]+").alias("has_mail"))


@query("K53", """SELECT role, count(*) AS asked, count(DISTINCT conv_id) AS conversations, max(length(coalesce(text, ''))) AS longest FROM conversations GROUP BY 1""")
def question_counts(t: Tables):
    return t.conversations.groupBy("role").agg(F.count("*").alias("asked"), F.countDistinct("conv_id").alias("conversations"), F.max(F.length(F.coalesce("text", F.lit("")))).cast("bigint").alias("longest"))


@query("K59", """WITH c AS (SELECT p.p_partkey AS k, q.p_name AS target, length(q.p_name) AS n FROM part p JOIN part q ON starts_with(p.p_name || ' tower', q.p_name) AND split_part(q.p_name, ' ', 1) = split_part(p.p_name, ' ', 1))
    SELECT k, arg_max(target, {'n': n, 't': target}) AS target FROM c GROUP BY 1""")
def longest_prefix(t: Tables):
    token = F.split_part("p_name", F.lit(" "), F.lit(1))
    p, q = t.part.select(F.col("p_partkey").alias("k"), F.concat("p_name", F.lit(" tower")).alias("q"), token.alias("w")), t.part.select(F.col("p_name").alias("target"), token.alias("w")).distinct()
    return p.join(q, "w").where(F.startswith("q", F.col("target"))).groupBy("k").agg(F.max_by("target", F.struct(F.length("target"), "target")).alias("target"))


@query("F08", """WITH g AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2) SELECT p_brand, p_type AS top, round(n / sum(n) OVER (PARTITION BY p_brand), 4) AS share FROM g QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) = 1""")
def weighted_alias(t: Tables):
    top = stats.mode_of(t.part, ["p_brand"], "p_type")
    total = t.part.groupBy("p_brand").agg(F.count("*").alias("total"))
    return top.join(total, "p_brand").select("p_brand", F.col("p_type").alias("top"), F.round(F.col("n") / F.col("total"), 4).alias("share"))


@query("K22,I11", "SELECT s_suppkey, left(sha1(s_name || '|' || s_nationkey), 12) AS id FROM supplier")
def stable_ids(t: Tables):
    return t.supplier.select("s_suppkey", F.substring(F.sha1(F.concat("s_name", F.lit("|"), F.col("s_nationkey").cast("string"))), 1, 12).alias("id"))


_ROLE = [("[0-9]{3}", "number"), ("[|]", "table"), ("[#$%&*]{3}", "marks"), ("[A-Z]{6}", "capitals")]


@query("I30", "SELECT doc_id, CASE " + " ".join(f"WHEN regexp_matches(coalesce(text, ''), '{p}') THEN '{r}'" for p, r in _ROLE) + " ELSE 'prose' END AS role FROM documents")
def name_roles(t: Tables):
    """The role of each whole text by the first pattern that it holds."""
    text, role = F.coalesce("text", F.lit("")), F.lit("prose")
    for pattern, name in reversed(_ROLE):
        role = F.when(text.rlike(pattern), name).otherwise(role)
    return t.documents.select("doc_id", role.alias("role"))
