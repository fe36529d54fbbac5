"""Further joins, parsers, contracts and domain reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import keys
from ..operators import linkage, rows
from .registry import Tables, query, same_sql

same_sql("small_dimension_join", "D36,O15", "SELECT o_orderkey, n_name, r_name FROM {orders} JOIN {customer} ON c_custkey = o_custkey JOIN {nation} ON n_nationkey = c_nationkey JOIN {region} ON r_regionkey = n_regionkey WHERE o_totalprice > 300000", "orders", "customer", "nation", "region")
same_sql("named_key_routes", "D32,K65", """
    SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_linenumber = 1 THEN l_partkey END, CASE WHEN s_nationkey < 10 THEN s_nationkey END, o_custkey) AS key,
           CASE WHEN l_linenumber = 1 THEN 'part' WHEN s_nationkey < 10 THEN 'nation' ELSE 'customer' END AS route
    FROM {lineitem} LEFT JOIN {supplier} ON s_suppkey = l_suppkey LEFT JOIN {orders} ON o_orderkey = l_orderkey""", "lineitem", "supplier", "orders")
same_sql("two_grains_reconciled", "E34", """
    SELECT (SELECT count(*) FROM {lineitem}) AS source, CAST((SELECT sum(n) FROM (SELECT count(*) AS n FROM {lineitem} GROUP BY l_returnflag, l_linestatus) x) AS BIGINT) AS fine, CAST((SELECT sum(n) FROM (SELECT count(*) AS n FROM {lineitem} GROUP BY l_suppkey) y) AS BIGINT) AS coarse""", "lineitem")
same_sql("first_over_key", "F14", "SELECT DISTINCT o_custkey, min(o_orderpriority) OVER (PARTITION BY o_custkey) AS priority FROM {orders}", "orders")
same_sql("date_parts", "I12,I35", """
    SELECT o_orderkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q, month(o_orderdate) AS m, day(o_orderdate) AS d, dayofyear(o_orderdate) AS doy, (year(o_orderdate) * 12 + month(o_orderdate)) - (1992 * 12 + 1) AS months FROM {orders}""", "orders")
same_sql("room_bands", "I24", """
    SELECT p_partkey, CASE WHEN p_size <= 1 THEN 'studio' WHEN p_size <= 10 THEN '1-bed' WHEN p_size <= 20 THEN '2-bed' WHEN p_size <= 30 THEN '3-bed' ELSE '4-plus' END AS beds FROM {part}""", "part")
same_sql("partial_first_day", "J04,J20", """
    SELECT event_type, count(*) AS judged FROM {events} CROSS JOIN (SELECT min(ts) AS t0 FROM {events}) f WHERE ts >= t0 + INTERVAL 1 DAY GROUP BY event_type""", "events")
same_sql("contract_status", "E03", """
    SELECT event_type, loaded, in_table, CASE WHEN loaded = in_table THEN 'ok' WHEN in_table < loaded AND distinct_ids = in_table THEN 'ok-deduplicated' ELSE 'held' END AS status
    FROM (SELECT event_type, count(*) AS loaded, count(DISTINCT user_id) AS in_table, count(DISTINCT user_id) AS distinct_ids FROM {events} GROUP BY event_type) x""", "events")
same_sql("join_rate_contract", "K08,K11", """
    SELECT matched, total, round(matched / total, 6) AS rate, matched < 0.8 * total AS held FROM (SELECT count(*) AS total, count(l_orderkey) AS matched FROM {orders} LEFT JOIN (SELECT DISTINCT l_orderkey FROM {lineitem} WHERE l_returnflag = 'R') x ON l_orderkey = o_orderkey) y""", "orders", "lineitem")
same_sql("id_churn", "K09", """
    SELECT count(*) AS published, count(*) FILTER (WHERE now.k IS NULL) AS vanished, count(*) FILTER (WHERE now.k IS NULL) > 0.01 * count(*) AS held
    FROM (SELECT p_partkey AS k FROM {part}) before LEFT JOIN (SELECT DISTINCT l_partkey AS k FROM {lineitem} WHERE l_quantity > 5) now ON now.k = before.k""", "part", "lineitem")
same_sql("golden_rules", "K12", """
    SELECT 'R1 keys unique' AS rule, count(*) = count(DISTINCT o_orderkey) AS pass FROM {orders} UNION ALL SELECT 'R2 lines have orders', count(*) = 0 FROM {lineitem} WHERE l_orderkey NOT IN (SELECT o_orderkey FROM {orders})
    UNION ALL SELECT 'R3 prices positive', min(o_totalprice) > 0 FROM {orders} UNION ALL SELECT 'R4 regions known', count(*) = 0 FROM {nation} WHERE n_regionkey NOT IN (SELECT r_regionkey FROM {region})""", "orders", "lineitem", "nation", "region")
same_sql("evidence_supersede", "K26", """
    SELECT p_partkey, CASE WHEN l_partkey IS NULL THEN 'superseded' ELSE 'asserted' END AS status FROM {part} LEFT JOIN (SELECT DISTINCT l_partkey FROM {lineitem} WHERE l_returnflag = 'R') x ON l_partkey = p_partkey""", "part", "lineitem")
same_sql("month_coarsening", "I12", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) = CAST(o_orderdate AS DATE) AS first_day, count(*) AS n FROM {orders} GROUP BY 1", "orders")
same_sql("status_rule", "K39", """
    SELECT o_orderkey, CASE WHEN open_lines = 0 THEN 'finished' WHEN done > 0 THEN 'under way' ELSE 'planned' END AS stage FROM {orders} JOIN
    (SELECT l_orderkey, count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines, count(*) FILTER (WHERE l_linestatus = 'F') AS done FROM {lineitem} GROUP BY 1) x ON l_orderkey = o_orderkey""", "orders", "lineitem")
same_sql("permit_rollup", "K40", """
    SELECT l_partkey, count(*) AS permits, CAST(max(l_orderkey) AS BIGINT) AS latest, count(*) FILTER (WHERE l_returnflag = 'N') AS new_buildings FROM {lineitem} GROUP BY l_partkey HAVING count(*) FILTER (WHERE l_returnflag = 'N') > 0""", "lineitem")
same_sql("daily_activity", "K49", """
    SELECT dayofyear(ts) AS day, event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM {events} GROUP BY 1, 2""", "events")
same_sql("live_launches", "K58", "SELECT s_suppkey, s_name, n_name FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey WHERE s_acctbal > 0 AND n_regionkey IN (1, 3)", "supplier", "nation")
same_sql("estimate_fill", "K68", """
    SELECT p_partkey, coalesce(CASE WHEN p_partkey % 3 = 0 THEN p_retailprice END, round(p_size * rate, 2)) AS estimate, CASE WHEN p_partkey % 3 = 0 THEN 'own' ELSE 'brand rate' END AS tier
    FROM {part} p JOIN (SELECT p_brand AS b, sum(p_retailprice) / sum(p_size) AS rate FROM {part} GROUP BY 1) r ON r.b = p.p_brand""", "part")
same_sql("column_search", "I08", "SELECT DISTINCT substr(p_type, 1, 5) AS head, length(p_type) AS n FROM {part} WHERE p_type IS NOT NULL", "part")
same_sql("comparison_cube", "K46,E31", """
    SELECT p_brand, coalesce(band, 'all') AS band, count(*) AS n FROM (SELECT p_brand, CASE WHEN p_retailprice < 1200 THEN 'low' ELSE 'high' END AS band FROM {part}) x GROUP BY GROUPING SETS ((p_brand, band), (p_brand))""", "part")
same_sql("cluster_supply", "K31", """
    SELECT l_suppkey, count(DISTINCT l_partkey) AS units, count(*) AS adverts, round(count(*) / count(DISTINCT l_partkey), 4) AS per_unit, round(median(l_extendedprice), 2) AS price FROM {lineitem} GROUP BY l_suppkey""", "lineitem")


_SPINE = """
    SELECT r_regionkey, count(DISTINCT n_nationkey) AS areas, count(DISTINCT c_custkey) AS parcels, count(DISTINCT s_suppkey) AS buildings FROM {region} LEFT JOIN {nation} ON n_regionkey = r_regionkey LEFT JOIN {customer} ON c_nationkey = n_nationkey LEFT JOIN {supplier} ON s_nationkey = n_nationkey GROUP BY r_regionkey"""


@query("K42", _SPINE.format(region="region", nation="nation", customer="customer", supplier="supplier"))
def place_spine(t: Tables):
    """Each level is counted by itself: joined in one, the customers and suppliers of a nation would be paired."""
    areas = t.region.join(t.nation, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("r_regionkey", "n_nationkey")

    def counted(df, key: str, name: str):
        return df.groupBy("r_regionkey").agg(F.countDistinct(key).alias(name)).withColumnRenamed("r_regionkey", f"r_{name}")

    parcels = counted(areas.join(t.customer, F.col("c_nationkey") == F.col("n_nationkey"), "left"), "c_custkey", "parcels")
    buildings = counted(areas.join(t.supplier, F.col("s_nationkey") == F.col("n_nationkey"), "left"), "s_suppkey", "buildings")
    out = counted(areas, "n_nationkey", "areas")
    for df in (parcels, buildings):
        out = out.join(df, F.col("r_areas").eqNullSafe(F.col(df.columns[0])))
    return out.select(F.col("r_areas").alias("r_regionkey"), "areas", "parcels", "buildings")


@query("J11", "SELECT event_type, user_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY (event_id % 2 = 0) DESC, ts DESC, event_id DESC) = 1")
def latest_verified(t: Tables):
    """The latest reading of each unit, verified ones (even ids) before automatic ones."""
    e = t.events.select("event_type", "user_id", "value", "ts", "event_id")
    return rows.first_rows(e, ["event_type", "user_id"], [(F.col("event_id") % 2 == 0).desc(), F.col("ts").desc(), F.col("event_id").desc()]).select("event_type", "user_id", "value")


@query("J07", "SELECT count(*) AS versions, count(*) FILTER (WHERE second) AS appended FROM (SELECT c_custkey % 5 = 0 AS second FROM customer UNION ALL SELECT true FROM customer WHERE c_custkey % 5 = 0)")
def append_only_versions(t: Tables):
    """Rows whose fingerprint is new are appended, the others are there already."""
    mark = lambda df: df.withColumn("h", F.md5(F.concat_ws("\x1f", "c_custkey", "c_mktsegment")))
    old = mark(t.customer).withColumn("second", F.col("c_custkey") % 5 == 0)
    again = mark(t.customer.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 5 == 0, "MOVED").otherwise(F.col("c_mktsegment"))))
    new = again.join(old.select("h"), "h", "left_anti").withColumn("second", F.lit(True))
    return old.unionByName(new).agg(F.count("*").alias("versions"), F.count(F.when(F.col("second"), 1)).alias("appended"))


@query("K14,K13,D31,I26", None)
def probabilistic_links(t: Tables):
    """Misspelt part names against the register: name level, digits and area as evidence; the best candidate of each."""
    left = t.part.where("p_partkey % 20 = 0").select(F.col("p_partkey").alias("a"), F.concat("p_name", F.lit("s")).alias("an"), (F.col("p_size") % 5).alias("aa"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("block"))
    right = t.part.select(F.col("p_partkey").alias("b"), F.col("p_name").alias("bn"), (F.col("p_size") % 5).alias("ba"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("block"))
    n = F.broadcast(right.agg(F.count("*").alias("n")))
    # names and areas decide alone, so each pair of different ones is compared once, and of equal register rows the first stands
    asked, named = left.select("block", "an", "aa").distinct(), right.groupBy("block", "bn", "ba").agg(F.min("b").alias("b"))
    likeness = asked.select("block", "an").distinct().join(named.select("block", "bn").distinct(), "block").withColumn("j", keys.jaro_winkler(F.col("an"), F.col("bn")))
    pairs = asked.join(likeness, ["block", "an"]).join(named, ["block", "bn"]).crossJoin(n)
    weight = linkage.match_weight(linkage.levels(F.col("j"), [0.95, 0.88, 0.8]), [0.8, 0.12, 0.05, 0.03], [0.01, 0.02, 0.05, 0.92]) + linkage.match_weight(F.when(F.col("aa") == F.col("ba"), 0).otherwise(1), [0.6, 0.4], [0.2, 0.8])
    scored = pairs.withColumn("p", linkage.probability(weight, 1 / F.col("n"))).where("p >= 0.05")
    best = rows.first_rows(scored, ["block", "an", "aa"], [F.col("p").desc(), F.col("b")]).select("block", "an", F.col("aa").alias("of"), "b", "p")
    found = left.join(best, ["block", "an"]).where(F.col("aa").eqNullSafe(F.col("of")))
    return found.select("a", "b", F.round("p", 6).alias("p"), F.when(F.col("p") >= 0.95, "accepted").when(F.col("p") >= 0.5, "review").otherwise("unmatched").alias("status"))


@query("K30,O23", None)
def anchored_clusters(t: Tables):
    l = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item"), F.col("l_partkey").alias("bucket"), F.col("l_orderkey").alias("at"), (F.col("l_quantity") * 30).alias("size"), F.col("l_extendedprice").alias("price"))
    return linkage.anchored_clusters(l, "bucket", "at", "item", "size", "price")


@query("K18,K64", """WITH w AS (SELECT DISTINCT p_brand, unnest(string_split(lower(p_type), ' ')) AS w FROM part), n AS (SELECT p_brand, count(*) AS n FROM w GROUP BY 1)
    SELECT a.p_brand AS a, b.p_brand AS b, count(*) AS shared FROM w a JOIN w b ON a.w = b.w AND a.p_brand < b.p_brand JOIN n x ON x.p_brand = a.p_brand JOIN n y ON y.p_brand = b.p_brand GROUP BY 1, 2, x.n, y.n HAVING count(*) >= 0.9 * least(x.n, y.n)""")
def token_containment(t: Tables):
    """Brands whose distinctive words are contained in each other; a word's list holds brands, which are few."""
    w = t.part.select("p_brand", F.explode(F.split(F.lower("p_type"), " ")).alias("w")).distinct()
    n = w.groupBy("p_brand").agg(F.count("*").alias("n"))
    pairs = w.toDF("a", "w").join(w.toDF("b", "w"), "w").where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    return pairs.join(n.toDF("a", "an"), "a").join(n.toDF("b", "bn"), "b").where("shared >= 0.9 * least(an, bn)").select("a", "b", "shared")


@query("K21", """SELECT s_suppkey, CASE WHEN n = 1 THEN base ELSE base || '-' || n END AS card FROM (SELECT s_suppkey, left(sha1(CAST(s_nationkey AS VARCHAR)), 8) AS base, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS n FROM supplier)""")
def card_ids(t: Tables):
    n = F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_suppkey"))
    base = F.substring(F.sha1(F.col("s_nationkey").cast("string")), 1, 8)
    return t.supplier.select("s_suppkey", F.when(n == 1, base).otherwise(F.concat(base, F.lit("-"), n.cast("string"))).alias("card"))


@query("I01", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 6830000 + c_custkey END AS parcel, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST((6830000 + c_custkey) // 10000 AS BIGINT) END AS community FROM customer")
def parcel_spellings(t: Tables):
    """The same parcel in three spellings, and a sub-parcel that is refused."""
    k = F.col("c_custkey") + 6830000
    text = k.cast("string")
    spelt = F.when(F.col("c_custkey") % 4 == 0, F.concat(text, F.lit(".2"))).when(F.col("c_custkey") % 4 == 1, F.concat(text, F.lit(".00"))).when(F.col("c_custkey") % 4 == 2, F.concat(F.lit(" "), text)).otherwise(text)
    key = keys.parcel_key(spelt)
    return t.customer.select("c_custkey", key.alias("parcel"), keys.community_of(key).alias("community"))


@query("E03", "SELECT l_returnflag, count(DISTINCT l_partkey) > 0 AS some FROM lineitem GROUP BY 1")
def approximate_distinct(t: Tables):
    """Approximate counts are free in Spark; only their presence can be compared."""
    return t.lineitem.groupBy("l_returnflag").agg((F.approx_count_distinct("l_partkey") > 0).alias("some"))
