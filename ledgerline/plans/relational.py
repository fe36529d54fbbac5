"""Joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import rows, stats
from ..sources import lake
from .registry import Tables, query, same_sql

# plain relational queries, the same text on both sides
same_sql("key_join_rollup", "D01,E01,E16", """
    SELECT n_name, count(*) AS orders, round(sum(o_totalprice), 2) AS total, min(o_totalprice) AS lowest, max(o_totalprice) AS highest
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey GROUP BY n_name""", "orders", "customer", "nation")
same_sql("filtered_aggregates", "E02,E03,E04", """
    SELECT l_returnflag, count(*) FILTER (WHERE l_quantity > 25) AS big, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) FILTER (WHERE l_discount > 0.05) AS parts,
           count(*) - count(DISTINCT l_orderkey) AS repeats FROM {lineitem} GROUP BY l_returnflag""", "lineitem")
same_sql("union_spine", "D02,D03,H-02", """
    WITH spine AS (SELECT c_nationkey AS k FROM {customer} UNION SELECT s_nationkey FROM {supplier} UNION SELECT n_nationkey FROM {nation}),
    c AS (SELECT c_nationkey AS k, count(*) AS customers FROM {customer} GROUP BY 1), s AS (SELECT s_nationkey AS k, count(*) AS suppliers FROM {supplier} GROUP BY 1)
    SELECT spine.k, n_name, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers FROM spine LEFT JOIN {nation} ON n_nationkey = spine.k LEFT JOIN c ON c.k = spine.k LEFT JOIN s ON s.k = spine.k""", "customer", "supplier", "nation")
same_sql("case_insensitive_join", "D04,D05,I08", """
    SELECT r_regionkey, n_nationkey, upper(trim(n_name)) AS name FROM {nation} JOIN {region} ON upper(trim(substr(r_name, 1, 1))) = upper(trim(substr(n_name, 1, 1))) AND n_regionkey = r_regionkey""", "nation", "region")
same_sql("theta_within_key", "D06,D25", """
    SELECT count(*) AS pairs, round(max(abs(a.o_totalprice - b.o_totalprice)), 2) AS widest FROM {orders} a JOIN {orders} b
    ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND (abs(a.o_totalprice - b.o_totalprice) <= 5000 OR a.o_orderpriority = b.o_orderpriority)""", "orders")
same_sql("anti_and_semi", "D20,D22,C14", """
    SELECT c_custkey, c_mktsegment FROM {customer} c WHERE NOT EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey AND o_orderstatus = 'F')
    AND EXISTS (SELECT 1 FROM {nation} n WHERE n.n_nationkey = c.c_nationkey AND n_regionkey IN (0, 2))""", "customer", "orders", "nation")
same_sql("not_in_without_nulls", "D23,C14", """
    SELECT p_partkey, p_brand FROM {part} WHERE p_partkey NOT IN (SELECT l_partkey FROM {lineitem} WHERE l_partkey IS NOT NULL AND l_quantity > 45)""", "part", "lineitem")
same_sql("correlated_scalars", "D24,O9", """
    SELECT s_suppkey, (SELECT count(*) FROM {lineitem} WHERE l_suppkey = s_suppkey) AS lines, (SELECT round(max(l_extendedprice), 2) FROM {lineitem} WHERE l_suppkey = s_suppkey AND l_returnflag = 'R') AS best FROM {supplier}""", "supplier", "lineitem")
same_sql("tuple_membership", "C15", """
    SELECT e.event_type, count(*) AS n, count(f.user_id) AS flagged FROM {events} e LEFT JOIN (SELECT user_id, event_type FROM {events} GROUP BY 1, 2 HAVING count(*) >= 3) f
    ON e.user_id = f.user_id AND e.event_type = f.event_type GROUP BY e.event_type""", "events")
same_sql("full_outer_null_safe", "D10,I20", """
    WITH a AS (SELECT nullif(c_nationkey, 3) AS k, count(*) AS n FROM {customer} GROUP BY 1), b AS (SELECT nullif(s_nationkey, 3) AS k, count(*) AS n FROM {supplier} GROUP BY 1)
    SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) AS customers, coalesce(b.n, 0) AS suppliers FROM a FULL OUTER JOIN b ON a.k IS NOT DISTINCT FROM b.k""", "customer", "supplier")
same_sql("having_alias", "E17,C11", """
    SELECT l_suppkey, count(*) AS n, round(avg(l_discount), 6) AS discount FROM {lineitem} GROUP BY l_suppkey HAVING count(*) >= 20 AND avg(l_discount) > 0.04""", "lineitem")
same_sql("cube_of_flags", "E35,E30", """
    SELECT l_returnflag, l_linestatus, grouping(l_returnflag) + grouping(l_linestatus) AS level, count(*) AS n FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)""", "lineitem")
same_sql("rollup_of_places", "E35", """
    SELECT r_name, n_name, count(*) AS customers FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""", "customer", "nation", "region")
same_sql("rank_family", "F18", """
    SELECT s_suppkey, row_number() OVER w AS rn, rank() OVER w AS rk, dense_rank() OVER w AS dr, ntile(4) OVER w AS quarter FROM {supplier} WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey)""", "supplier")
same_sql("share_of_group", "F08,F09", """
    SELECT l_returnflag, l_linestatus, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag), 6) AS share FROM {lineitem} GROUP BY l_returnflag, l_linestatus""", "lineitem")
same_sql("window_counts", "F10,F12,F13", """
    SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS mine, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey) AS BIGINT) AS finished FROM {orders}""", "orders")
same_sql("top_and_bottom", "G01,G03,G05", """
    (SELECT 'top' AS side, o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 8) UNION ALL (SELECT 'bottom', o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice, o_orderkey LIMIT 8)""", "orders")
same_sql("priority_order", "F16,G04", """
    SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT o_custkey, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderpriority LIKE '1%' THEN 0 WHEN o_orderpriority LIKE '2%' THEN 1 ELSE 2 END, o_orderkey) AS r FROM {orders}) x WHERE r = 1""", "orders")
same_sql("except_all", "H-04,K06", """
    (SELECT l_partkey, l_suppkey FROM {lineitem} WHERE l_linenumber <= 2) EXCEPT ALL (SELECT l_partkey, l_suppkey FROM {lineitem} WHERE l_linenumber > 2)""", "lineitem")
same_sql("intersect_keys", "H-05,H-06", "SELECT c_nationkey AS k FROM {customer} INTERSECT SELECT s_nationkey FROM {supplier}", "customer", "supplier")
@query("D11", """
    SELECT u.user_id, t.event_type, count(e.event_id) AS n FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (SELECT DISTINCT event_type FROM events) t
    LEFT JOIN events e ON e.user_id = u.user_id AND e.event_type = t.event_type GROUP BY u.user_id, t.event_type""")
def zero_filled_grid(t: Tables):
    """All users by all event types, which are few."""
    counts = t.events.groupBy("user_id", "event_type").agg(F.count("event_id").alias("n"))
    grid = t.events.select("user_id").distinct().crossJoin(F.broadcast(t.events.select("event_type").distinct()))
    return grid.join(counts, ["user_id", "event_type"], "left").select("user_id", "event_type", F.coalesce("n", F.lit(0)).alias("n"))


same_sql("bands", "C08", """
    SELECT CASE WHEN p_retailprice < 1000 THEN 'low' WHEN p_retailprice < 1500 THEN 'mid' ELSE 'high' END AS band, p_size BETWEEN 10 AND 20 AS medium, count(*) AS n FROM {part} GROUP BY 1, 2""", "part")
same_sql("pattern_filters", "C16,I07", """
    SELECT count(*) FILTER (WHERE p_name LIKE '%a%') AS has_a, count(*) FILTER (WHERE lower(p_type) LIKE 'standard%') AS standard, count(*) FILTER (WHERE p_brand ILIKE 'BRAND#1%') AS ones FROM {part}""", "part")
same_sql("two_level", "E18,E05,E06", """
    SELECT n_name, count(*) AS customers, round(median(total), 2) AS median_total FROM (SELECT o_custkey, sum(o_totalprice) AS total FROM {orders} GROUP BY 1) s JOIN {customer} ON c_custkey = o_custkey JOIN {nation} ON n_nationkey = c_nationkey GROUP BY n_name""", "orders", "customer", "nation")
same_sql("weighted_ratio", "E20,K68", """
    SELECT l_suppkey, round(sum(l_extendedprice) / nullif(sum(l_quantity), 0), 4) AS unit_price, round(sum(l_discount * l_quantity) / nullif(sum(l_quantity), 0), 6) AS mean_discount FROM {lineitem} GROUP BY l_suppkey""", "lineitem")
same_sql("self_excluding", "E33", """
    SELECT p.p_partkey, g.n - 1 AS others, round((g.total - p.p_retailprice) / nullif(g.n - 1, 0), 4) AS rest_mean FROM {part} p JOIN (SELECT p_brand, count(*) AS n, sum(p_retailprice) AS total FROM {part} GROUP BY 1) g ON g.p_brand = p.p_brand""", "part")
same_sql("year_to_date", "E32,I12", """
    SELECT year(o_orderdate) AS y, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {orders} WHERE dayofyear(o_orderdate) <= 180 GROUP BY 1""", "orders")
same_sql("distinct_rows", "E23", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM {lineitem}", "lineitem")


@query("F01,F02", "SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def latest_per_key(t: Tables):
    return rows.first_rows(t.orders, ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()])


@query("F03,D08", "SELECT p_partkey, p_name FROM part QUALIFY count(*) OVER (PARTITION BY p_name) = 1")
def unambiguous_names(t: Tables):
    return rows.only_rows(t.part.select("p_partkey", "p_name"), ["p_name"])


@query("F04,J02", """SELECT l_orderkey, l_linenumber, CASE WHEN n = 1 THEN CAST(l_orderkey AS VARCHAR) ELSE l_orderkey || '#' || n END AS txn_key
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS n FROM lineitem)""")
def ordinal_keys(t: Tables):
    return rows.ordinal_key(t.lineitem.select("l_orderkey", "l_linenumber"), "l_orderkey", [F.col("l_linenumber")], "txn_key")


@query("F15", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 6")
def top_six(t: Tables):
    return rows.first_rows(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 6)


@query("F05,F06", """WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)
    SELECT month, total, lag(total) OVER (ORDER BY month) AS before, lag(total, 12) OVER (ORDER BY month) AS year_before FROM m""")
def year_on_year(t: Tables):
    m = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    w = Window.orderBy("month")  # one row a month
    return m.select("month", "total", F.lag("total").over(w).alias("before"), F.lag("total", 12).over(w).alias("year_before"))


@query("F11", "SELECT DISTINCT l_orderkey, count(DISTINCT l_suppkey) OVER (PARTITION BY l_orderkey) AS suppliers FROM lineitem")
def distinct_over_key(t: Tables):
    # a distinct count over a window, as aggregate and join back: no set is gathered for a frequent key
    n = t.lineitem.groupBy("l_orderkey").agg(F.countDistinct("l_suppkey").alias("suppliers"))
    return t.lineitem.select("l_orderkey").distinct().join(n, "l_orderkey")


@query("E07,C11", """WITH v AS (SELECT p_brand, list_sort(list(l_quantity * 1.0 + l_discount)) AS v FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 HAVING count(*) >= 20),
    q AS (SELECT p_brand, v, len(v) AS n, p, least(greatest(1, CAST(floor((len(v) + 1) * p) AS BIGINT)), len(v) - 1) AS j FROM v, (VALUES (0.25::DOUBLE), (0.75::DOUBLE)) x(p))
    SELECT p_brand, n, round(max(CASE WHEN p < 0.5 THEN v[j] * (1 - ((n + 1) * p - j)) + v[j + 1] * ((n + 1) * p - j) END), 4) AS p25, round(max(CASE WHEN p > 0.5 THEN v[j] * (1 - ((n + 1) * p - j)) + v[j + 1] * ((n + 1) * p - j) END), 4) AS p75 FROM q GROUP BY p_brand, n""")
def exclusive_quartiles(t: Tables):
    x = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", (F.col("l_quantity") + F.col("l_discount")).alias("x"))
    q = stats.exclusive_quantiles(x, "p_brand", "x", {"p25": 0.25, "p75": 0.75}).drop("n")
    n = x.groupBy(F.col("p_brand").alias("b")).agg(F.count("*").alias("n")).where("n >= 20")  # with rows that have no value
    return n.join(q, F.col("b").eqNullSafe(F.col("p_brand")), "left").select(F.col("b").alias("p_brand"), "n", F.round("p25", 4).alias("p25"), F.round("p75", 4).alias("p75"))


@query("E08", """SELECT l_returnflag, list_sort(list(l_extendedprice))[least(count(*), CAST(floor(count(*) * 0.1) AS BIGINT) + 1)] AS p10, list_sort(list(l_extendedprice))[least(count(*), CAST(floor(count(*) * 0.9) AS BIGINT) + 1)] AS p90 FROM lineitem GROUP BY l_returnflag""")
def index_percentiles(t: Tables):
    return stats.index_percentiles(t.lineitem, "l_returnflag", "l_extendedprice", {"p10": 0.1, "p90": 0.9})


@query("E06,K45", """SELECT l_linestatus, count(*) AS n, round(median(l_extendedprice), 2) AS median, round(quantile_cont(l_extendedprice, 0.25), 2) AS p25, round(quantile_cont(l_extendedprice, 0.75), 2) AS p75,
    round((quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25)) / median(l_extendedprice), 4) AS dispersion FROM lineitem GROUP BY l_linestatus""")
def depth_table(t: Tables):
    q = stats.interpolated_quantiles(t.lineitem, "l_linestatus", "l_extendedprice", {"median": 0.5, "p25": 0.25, "p75": 0.75})
    dispersion = F.round((F.col("p75") - F.col("p25")) / F.col("median"), 4)
    return q.select("l_linestatus", "n", *[F.round(c, 2).alias(c) for c in ("median", "p25", "p75")], dispersion.alias("dispersion"))


@query("E09", "SELECT l_suppkey, l_partkey, n FROM (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) = 1")
def modes(t: Tables):
    return stats.mode_of(t.lineitem, ["l_suppkey"], "l_partkey")


@query("E10,G06", "SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_type LIMIT 10")
def most_common(t: Tables):
    return t.part.groupBy("p_type").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "p_type").limit(10)


@query("E12,E13", "SELECT o_custkey, arg_max(o_orderkey, {'d': o_totalprice, 'k': o_orderkey}) AS dearest, arg_min(o_orderkey, {'d': o_orderdate, 'k': o_orderkey}) AS first FROM orders GROUP BY 1")
def struct_arg_max(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("dearest"), F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first"))


@query("E14,E15,I21", "SELECT n_regionkey, string_agg(n_name, '|' ORDER BY n_name) AS names, count(DISTINCT left(n_name, 1)) AS letters FROM nation GROUP BY 1")
def ordered_lists(t: Tables):
    return t.nation.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("n_name")), "|").alias("names"), F.countDistinct(F.left("n_name", F.lit(1))).alias("letters"))


@query("E19,F13", """WITH s AS (SELECT o_custkey, sum(o_totalprice) AS v FROM orders GROUP BY 1), r AS (SELECT v, row_number() OVER (ORDER BY v DESC, o_custkey) AS r, count(*) OVER () AS n FROM s)
    SELECT round(sum(v) FILTER (WHERE r <= ceil(n * 0.1)) / sum(v), 6) AS top_10_pct, round(sum(v) FILTER (WHERE r <= ceil(n * 0.01)) / sum(v), 6) AS top_1_pct FROM r""")
def concentration(t: Tables):
    return stats.concentration(t.orders, "o_custkey", "o_totalprice")


@query("E24,E25", """WITH b AS (SELECT CAST(floor(l_quantity / 2) * 2 AS BIGINT) AS bin, count(*) FILTER (WHERE l_returnflag = 'N') AS lo, count(*) FILTER (WHERE l_returnflag = 'R') AS hi FROM lineitem GROUP BY 1)
    SELECT bin AS cut, CAST(coalesce((SELECT sum(hi) FROM b x WHERE x.bin < b.bin), 0) + (SELECT sum(lo) FROM b x WHERE x.bin >= b.bin) AS BIGINT) AS errors FROM b ORDER BY errors, cut LIMIT 1""")
def best_histogram_cut(t: Tables):
    bins = t.lineitem.groupBy((F.floor(F.col("l_quantity") / 2) * 2).alias("bin")).agg(F.count(F.when(F.col("l_returnflag") == "N", 1)).alias("lo"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("hi"))
    return stats.best_cut(bins, "bin", "lo", "hi")


@query("E26", "SELECT s_suppkey, round((rank() OVER (ORDER BY s_acctbal) - 1) / count(*) OVER (), 6) AS below FROM supplier")
def percent_below(t: Tables):
    # the place of the first row of a value, less one, is how many are below
    places = rows.numbered(t.supplier.select("s_acctbal", "s_suppkey"), [F.col("s_acctbal"), F.col("s_suppkey")], "place", lake.shared_dir(t.spark))
    low = places.groupBy("s_acctbal").agg((F.min("place") - 1).alias("less"))
    total = t.supplier.agg(F.count("*").alias("total"))
    return t.supplier.join(low, "s_acctbal").crossJoin(F.broadcast(total)).select("s_suppkey", F.round(F.col("less") / F.col("total"), 6).alias("below"))


@query("E31,E30", """SELECT CASE WHEN b.band IS NULL THEN 'all' ELSE b.band END AS band, tag, count(*) AS n, round(median(p_retailprice), 2) AS median FROM part,
    (VALUES ('all'), ('small'), ('large')) b(band), (VALUES ('all'), ('brass'), ('steel')) g(tag)
    WHERE (b.band = 'all' OR (b.band = 'small' AND p_size < 25) OR (b.band = 'large' AND p_size >= 25)) AND (tag = 'all' OR lower(p_type) LIKE '%' || tag || '%') GROUP BY 1, 2""")
def band_tag_cube(t: Tables):
    band = F.explode(F.array(F.lit("all"), F.when(F.col("p_size") < 25, "small").otherwise("large"))).alias("band")
    tags = F.concat(F.array(F.lit("all")), F.filter(F.array(F.lit("brass"), F.lit("steel")), lambda g: F.lower(F.col("p_type")).contains(g)))
    return t.part.select("p_retailprice", "p_type", band).select("p_retailprice", "band", F.explode(tags).alias("tag")).groupBy("band", "tag").agg(F.count("*").alias("n"), F.round(F.median("p_retailprice"), 2).alias("median"))


@query("E21,B04", None)
def fingerprint(t: Tables):
    return stats.fingerprint(t.nation)


@query("E22", "SELECT * FROM (VALUES (1), (3)) x(load), LATERAL (SELECT count(*) AS n FROM nation WHERE load = 1 OR n_regionkey = 1)")
def duplicate_batches(t: Tables):
    """Load batches with the same rows as an earlier batch go; the second copy of the nations is such a batch."""
    loads = t.nation.withColumn("load", F.lit(1)).unionAll(t.nation.withColumn("load", F.lit(2))).unionAll(t.nation.where("n_regionkey = 1").withColumn("load", F.lit(3)))
    marks = loads.groupBy("load").agg(F.count("*").alias("n"), F.sum(F.xxhash64("n_nationkey", "n_name", "n_regionkey").cast("decimal(38,0)")).alias("h"))
    kept = marks.groupBy("n", "h").agg(F.min("load").alias("load"))
    return loads.join(kept.select("load"), "load", "left_semi").groupBy("load").agg(F.count("*").alias("n"))


@query("D07", """SELECT l_orderkey, l_linenumber, coalesce(a.v, b.v, c.v) AS value, CASE WHEN a.v IS NOT NULL THEN 'cheap' WHEN b.v IS NOT NULL THEN 'large' WHEN c.v IS NOT NULL THEN 'any' END AS source
    FROM lineitem LEFT JOIN (SELECT p_partkey AS k, p_brand AS v FROM part WHERE p_retailprice < 1000) a ON a.k = l_partkey LEFT JOIN (SELECT p_partkey AS k, p_type AS v FROM part WHERE p_size > 30) b ON b.k = l_partkey LEFT JOIN (SELECT p_partkey AS k, p_name AS v FROM part WHERE p_partkey % 2 = 0) c ON c.k = l_partkey""")
def fallback_cascade(t: Tables):
    p = t.part.withColumnRenamed("p_partkey", "l_partkey")
    sources = [("cheap", p.where("p_retailprice < 1000").withColumn("v", F.col("p_brand"))), ("large", p.where("p_size > 30").withColumn("v", F.col("p_type"))), ("any", p.where("l_partkey % 2 = 0").withColumn("v", F.col("p_name")))]
    return rows.fallback(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", sources, "v").drop("l_partkey")


@query("D33", """WITH k AS (SELECT l_orderkey, min(l_suppkey) AS agreed FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) = 1)
    SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END, agreed) AS key FROM orders LEFT JOIN k ON k.l_orderkey = o_orderkey""")
def key_recovery(t: Tables):
    agreed = t.lineitem.groupBy("l_orderkey").agg(F.countDistinct("l_suppkey").alias("n"), F.min("l_suppkey").alias("only")).where("n = 1")
    return t.orders.join(agreed, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("o_orderkey", F.coalesce(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey")), "only").alias("key"))


@query("H-01,H-03", "SELECT n_nationkey AS k, n_name AS name, n_regionkey AS parent FROM nation UNION ALL SELECT r_regionkey, r_name, NULL FROM region")
def union_by_name(t: Tables):
    return t.nation.toDF("k", "name", "parent").unionByName(t.region.toDF("k", "name"), allowMissingColumns=True)


@query("H-04,K07", """WITH l AS (SELECT c_mktsegment AS s, c_nationkey AS k FROM customer WHERE c_custkey % 2 = 0), r AS (SELECT c_mktsegment AS s, c_nationkey AS k FROM customer WHERE c_custkey % 2 = 1)
    SELECT *, 'left' AS side FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r) UNION ALL SELECT *, 'right' FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l)""")
def multiset_difference(t: Tables):
    half = lambda n: t.customer.where(F.col("c_custkey") % 2 == n).select(F.col("c_mktsegment").alias("s"), F.col("c_nationkey").alias("k"))
    return rows.multiset_difference(half(0), half(1))


@query("D35", "SELECT s_suppkey, p_partkey FROM (SELECT s_suppkey, unnest([s_suppkey, s_suppkey * 2, s_suppkey * 3]) AS k FROM supplier) JOIN part ON p_partkey = k")
def list_membership_join(t: Tables):
    keys = t.supplier.select("s_suppkey", F.explode(F.array(F.col("s_suppkey"), F.col("s_suppkey") * 2, F.col("s_suppkey") * 3)).alias("k"))
    return keys.join(t.part, F.col("p_partkey") == F.col("k")).select("s_suppkey", "p_partkey")


@query("E20", "SELECT n, agree, agree >= 0.99 * n AND n >= 100 AS use_bridge FROM (SELECT count(*) AS n, count(*) FILTER (WHERE o_custkey = c_custkey) AS agree FROM orders JOIN customer ON c_custkey = o_custkey)")
def gated_bridge(t: Tables):
    checks = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).agg(F.count("*").alias("n"), F.count(F.when(F.col("o_custkey") == F.col("c_custkey"), 1)).alias("agree"))
    return checks.withColumn("use_bridge", (F.col("agree") >= 0.99 * F.col("n")) & (F.col("n") >= 100))


@query("D20", """SELECT e.event_id, max(o.o_orderkey) FILTER (WHERE o.o_orderdate <= e.ts) IS NOT NULL AS had FROM events e LEFT JOIN orders o ON o.o_custkey = e.user_id GROUP BY e.event_id""")
def as_of_existence(t: Tables):
    """Whether the user had an order as of the event: the earliest order of a user decides, so the join is one row a key."""
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    return t.events.join(first, F.col("o_custkey") == F.col("user_id"), "left").select("event_id", F.coalesce(F.col("first") <= F.col("ts"), F.lit(False)).alias("had"))


@query("C21", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey IN (1, 2, 3, 5, 8, 13)")
def bound_parameters(t: Tables):
    keys = t.spark.createDataFrame([(k,) for k in (1, 2, 3, 5, 8, 13)], "k long")
    return t.spark.sql("SELECT o_orderkey, o_orderstatus FROM {o} WHERE o_orderpriority = :p AND o_custkey IN (SELECT k FROM {k})", args={"p": "1-URGENT"}, o=t.orders, k=keys)
