"""Golden gates, content ids, evidence, extracts and churn over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import golden
from .registry import Tables, query, same_sql

_LON, _LAT = "55 + ({0} * 37 % 1000) / 1000.0", "25 + ({0} * 91 % 1000) / 2000.0"
_METRES = "sqrt(power((l.lon - r.lon) * 111320.0 * cos(radians(l.lat)), 2) + power((l.lat - r.lat) * 110574.0, 2))"
_FIELD = f"""l AS (SELECT c_custkey AS a, {_LON.format('c_custkey')} AS lon, {_LAT.format('c_custkey')} AS lat, CASE WHEN c_custkey % 2 = 0 THEN 'beach' ELSE 'park' END AS kind, CASE WHEN c_custkey % 3 = 0 THEN 'members' ELSE 'public' END AS access, 200.0 + c_custkey % 60 * 100 AS claimed FROM {{customer}}),
    r AS (SELECT s_suppkey AS b, {_LON.format('(s_suppkey * 3 + 1)')} AS lon, {_LAT.format('(s_suppkey * 3 + 1)')} AS lat, CASE WHEN s_suppkey % 3 = 0 THEN 'beach' ELSE 'park' END AS kind, CASE WHEN s_suppkey % 5 = 0 THEN 'members' ELSE 'public' END AS access FROM {{supplier}})"""
_ANSWERS = f"""{_FIELD.format(customer='customer', supplier='supplier')}, widest AS (SELECT max(claimed + greatest(150, 0.35 * claimed)) AS w FROM l),
    n AS (SELECT a, b, r.access AS "is", {_METRES} AS m FROM l JOIN r ON r.kind = l.kind AND (l.access <> 'public' OR r.access = 'public') JOIN widest ON {_METRES} <= w QUALIFY row_number() OVER (PARTITION BY a ORDER BY m, b) = 1),
    answers AS (SELECT l.a, round(n.m, 1) AS metres, coalesce(abs(n.m - claimed) <= greatest(150, 0.35 * claimed) AND (access = 'public') = ("is" = 'public'), false) AS holds FROM l LEFT JOIN n ON n.a = l.a)"""


def _answers(t: Tables):
    read = lambda what: t.spark.sql(f"WITH {_FIELD} SELECT * FROM {what}", customer=t.customer, supplier=t.supplier)
    double = lambda df, *cs: df.withColumns({c: F.col(c).cast("double") for c in cs})
    return golden.field_answers(double(read("l"), "lon", "lat", "claimed"), double(read("r"), "lon", "lat"))


@query("K12", f"WITH {_ANSWERS} SELECT * FROM answers")
def field_confirmed(t: Tables):
    """Distances that people gave, against the nearest amenity of the kind and access."""
    return _answers(t).withColumn("metres", F.round("metres", 1))


_RULES = {
    "R1 order keys are unique": "SELECT o_orderkey FROM {orders} GROUP BY o_orderkey HAVING count(*) > 1", "R2 lines have orders": "SELECT l_orderkey FROM {lineitem} LEFT JOIN {orders} ON o_orderkey = l_orderkey WHERE o_orderkey IS NULL",
    "R3 prices are positive": "SELECT o_orderkey FROM {orders} WHERE NOT o_totalprice > 0", "R4 nations have regions": "SELECT n_nationkey FROM {nation} LEFT JOIN {region} ON r_regionkey = n_regionkey WHERE r_regionkey IS NULL",
    "R5 orders have customers": "SELECT o_orderkey FROM {orders} LEFT JOIN {customer} ON c_custkey = o_custkey WHERE c_custkey IS NULL", "R6 nothing is shipped before it is ordered": "SELECT l_orderkey FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey WHERE l_shipdate < o_orderdate",
    "R7 names of suppliers are unique": "SELECT s_name FROM {supplier} GROUP BY s_name HAVING count(*) > 1", "R8 a brand has several kinds": "SELECT p_brand FROM {part} GROUP BY p_brand HAVING count(DISTINCT p_type) < 2",
}
_TABLES = ("orders", "lineitem", "nation", "region", "customer", "supplier", "part")
_KNOWN = {"R6 nothing is shipped before it is ordered", "R9 field answers hold"}
_GATE = " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) AS offenders FROM ({q.format(**{x: x for x in _TABLES})})" for n, q in _RULES.items())


@query("K12", f"""WITH {_ANSWERS}, g AS ({_GATE} UNION ALL SELECT 'R9 field answers hold', count(*) FROM answers WHERE NOT holds)
    SELECT rule, offenders, CASE WHEN offenders = 0 THEN 'PASS' WHEN rule IN ({', '.join(f"'{k}'" for k in sorted(_KNOWN))}) THEN 'known' ELSE 'FAIL' END AS verdict FROM g""")
def golden_gate(t: Tables):
    """Nine rules with their offenders; two are known to fail."""
    rules = {n: t.sql(q, *[x for x in _TABLES if f"{{{x}}}" in q]) for n, q in _RULES.items()}
    return golden.gate(rules | {"R9 field answers hold": _answers(t).where("NOT holds")}, _KNOWN)


@query("K22", """WITH a AS (SELECT p_partkey, left(sha1(concat_ws(chr(31), p_type, CAST(p_size AS VARCHAR))), 10) AS c, left(sha1(concat_ws(chr(31), p_type, CAST(p_size AS VARCHAR), p_name, p_brand)), 10) AS f FROM part),
    b AS (SELECT *, count(*) OVER (PARTITION BY c) AS n, min(p_partkey) OVER (PARTITION BY f) AS first FROM a) SELECT p_partkey, 'am-' || CASE WHEN n > 1 THEN f ELSE c END || CASE WHEN n > 1 AND p_partkey <> first THEN '-' || p_partkey ELSE '' END AS id FROM b""")
def content_ids(t: Tables):
    """Ids from kind and size, refined by name and brand where several parts share them."""
    return golden.content_ids(t.part, "p_partkey", [F.col("p_type"), F.col("p_size")], [F.col("p_name"), F.col("p_brand")], "am-")


_RUNS = ["l_returnflag = 'R'", "l_returnflag IN ('R', 'A') AND l_linenumber < 5", "l_returnflag = 'A'"]
_SAID = "SELECT DISTINCT l_suppkey AS entity, 'k' || l_partkey % 50 AS value FROM lineitem WHERE {0}"


@query("K26", f"""WITH {', '.join(f'r{i} AS ({_SAID.format(w)})' for i, w in enumerate(_RUNS, 1))}, pairs AS (SELECT * FROM r1 UNION SELECT * FROM r2 UNION SELECT * FROM r3),
    f AS (SELECT p.*, r1.entity IS NOT NULL AS i1, r2.entity IS NOT NULL AS i2, r3.entity IS NOT NULL AS i3 FROM pairs p LEFT JOIN r1 USING (entity, value) LEFT JOIN r2 USING (entity, value) LEFT JOIN r3 USING (entity, value))
    SELECT 'job' AS job, entity, value, CASE WHEN u IS NULL THEN 'asserted' ELSE 'superseded' END AS status, s AS since, u AS until FROM (
        SELECT entity, value, 1 AS s, CASE WHEN NOT i2 THEN 2 WHEN NOT i3 THEN 3 END AS u FROM f WHERE i1 UNION ALL SELECT entity, value, 2, CASE WHEN NOT i3 THEN 3 END FROM f WHERE i2 AND NOT i1 UNION ALL SELECT entity, value, 3, NULL FROM f WHERE i3 AND NOT i2)
    UNION ALL SELECT 'other', entity, value, 'asserted', 0, NULL FROM r1""")
def evidence_runs(t: Tables):
    """Three runs of a job over evidence to which another job has added."""
    said = lambda w: t.lineitem.where(w).select(F.col("l_suppkey").alias("entity"), F.concat(F.lit("k"), (F.col("l_partkey") % 50).cast("string")).alias("value"))
    e = said(_RUNS[0]).distinct().select(F.lit("other").alias("job"), "entity", "value", F.lit("asserted").alias("status"), F.lit(0).alias("since"), F.lit(None).cast("int").alias("until"))
    for at, w in enumerate(_RUNS, 1):
        e = golden.asserted(e, said(w), "job", at)
    return e


@query("K06", """WITH b AS (SELECT event_type AS k, event_id, round(value, 2) AS v FROM events WHERE event_id % 50 <> 0 OR event_type <> 'error'), n AS (SELECT event_type AS k, event_id, CASE WHEN event_type = 'click' AND event_id % 40 = 1 THEN -1.0 ELSE round(value, 2) END AS v FROM events),
    d AS (SELECT k, count(*) AS diff FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM n) GROUP BY 1), x AS (SELECT k, count(*) AS was FROM b GROUP BY 1), y AS (SELECT k, count(*) AS now FROM n GROUP BY 1)
    SELECT coalesce(x.k, y.k) AS k, coalesce(was, 0) AS was, coalesce(now, 0) AS "is", CASE WHEN coalesce(was, 0) <> coalesce(now, 0) THEN 'count' WHEN diff > 0 THEN 'content' ELSE 'same' END AS reason FROM x FULL JOIN y ON y.k = x.k LEFT JOIN d ON d.k = coalesce(x.k, y.k)""")
def extracts_compared(t: Tables):
    """Two extracts by type: some rows lost in one type, some changed in another."""
    e = t.events.select(F.col("event_type").alias("k"), "event_id", F.round("value", 2).alias("v"))
    changed = e.withColumn("v", F.when((F.col("k") == "click") & (F.col("event_id") % 40 == 1), -1.0).otherwise(F.col("v")))
    return golden.extracts_compared(e.where("event_id % 50 <> 0 OR k <> 'error'"), changed, "k")


@query("K09", """WITH p AS (SELECT p_partkey AS id FROM part), n AS (SELECT id FROM p WHERE id % 20 <> 3 AND id % 50 <> 4), s AS (SELECT id, CASE WHEN id % 40 = 3 THEN id + 1 WHEN id % 50 = 4 THEN id - 1 END AS by FROM p), gone AS (SELECT id FROM p EXCEPT SELECT id FROM n),
    e AS (SELECT g.id FROM gone g JOIN s a ON a.id = g.id WHERE a.by IN (SELECT id FROM n) OR (SELECT any_value(b.by) FROM s b WHERE b.id = a.by AND a.by IN (SELECT id FROM gone)) IN (SELECT id FROM n))
    SELECT (SELECT count(*) FROM p) AS published, (SELECT count(*) FROM gone) AS vanished, (SELECT count(*) FROM e) AS excused, (SELECT count(*) FROM gone) - (SELECT count(*) FROM e) > 0.01 * (SELECT count(*) FROM p) AS held""")
def id_churn_excused(t: Tables):
    """Ids that are gone, some with a successor that is there, some with one that is gone as well."""
    ids = t.part.select(F.col("p_partkey").alias("id"))
    by = F.when(F.col("id") % 40 == 3, F.col("id") + 1).when(F.col("id") % 50 == 4, F.col("id") - 1)
    return golden.churn(ids, ids.where("id % 20 <> 3 AND id % 50 <> 4"), ids.withColumn("by", by))


same_sql("permit_signal", "K40", """
    SELECT l_partkey, count(*) AS permits, CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR(10)) AS latest, count(*) FILTER (WHERE l_returnflag = 'N') AS new_buildings, CAST(max(CASE WHEN l_returnflag = 'N' THEN CAST(l_shipdate AS DATE) END) AS VARCHAR(10)) AS latest_new,
        coalesce(max(CASE WHEN l_returnflag = 'N' THEN CAST(l_shipdate AS DATE) END) >= max(a.day) - INTERVAL 30 MONTH, false) AS building FROM {lineitem} CROSS JOIN (SELECT max(CAST(l_shipdate AS DATE)) AS day FROM {lineitem}) a GROUP BY l_partkey""", "lineitem")
same_sql("inventory_unaccounted", "K38", """
    SELECT p.p_brand, launched, coalesce(sold, 0) AS sold, launched - coalesce(sold, 0) AS remaining, coalesce(listed, 0) AS listed, launched - coalesce(sold, 0) - coalesce(listed, 0) AS unaccounted
    FROM (SELECT p_brand, sum(p_size) AS launched FROM {part} GROUP BY p_brand) p
    LEFT JOIN (SELECT p_brand, count(*) AS sold FROM {part} JOIN {lineitem} ON l_partkey = p_partkey WHERE l_returnflag = 'A' AND l_linenumber = 1 GROUP BY p_brand) s ON s.p_brand = p.p_brand
    LEFT JOIN (SELECT p_brand, count(DISTINCT p_partkey) AS listed FROM {part} JOIN {lineitem} ON l_partkey = p_partkey WHERE l_returnflag = 'N' GROUP BY p_brand) l ON l.p_brand = p.p_brand""", "part", "lineitem")

@query("K11", """WITH j AS (SELECT o_orderpriority AS job, max(CASE WHEN o_orderkey % 7 < 5 OR o_orderpriority < '3' THEN CAST(o_orderdate AS DATE) END) AS last_run FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderpriority > '2' GROUP BY 1), a AS (SELECT max(CAST(o_orderdate AS DATE)) AS day FROM orders)
    SELECT job, CAST(last_run AS VARCHAR) AS last_run, CAST(day - last_run AS INTEGER) AS days_old, day - last_run > 1 AS stale FROM j, a""")
def join_freshness(t: Tables):
    """How old each job's last run is against the newest register row."""
    day = F.to_date("o_orderdate")
    runs = t.orders.where("o_orderkey % 3 <> 0 OR o_orderpriority > '2'").groupBy(F.col("o_orderpriority").alias("job")).agg(F.max(F.when((F.col("o_orderkey") % 7 < 5) | (F.col("o_orderpriority") < "3"), day)).alias("last_run"))
    newest = t.orders.agg(F.max(day).alias("day"))
    old = F.datediff("day", "last_run")
    return runs.crossJoin(F.broadcast(newest)).select("job", F.col("last_run").cast("string").alias("last_run"), old.alias("days_old"), (old > 1).alias("stale"))
