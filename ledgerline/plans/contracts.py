"""Feed contracts, holds, audits, and joins that are chosen by evidence."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import keys
from ..operators import contracts, gates, linkage, rows, stats
from ..sources import lake
from .registry import Tables, query, same_sql

_FEEDS = """f AS (SELECT o_custkey AS key, count(*) AS reported, count(DISTINCT CASE WHEN o_custkey % 7 = 0 THEN o_orderpriority ELSE CAST(o_orderkey AS VARCHAR) END) AS loaded,
        CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE count(DISTINCT CASE WHEN o_custkey % 7 = 0 THEN o_orderpriority ELSE CAST(o_orderkey AS VARCHAR) END) + CASE WHEN o_custkey % 13 = 0 THEN 1 ELSE 0 END END AS in_table,
        o_custkey % 17 AS age, CASE WHEN o_custkey % 5 = 0 THEN 2 * count(*) END AS accepted FROM orders GROUP BY 1)"""


@query("K01,K02,K04,J05", f"""WITH {_FEEDS} SELECT key, CASE WHEN reported > 0 AND (coalesce(in_table, 0) = 0 OR loaded = 0) THEN 'held' WHEN in_table <> loaded THEN 'held' WHEN loaded < 0.8 * accepted THEN 'held' WHEN age > 14 THEN 'stale' WHEN reported > loaded THEN 'ok-deduplicated' ELSE 'ok' END AS status,
    CASE WHEN reported > 0 AND (coalesce(in_table, 0) = 0 OR loaded = 0) THEN 'nothing loaded' WHEN in_table <> loaded THEN 'table differs' WHEN loaded < 0.8 * accepted THEN 'shrank' WHEN age > 14 THEN 'old' WHEN reported > loaded THEN 'source repeats' ELSE '' END AS reason FROM f""")
def feed_contracts(t: Tables):
    """What each feed reported, what was loaded and what its table holds: ok, deduplicated, stale or held, with the reason."""
    k = F.col("o_custkey")
    item = F.when(k % 7 == 0, F.col("o_orderpriority")).otherwise(F.col("o_orderkey").cast("string"))
    f = t.orders.groupBy(k.alias("key")).agg(F.count("*").alias("reported"), F.countDistinct(item).alias("loaded"))
    key = F.col("key")
    f = f.select("key", "reported", "loaded", F.when(key % 11 != 0, F.col("loaded") + F.when(key % 13 == 0, 1).otherwise(0)).alias("in_table"), (key % 17).alias("age"), F.when(key % 5 == 0, 2 * F.col("reported")).alias("accepted"), F.lit(None).cast("long").alias("distinct_rows"))
    return contracts.feed_status(f).select("key", "status", "reason")




@query("J12,F19")
def collapse_holds(t: Tables):
    """Readings that fall below half of the last accepted one are held unless a later one agrees; tests replay the rule."""
    at = F.struct(F.to_date("o_orderdate").cast("string").alias("day"), F.col("o_orderkey").alias("k"))
    r = t.orders.select(F.col("o_custkey").alias("g"), at.alias("at"), F.floor(F.col("o_totalprice") / 5000).cast("bigint").alias("n"))
    return contracts.collapse_holds(r, "g", "at", "n").select("g", F.col("at.k").alias("k"), "n", "accepted", "held")


@query("K05", """WITH m AS (SELECT s_suppkey AS id, 1 + s_suppkey % 4 AS listed, CASE WHEN s_suppkey % 9 = 0 THEN 0 ELSE 1 + s_suppkey % 3 END AS parts, CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE 1 + s_suppkey % 2 END AS published, s_suppkey % 8 = 0 AS cut, s_suppkey % 12 = 0 AS failed, s_suppkey % 5 AS fetched, s_suppkey % 6 AS extract FROM supplier)
    SELECT id, CASE WHEN parts = 0 THEN 'missing' WHEN published IS NULL THEN CASE WHEN cut THEN 'partial' ELSE 'unverified' END WHEN failed OR cut OR parts < published THEN 'partial' WHEN extract > fetched THEN 'behind' ELSE 'complete' END AS status FROM m""")
def manifest_judged(t: Tables):
    k = F.col("s_suppkey")
    m = t.supplier.select(
        k.alias("id"), (1 + k % 4).alias("listed"), F.when(k % 9 == 0, 0).otherwise(1 + k % 3).alias("parts"), F.when(k % 10 != 0, 1 + k % 2).alias("published"), (k % 8 == 0).alias("cut"), (k % 12 == 0).alias("failed"), (k % 5).alias("fetched"), (k % 6).alias("extract"),
    )
    return contracts.manifest_status(m).select("id", "status")


@query("K05", "SELECT * FROM (VALUES ('a.csv', ''), ('b.csv', 'the last line has no end'), ('c.json', ''), ('d.json', 'never closes'), ('e.kml', ''), ('f.kml', 'never closes'), ('g.csv', 'a download cap')) v(name, reason)")
def files_cut_short(t: Tables):
    rows_ = [("a.csv", 10, "1,2\n"), ("b.csv", 10, "1,2"), ("c.json", 10, "[1] \n"), ("d.json", 10, "[1, "), ("e.kml", 10, "<x/></KML>\n"), ("f.kml", 10, "<x/>"), ("g.csv", 64 << 20, "1\n")]
    f = t.spark.createDataFrame(rows_, "name string, size long, tail string")
    return f.select("name", contracts.cut_short(F.col("name"), F.col("size"), F.col("tail")).alias("reason"))


def _bridged(t: Tables, right: str):
    """Orders bridged to customers by a second key, only if it agrees with the first on 99 % of at least 100 checks."""
    other = F.col("o_orderkey") % 100 if right == "bad" else F.col("o_custkey")
    o = t.orders.select("o_orderkey", "o_custkey", other.alias("second"))
    checks = o.where(F.col("o_orderkey") % 2 == 0).select(F.col("o_custkey").alias("a"), F.col("second").alias("b"))
    use = contracts.bridge_agrees(checks, "a", "b")
    key = F.coalesce(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")), F.col("second") if use else F.lit(None))
    return o.select("o_orderkey", key.alias("key"))


@query("D09", "SELECT o_orderkey, o_custkey AS key, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS refused FROM orders")
def bridge_by_evidence(t: Tables):
    """A bridge that agrees is used for the rows without a key of their own; one that does not agree is not."""
    return _bridged(t, "good").join(_bridged(t, "bad").select("o_orderkey", F.col("key").alias("refused")), "o_orderkey")


@query("C03,C12", """SELECT 'valuations' AS feed, count(*) AS total, count(*) FILTER (WHERE NOT coalesce(l_extendedprice > 0 AND l_extendedprice < 5e9 AND l_quantity > 0, false)) AS dropped FROM lineitem
    UNION ALL SELECT 'projects', count(*), count(*) FILTER (WHERE NOT coalesce(p_name <> '' AND p_size BETWEEN 1 AND 45, false)) FROM part UNION ALL SELECT 'brokers', count(*), count(*) FILTER (WHERE NOT coalesce(regexp_matches(s_name, '^[A-Za-z]+#[0-9]+$') AND s_acctbal > 0, false)) FROM supplier""")
def feed_shapes(t: Tables):
    """The shapes of several feeds; a feed without its columns is passed over."""
    c = F.col
    shapes = {
        "valuations": (t.lineitem, ["l_extendedprice", "l_quantity"], lambda: (c("l_extendedprice") > 0) & (c("l_extendedprice") < 5e9) & (c("l_quantity") > 0)),
        "projects": (t.part, ["p_name", "p_size"], lambda: (c("p_name") != "") & c("p_size").between(1, 45)),
        "brokers": (t.supplier, ["s_name", "s_acctbal"], lambda: c("s_name").rlike("^[A-Za-z]+#[0-9]+$") & (c("s_acctbal") > 0)),
        "rents": (t.region, ["contract_id"], lambda: c("contract_id").isNotNull()),
    }
    out = [gates.Gate(name, shape()).report(df) for name, (df, need, shape) in shapes.items() if set(need) <= set(df.columns)]
    both = out[0]
    for df in out[1:]:
        both = both.unionByName(df)
    return both.withColumnRenamed("gate", "feed")


@query("C13,K27", """SELECT 'c_custkey' AS col, 'key' AS role, count(*) AS n, count(*) AS matched FROM customer UNION ALL SELECT 'c_nationkey', 'key', count(*), count(*) FILTER (WHERE c_nationkey IN (SELECT n_nationkey FROM nation)) FROM customer
    UNION ALL SELECT 'c_name', 'name', count(*), count(*) FILTER (WHERE c_name IN (SELECT n_name FROM nation)) FROM customer""")
def column_roles(t: Tables):
    """Columns bound to a spine by what their names say, with the share of rows that the spine knows."""
    spines = {"c_custkey": t.customer.select("c_custkey"), "c_nationkey": t.nation.select("n_nationkey"), "c_name": t.nation.select("n_name")}
    bound = contracts.roles(t.customer.columns, {"key": r"(cust|nation)key$", "name": r"_name$"})
    parts = [contracts.match_rate(t.customer, col, spines[col]).select(F.lit(col).alias("col"), F.lit(role).alias("role"), "n", "matched") for col, role in bound.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


same_sql("except_columns", "C06,C07", """SELECT n_nationkey, n_name, length(n_name) AS letters, letters * 2 AS doubled FROM {nation}""", "nation")


@query("C06", "SELECT * EXCLUDE (r_name) FROM region")
def projection_except(t: Tables):
    return t.spark.sql("SELECT * EXCEPT (r_name) FROM {region}", region=t.region)


same_sql("nulls_last_order", "G02", "SELECT p_partkey, row_number() OVER (ORDER BY nullif(p_size, 1) DESC NULLS LAST, p_partkey) AS place FROM {part} WHERE p_brand = 'Brand#11' OR p_partkey < 100", "part")
same_sql("any_of_group", "E11", "SELECT n_regionkey, any_value(r_name) AS r_name FROM {nation} JOIN {region} ON r_regionkey = n_regionkey GROUP BY n_regionkey", "nation", "region")
same_sql("lateral_and_right", "D39", "SELECT r_regionkey, x.n, n_name FROM {region} CROSS JOIN LATERAL (SELECT r_regionkey * 2 AS n) x RIGHT JOIN {nation} ON n_regionkey = r_regionkey", "region", "nation")


@query("D30", "SELECT o_orderkey, coalesce(CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' WHEN '5-LOW' THEN 'low' END, lower(o_orderpriority)) AS area FROM orders")
def alias_lookup(t: Tables):
    """Labels put to their registered names by a short alias table; unknown labels keep their own."""
    alias = t.spark.createDataFrame([("1-urgent", "high"), ("2-high", "high"), ("5-low", "low")], "label string, area string")
    return t.orders.withColumn("label", F.lower("o_orderpriority")).join(F.broadcast(alias), "label", "left").select("o_orderkey", F.coalesce("area", "label").alias("area"))


@query("D34", """WITH p AS (SELECT p_partkey AS k, p_partkey // 3 AS parent, CASE WHEN p_partkey % 4 = 0 THEN p_size END AS own FROM part)
    SELECT a.k, coalesce(a.own, b.own, c.own) AS key, CASE WHEN a.own IS NOT NULL THEN 'own' WHEN b.own IS NOT NULL THEN 'parent' WHEN c.own IS NOT NULL THEN 'grandparent' END AS route FROM p a LEFT JOIN p b ON b.k = a.parent LEFT JOIN p c ON c.k = b.parent""")
def ancestor_key(t: Tables):
    k = F.col("p_partkey")
    p = t.part.select(k.alias("k"), F.floor(k / 3).alias("parent"), F.when(k % 4 == 0, F.col("p_size")).alias("own"))
    up = lambda n: p.select(F.col("k").alias(f"k{n}"), F.col("parent").alias(f"parent{n}"), F.col("own").alias(f"own{n}"))
    j = p.join(up(1), F.col("parent") == F.col("k1"), "left").join(up(2), F.col("parent1") == F.col("k2"), "left")
    route = F.when(F.col("own").isNotNull(), "own").when(F.col("own1").isNotNull(), "parent").when(F.col("own2").isNotNull(), "grandparent")
    return j.select("k", F.coalesce("own", "own1", "own2").alias("key"), route.alias("route"))


@query("D37", """SELECT event_id, o.o_orderkey AS latest FROM events e ASOF LEFT JOIN (SELECT o_custkey, o_orderdate, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2) o ON o.o_custkey = e.user_id AND e.ts >= o.o_orderdate""")
def as_of_value(t: Tables):
    """The customer's latest order at the time of each event."""
    o = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("timestamp").alias("at"), F.col("o_orderkey").alias("v"))
    e = t.events.select(F.col("user_id").alias("k"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("row"))
    return rows.as_of(e, o, "k", "at", "v").select(F.col("row").alias("event_id"), F.col("v").alias("latest"))


@query("D38,J08", """WITH v AS (SELECT o_custkey AS k, o_orderkey AS v, o_orderdate AS a, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS b FROM orders)
    SELECT event_id, v FROM events JOIN v ON k = user_id AND a <= ts AND (b IS NULL OR ts < b)""")
def interval_membership(t: Tables):
    """The version that was current at each event, by key and half-open interval."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    v = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"), F.col("o_orderdate").alias("a"), F.lead("o_orderdate").over(w).alias("b"))
    return t.events.join(v, F.col("k") == F.col("user_id")).where("a <= ts AND (b IS NULL OR ts < b)").select("event_id", "v")


@query("K35,I35", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def months_only(t: Tables):
    """Dates as published: no day leaves."""
    return t.orders.select("o_orderkey", keys.month_label(F.col("o_orderdate")).alias("month"))


@query("K66,L04", """SELECT * FROM (VALUES ('customer', 'c_nationkey'), ('supplier', 's_nationkey'), ('nation', 'n_nationkey'), ('nation', 'n_regionkey'), ('region', 'r_regionkey')) v(tbl, col)""")
def tables_with_column(t: Tables):
    """Which tables carry a column whose name tells of a region or nation."""
    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    found = [(n, c) for n in names for c in contracts.roles(getattr(t, n).columns, {"place": "(nation|region)key"})]
    return t.spark.createDataFrame(found, "tbl string, col string")


@query("K54", """WITH a AS (SELECT n_name AS question, count(c_custkey) AS answers, count(*) FILTER (WHERE c_acctbal < 0) AS wrong FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1)
    SELECT CASE WHEN answers = 0 OR wrong > 0.2 * answers THEN 'FAIL' WHEN answers < 5 THEN 'THIN' ELSE 'PASS' END AS verdict, count(*) AS questions, CAST(sum(answers) AS BIGINT) AS answers FROM a GROUP BY 1""")
def question_scorecard(t: Tables):
    j = t.nation.join(t.customer, F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy(F.col("n_name").alias("question")).agg(F.count("c_custkey").alias("answers"), F.count(F.when(F.col("c_acctbal") < 0, 1)).alias("wrong"))
    return contracts.scorecard(j)


@query("K57,E29", """WITH p AS (SELECT o_orderkey, max(l_shipdate) AS due, CAST(sum(l_quantity) AS BIGINT) AS units FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F' GROUP BY 1)
    SELECT year(due) || '-Q' || quarter(due) AS handover, count(*) AS projects, CAST(sum(units) AS BIGINT) AS units FROM p GROUP BY 1""")
def handover_radar(t: Tables):
    """Open projects and their units by the quarter in which the last part is due."""
    p = t.orders.where("o_orderstatus <> 'F'").join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey").agg(F.max("l_shipdate").alias("due"), F.sum("l_quantity").cast("bigint").alias("units"))
    return p.groupBy(keys.quarter_label(F.col("due")).alias("handover")).agg(F.count("*").alias("projects"), F.sum("units").alias("units"))


@query("K62", """SELECT p_partkey, least(coalesce(CASE WHEN p_partkey % 3 = 0 THEN p_size * 3.0 END, CASE WHEN p_partkey % 3 = 1 THEN p_size * 3.2 END, 12.0), CASE WHEN p_partkey % 3 = 0 THEN 1e9 WHEN p_retailprice < 960 THEN 4.0 WHEN p_retailprice < 1300 THEN 10.0 ELSE 1e9 END)::DOUBLE AS height,
    CASE p_partkey % 3 WHEN 0 THEN 'surveyed' WHEN 1 THEN 'floors' ELSE 'default' END AS source FROM part""")
def heights_filled(t: Tables):
    """Heights by the order of their sources; what is estimated is capped on small footprints."""
    k, area = F.col("p_partkey"), F.col("p_retailprice")
    own, floors = F.when(k % 3 == 0, F.col("p_size") * 3.0), F.when(k % 3 == 1, F.col("p_size") * 3.2)
    height, source = contracts.filled([("surveyed", own), ("floors", floors), ("default", F.lit(12.0))])
    cap = F.when(source == "surveyed", 1e9).when(area < 960, 4.0).when(area < 1300, 10.0).otherwise(1e9)
    return t.part.select("p_partkey", F.least(height, cap).alias("height"), source.alias("source"))


@query("J03", """SELECT event_type, CASE WHEN count(*) > count(DISTINCT user_id) OR bool_or(event_type = 'view') THEN 'export' ELSE 'window' END AS series FROM events GROUP BY 1""")
def series_split(t: Tables):
    """A year-to-date extract or one with repeated keys is a series of its own."""
    e = t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("k"))
    return e.select("event_type", F.when((F.col("n") > F.col("k")) | (F.col("event_type") == "view"), "export").otherwise("window").alias("series"))


@query("E36", """WITH e AS (SELECT l_returnflag, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1) SELECT l_returnflag, n, true AS close FROM e""")
def approximate_against_exact(t: Tables):
    """The approximate distinct count beside the exact one: within three of its standard errors of five per cent."""
    e = t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_partkey").alias("n"), F.approx_count_distinct("l_partkey", 0.05).alias("about"))
    return e.select("l_returnflag", "n", (F.abs(F.col("about") - F.col("n")) <= 0.15 * F.col("n") + 1).alias("close"))


@query("I02,I03", r"""WITH c AS (SELECT c_custkey AS k, CASE c_custkey % 8 WHEN 0 THEN '683-' || (c_custkey % 10000) WHEN 1 THEN '683.' || (c_custkey % 10000) WHEN 2 THEN ' 6830' || (100 + c_custkey % 900) || '.00' WHEN 3 THEN '921-' || (10000 + c_custkey % 90000) WHEN 4 THEN '42381' || (10 + c_custkey % 90) || '.2' WHEN 5 THEN '0' WHEN 6 THEN '0-' || c_custkey ELSE '12-34' END AS s FROM customer),
    x AS (SELECT k, CASE k % 8 WHEN 0 THEN 6830000 + k % 10000 WHEN 1 THEN 6830000 + k % 10000 WHEN 2 THEN 6830000 + 100 + k % 900 WHEN 3 THEN 92100000 + 10000 + k % 90000 WHEN 7 THEN 120034 END AS parcel, CASE k % 8 WHEN 4 THEN 4238100 + 10 + k % 90 END AS sub FROM c)
    SELECT k, parcel, coalesce(parcel, sub) AS parent, CASE WHEN parcel >= 10000000 THEN parcel // 100000 ELSE parcel // 10000 END AS community FROM x""")
def parcel_keys(t: Tables):
    """Parcels in eight spellings: plain, dashed, dotted, five-digit plots, sub-parcels, zero."""
    k, text = F.col("c_custkey"), lambda x: x.cast("string")
    spelt = (
        F.when(k % 8 == 0, F.concat(F.lit("683-"), text(k % 10000))).when(k % 8 == 1, F.concat(F.lit("683."), text(k % 10000))).when(k % 8 == 2, F.concat(F.lit(" 6830"), text(100 + k % 900), F.lit(".00")))
        .when(k % 8 == 3, F.concat(F.lit("921-"), text(10000 + k % 90000))).when(k % 8 == 4, F.concat(F.lit("42381"), text(10 + k % 90), F.lit(".2"))).when(k % 8 == 5, "0").when(k % 8 == 6, F.concat(F.lit("0-"), text(k))).otherwise("12-34")
    )
    key = keys.parcel_key(spelt)
    return t.customer.select(k.alias("k"), key.alias("parcel"), keys.parent_parcel_key(spelt).alias("parent"), keys.community_of(key).alias("community"))




@query("E05,E06,K45", "SELECT l_returnflag, count(*) AS n, round(median(l_extendedprice), 2) AS median, round(quantile_cont(l_extendedprice, 0.9), 2) AS p90 FROM lineitem GROUP BY 1")
def interpolated_quantiles(t: Tables):
    """Interpolated quantiles of groups that hold a third of the rows, from counted and bucketed values."""
    q = stats.interpolated_quantiles(t.lineitem, "l_returnflag", "l_extendedprice", {"median": 0.5, "p90": 0.9})
    return q.select("l_returnflag", "n", F.round("median", 2).alias("median"), F.round("p90", 2).alias("p90"))


@query("K19", """WITH r AS (SELECT p_partkey AS b, p_brand AS project, p_partkey AS num, p_retailprice AS size FROM part), l AS (SELECT p_partkey AS a, p_brand AS project, CASE WHEN p_partkey % 3 = 0 THEN p_partkey + 700000 ELSE p_partkey END AS num, p_retailprice * CASE WHEN p_partkey % 5 = 0 THEN 1.5 ELSE 1.01 END AS size FROM part),
    e AS (SELECT a, min(b) AS b, count(*) AS n FROM l JOIN r USING (project, num) WHERE abs(l.size - r.size) <= 0.03 * r.size GROUP BY 1),
    t AS (SELECT a, min(b) AS b, count(*) AS n FROM l JOIN r ON l.project = r.project AND length(CAST(l.num AS VARCHAR)) >= 3 AND length(CAST(r.num AS VARCHAR)) >= 3 AND right(CAST(l.num AS VARCHAR), 3) = right(CAST(r.num AS VARCHAR), 3) WHERE abs(l.size - r.size) <= 0.03 * r.size AND a NOT IN (SELECT a FROM e) GROUP BY 1)
    SELECT l.a, CASE WHEN f.n = 1 THEN f.b END AS b, CASE WHEN f.n = 1 THEN f.m WHEN f.n > 1 THEN 'ambiguous' END AS method FROM l LEFT JOIN (SELECT *, 'number' AS m FROM e UNION ALL SELECT *, 'tail' FROM t) f ON f.a = l.a""")
def sheet_units(t: Tables):
    """Units of a developer's sheet in the register: by number and size, then by the number's tail."""
    k = F.col("p_partkey")
    number = F.concat(F.lit("Unit "), F.when(k % 3 == 0, k + 700000).otherwise(k).cast("string"))
    sheet = t.part.select(k.alias("a"), F.col("p_brand").alias("project"), number.alias("number"), (F.col("p_retailprice") * F.when(k % 5 == 0, 1.5).otherwise(1.01)).alias("size"))
    register = t.part.select(k.alias("b"), F.col("p_brand").alias("project"), k.cast("string").alias("number"), F.col("p_retailprice").alias("size"))
    return linkage.unit_matches(sheet, register)


@query("L05,B09,K08", "SELECT 'nations' AS job, n_nationkey AS key FROM nation")
def job_results(t: Tables):
    """Three jobs: one publishes, one is held by itself, one because its join rate fell; only the first leaves rows."""
    at = f"{lake.shared_dir(t.spark)}/jobs-{uuid4().hex}"
    rows_of = lambda df, k: df.select(F.col(k).alias("key"))
    jobs = {
        "nations": lambda: lake.JobResult({"nation": t.nation}, rows_of(t.nation, "n_nationkey"), 25, 25),
        "regions": lambda: lake.JobResult({"region": t.region}, rows_of(t.region, "r_regionkey"), 5, 5, "source refused"),
        "parts": lambda: lake.JobResult({}, rows_of(t.part, "p_partkey"), 100, 10),
    }
    said = lake.run_jobs(lake.Lake(t.spark, f"{at}/lake"), f"{at}/xref", jobs, {"parts": 0.9, "nations": 1.0})
    done = [name for name, what in said.items() if what == "published"]
    return t.spark.read.parquet(f"{at}/xref").select(F.col("job").cast("string").alias("job"), "key").where(F.col("job").isin(done))


@query("I22,L02", "SELECT o_orderkey, {'day': strftime(o_orderdate, '%Y-%m-%d'), 'price': o_totalprice}.price AS price, {'a': o_orderstatus, 'b': o_custkey}.b AS customer FROM orders")
def struct_literals(t: Tables):
    made = t.orders.select("o_orderkey", F.named_struct(F.lit("day"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("price"), F.col("o_totalprice")).alias("x"), F.struct(F.col("o_orderstatus").alias("a"), F.col("o_custkey").alias("b")).alias("y"))
    return made.select("o_orderkey", "x.price", F.col("y.b").alias("customer"))
