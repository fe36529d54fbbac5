"""Registers over time: versions, intervals, movements, flows, contracts, streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import keys
from ..operators import disclosure, gates, graphs, versions
from ..sources import lake
from ..streaming import windows as streams
from .registry import Tables, query

# three pulls of the orders: some rows change their status in pull 2, some vanish in pull 3
_PULLS = """pulls AS (SELECT o_orderkey AS k, p, CASE WHEN p >= 2 AND o_orderkey % 7 = 0 THEN o_orderstatus || 'x' ELSE o_orderstatus END AS status, o_totalprice AS price
    FROM orders, (VALUES (1), (2), (3)) v(p) WHERE NOT (p = 3 AND o_orderkey % 11 = 0) AND NOT (p = 1 AND o_orderkey % 13 = 0))"""
_VERSIONS = _PULLS + """, g AS (SELECT *, CASE WHEN lag(status) OVER w IS DISTINCT FROM status OR lag(p) OVER w IS DISTINCT FROM p - 1 THEN 1 ELSE 0 END AS new FROM pulls WINDOW w AS (PARTITION BY k ORDER BY p)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY k ORDER BY p) AS run FROM g),
    versions AS (SELECT k, status, price, min(p) AS recorded_from, CASE WHEN max(p) < 3 THEN max(p) + 1 END AS recorded_to FROM r GROUP BY k, run, status, price)"""


def _pulls(t: Tables):
    each = t.orders.select(F.col("o_orderkey").alias("k"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("p"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("price"))
    there = each.where(~((F.col("p") == 3) & (F.col("k") % 11 == 0)) & ~((F.col("p") == 1) & (F.col("k") % 13 == 0)))
    return there.select("k", "p", F.when((F.col("p") >= 2) & (F.col("k") % 7 == 0), F.concat("s", F.lit("x"))).otherwise(F.col("s")).alias("status"), "price")


def _versions(t: Tables):
    return versions.versions(_pulls(t), "k", ["status", "price"], "p")


@query("J02,J03,J07,I11", f"WITH {_VERSIONS} SELECT * FROM versions")
def register_versions(t: Tables):
    return _versions(t)


@query("J08,J09", f"WITH {_VERSIONS} SELECT k, status, price FROM versions WHERE recorded_from <= 2 AND (recorded_to IS NULL OR recorded_to > 2)")
def as_known_at(t: Tables):
    return versions.as_known_at(_versions(t), 2).select("k", "status", "price")


@query("J06", f"""WITH {_PULLS}, m AS (SELECT count(*) AS missing FROM (SELECT k FROM pulls WHERE p = 2 EXCEPT SELECT k FROM pulls WHERE p = 3)), n AS (SELECT count(*) AS open FROM pulls WHERE p = 2)
    SELECT missing, open, missing > greatest(50, 0.002 * open) AS held FROM m, n""")
def vanish_report(t: Tables):
    pulls = _pulls(t)
    open_, now = pulls.where("p = 2").select("k"), pulls.where("p = 3").select("k")
    missing = open_.join(now, "k", "left_anti").agg(F.count("*").alias("missing"))
    return missing.crossJoin(open_.agg(F.count("*").alias("open"))).withColumn("held", F.col("missing") > F.greatest(F.lit(50.0), F.col("open") * 0.002))


@query("J01,J16", """SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, arg_min(value, {'t': ts, 'k': event_id}) AS first_value, arg_max(value, {'t': ts, 'k': event_id}) AS last_value FROM events GROUP BY 1""")
def listing_master(t: Tables):
    """The master after two loads, each rolled up and upserted; what is loaded twice counts once."""
    load = lambda df: df.groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.min_by("value", F.struct("ts", "event_id")).alias("x"), F.max_by("value", F.struct("ts", "event_id")).alias("y"))
    cut = t.events.agg(F.percentile(F.unix_micros(F.col("ts").cast("timestamp")), 0.5).alias("cut"))
    e = t.events.crossJoin(F.broadcast(cut)).withColumn("late", F.unix_micros(F.col("ts").cast("timestamp")) > F.col("cut"))
    master = load(e.where("not late")).toDF("user_id", "first_seen", "last_seen", "first_value", "last_value")
    return lake.upsert(master, load(e.where("late")), "user_id", {"first_seen": "a", "first_value": "x"}, {"last_seen": "b", "last_value": "y"})


_READINGS = "readings AS (SELECT event_type AS g, user_id AS u, CAST(date_trunc('day', ts) AS DATE) AS d, round(max(value), 2) AS price FROM events GROUP BY 1, 2, 3)"


@query("J10,F20", f"""WITH {_READINGS}, s AS (SELECT *, CASE WHEN lag(price) OVER (PARTITION BY g, u ORDER BY d) <> price THEN 1 ELSE 0 END AS c FROM readings),
    n AS (SELECT g, d, lead(d) OVER (PARTITION BY g ORDER BY d) AS nx FROM (SELECT DISTINCT g, d FROM readings)),
    p AS (SELECT g, u, min(d) AS first_seen, max(d) AS last_seen, arg_min(price, d) AS first_price, arg_max(price, d) AS last_price, CAST(sum(c) AS BIGINT) AS price_changes, count(*) AS readings FROM s GROUP BY 1, 2)
    SELECT p.g, u, CAST(first_seen AS VARCHAR) AS first_seen, CAST(last_seen AS VARCHAR) AS last_seen, first_price, last_price, price_changes, readings, CAST(nx AS VARCHAR) AS left_after FROM p LEFT JOIN n ON n.g = p.g AND n.d = p.last_seen""")
def snapshot_intervals(t: Tables):
    readings = t.events.groupBy(F.col("event_type").alias("g"), F.col("user_id").alias("u"), F.to_date("ts").cast("string").alias("d")).agg(F.round(F.max("value"), 2).alias("price"))
    return versions.intervals(readings, "g", "u", "d", "price")


@query("J13,D28,D29", """WITH s AS (SELECT DISTINCT event_type AS g, strftime(ts, '%G-W%V') AS w, user_id AS u FROM events), w AS (SELECT g, w, lag(w) OVER (PARTITION BY g ORDER BY w) AS before FROM (SELECT DISTINCT g, w FROM s)),
    x AS (SELECT w.g, w.w, w.before, count(n.u) AS now, count(b.u) FILTER (WHERE n.u IS NOT NULL AND b.u IS NOT NULL) AS shared, count(b.u) AS was FROM w JOIN (SELECT DISTINCT g, u FROM s) k ON k.g = w.g
        LEFT JOIN s n ON n.g = w.g AND n.w = w.w AND n.u = k.u LEFT JOIN s b ON b.g = w.g AND b.w = w.before AND b.u = k.u WHERE before IS NOT NULL GROUP BY 1, 2, 3)
    SELECT g, w, before, now - shared AS taken_up, was - shared AS released FROM x WHERE shared > 0""")
def sheet_movements(t: Tables):
    s = t.events.select(F.col("event_type").alias("g"), keys.iso_week(F.col("ts")).alias("w"), F.col("user_id").alias("u")).distinct()
    weeks = s.select("g", "w").distinct()
    pairs = weeks.withColumn("before", F.lag("w").over(Window.partitionBy("g").orderBy("w"))).where("before is not null")
    now = pairs.join(s, ["g", "w"]).select("g", "w", "before", "u", F.lit(1).alias("n"), F.lit(0).alias("b"))
    was = pairs.join(s.select("g", F.col("w").alias("before"), "u"), ["g", "before"]).select("g", "w", "before", "u", F.lit(0).alias("n"), F.lit(1).alias("b"))
    units = now.unionAll(was).groupBy("g", "w", "before", "u").agg(F.max("n").alias("n"), F.max("b").alias("b"))
    out = units.groupBy("g", "w", "before").agg(F.count(F.when((F.col("n") == 1) & (F.col("b") == 0), 1)).alias("taken_up"), F.count(F.when((F.col("n") == 0) & (F.col("b") == 1), 1)).alias("released"), F.sum(F.col("n") * F.col("b")).alias("shared"))
    return out.where("shared > 0").drop("shared")


@query("J14,D10", """WITH b AS (SELECT nullif(c_nationkey, 3) AS k, c_mktsegment AS s, c_custkey % 10 AS m, count(*) AS was FROM customer WHERE c_custkey % 4 <> 0 AND c_custkey % 10 <= 6 GROUP BY 1, 2, 3),
    n AS (SELECT nullif(c_nationkey, 3) AS k, c_mktsegment AS s, c_custkey % 10 AS m, count(*) AS is_ FROM customer WHERE c_custkey % 5 <> 0 GROUP BY 1, 2, 3),
    f AS (SELECT coalesce(n.m, b.m) AS m, coalesce(was, 0) AS was, coalesce(is_, 0) AS is_ FROM b FULL JOIN n ON b.k IS NOT DISTINCT FROM n.k AND b.s = n.s AND b.m = n.m)
    SELECT CAST(coalesce(sum(is_) FILTER (WHERE m > 6), 0) AS BIGINT) AS arrivals, CAST(coalesce(sum(greatest(is_ - was, 0)) FILTER (WHERE m <= 6), 0) AS BIGINT) AS late_additions, CAST(coalesce(sum(greatest(was - is_, 0)) FILTER (WHERE m <= 6), 0) AS BIGINT) AS departures FROM f""")
def account_flows(t: Tables):
    c = t.customer.select(F.nullif("c_nationkey", F.lit(3)).alias("k"), F.col("c_mktsegment").alias("s"), (F.col("c_custkey") % 10).alias("m"), "c_custkey")
    return versions.flows(c.where("c_custkey % 4 <> 0 and m <= 6"), c.where("c_custkey % 5 <> 0"), ["k", "s"], "m", 6)


@query("J15", """WITH s AS (SELECT DISTINCT CAST(date_trunc('day', ts) AS DATE) AS d, user_id AS u FROM events), d AS (SELECT d, lag(d) OVER (ORDER BY d) AS b FROM (SELECT DISTINCT d FROM s))
    SELECT CAST(d.d AS VARCHAR) AS d, (SELECT count(*) FROM s x WHERE x.d = d.b AND NOT EXISTS (SELECT 1 FROM s y WHERE y.d = d.d AND y.u = x.u)) AS gone, (SELECT count(*) FROM s y WHERE y.d = d.d AND NOT EXISTS (SELECT 1 FROM s x WHERE x.d = d.b AND x.u = y.u)) AS fresh FROM d WHERE b IS NOT NULL""")
def delistings(t: Tables):
    s = t.events.select(F.to_date("ts").alias("d"), F.col("user_id").alias("u")).distinct()
    days = s.select("d").distinct().withColumn("b", F.lag("d").over(Window.orderBy("d"))).where("b is not null")  # one row a day
    now = s.join(F.broadcast(days), "d")
    was = s.select(F.col("d").alias("b"), "u").join(F.broadcast(days), "b")
    gone = was.join(now, ["d", "u"], "left_anti").groupBy("d").agg(F.count("*").alias("gone"))
    fresh = now.join(was, ["d", "u"], "left_anti").groupBy("d").agg(F.count("*").alias("fresh"))
    return days.join(gone, "d", "left").join(fresh, "d", "left").select(F.col("d").cast("string").alias("d"), F.coalesce("gone", F.lit(0)).alias("gone"), F.coalesce("fresh", F.lit(0)).alias("fresh"))


@query("J05,K02,F19", None)
def shrink_contract(t: Tables):
    loads = t.events.groupBy("event_type", F.to_date("ts").cast("string").alias("day")).agg(F.count("*").alias("n"))
    return versions.shrink_holds(loads, "day", "n")


@query("J18,I13", "SELECT strftime(o_orderdate, '%G-W%V') AS week, count(*) AS n, round(median(o_totalprice), 2) AS median FROM orders GROUP BY 1")
def weekly_series(t: Tables):
    return t.orders.groupBy(keys.iso_week(F.col("o_orderdate")).alias("week")).agg(F.count("*").alias("n"), F.round(F.median("o_totalprice"), 2).alias("median"))


@query("J18,I14,E29", "SELECT year(o_orderdate) || '-Q' || quarter(o_orderdate) AS q, count(*) AS n, strftime(min(o_orderdate), '%Y-%m') AS first_month FROM orders GROUP BY 1")
def quarterly_pipeline(t: Tables):
    return t.orders.groupBy(keys.quarter_label(F.col("o_orderdate")).alias("q")).agg(F.count("*").alias("n"), keys.month_label(F.min("o_orderdate")).alias("first_month"))


@query("J19,K50", """WITH m AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) AS m, o_custkey % 25 AS area FROM orders), l AS (SELECT max(m) - 1 AS last FROM m),
    s AS (SELECT area, count(*) FILTER (WHERE m > last - 6 AND m <= last) AS now, count(*) FILTER (WHERE m > last - 12 AND m <= last - 6) AS before FROM m, l GROUP BY 1), c AS (SELECT sum(now) / nullif(sum(before), 0) AS r FROM s)
    SELECT area, now, before, CASE WHEN now + before < 20 THEN NULL WHEN before = 0 OR now >= 1.25 * r * before THEN 'ahead' WHEN now <= 0.8 * r * before THEN 'behind' ELSE 'level' END AS band FROM s, c""")
def activity_bands(t: Tables):
    m = t.orders.select((F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("m"), (F.col("o_custkey") % 25).alias("area"))
    last = F.col("last")
    s = m.crossJoin(F.broadcast(m.agg((F.max("m") - 1).alias("last")))).groupBy("area").agg(F.count(F.when((F.col("m") > last - 6) & (F.col("m") <= last), 1)).alias("now"), F.count(F.when((F.col("m") > last - 12) & (F.col("m") <= last - 6), 1)).alias("before"))
    r = s.agg(F.try_divide(F.sum("now"), F.sum("before")).alias("r"))
    band = F.when(F.col("now") + F.col("before") < 20, None).when((F.col("before") == 0) | (F.col("now") >= 1.25 * F.col("r") * F.col("before")), "ahead").when(F.col("now") <= 0.8 * F.col("r") * F.col("before"), "behind").otherwise("level")
    return s.crossJoin(F.broadcast(r)).select("area", "now", "before", band.alias("band"))


@query("J20,J21,K51", """WITH x AS (SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders) SELECT CAST(d AS VARCHAR) AS window_end, count(*) AS n, round(sum(o_totalprice), 2) AS total, CAST(d - 1 AS VARCHAR) AS settling_after, true AS provisional
    FROM orders, x WHERE CAST(o_orderdate AS DATE) > d - 7 GROUP BY d""")
def provisional_claim(t: Tables):
    d = F.broadcast(t.orders.agg(F.max(F.to_date("o_orderdate")).alias("d")))
    return t.orders.crossJoin(d).where(F.to_date("o_orderdate") > F.date_sub("d", 7)).groupBy("d").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).select(F.col("d").cast("string").alias("window_end"), "n", "total", F.date_sub("d", 1).cast("string").alias("settling_after"), F.lit(True).alias("provisional"))


@query("K52", """WITH v AS (SELECT o_orderstatus AS s, round(sum(o_totalprice), 2) AS claim FROM orders GROUP BY 1), c AS (SELECT o_orderstatus AS s, round(sum(o_totalprice), 2) AS again FROM orders WHERE o_orderkey % 50 <> 0 GROUP BY 1)
    SELECT s, claim, again, abs(again - claim) > 0.01 * claim AS warn FROM v JOIN c USING (s)""")
def claims_crosscheck(t: Tables):
    total = lambda df, n: df.groupBy(F.col("o_orderstatus").alias("s")).agg(F.round(F.sum("o_totalprice"), 2).alias(n))
    both = total(t.orders, "claim").join(total(t.orders.where("o_orderkey % 50 <> 0"), "again"), "s")
    return both.withColumn("warn", F.abs(F.col("again") - F.col("claim")) > 0.01 * F.col("claim"))


@query("C01,C02,C04", """SELECT count(*) AS total, count(*) FILTER (WHERE NOT (l_quantity BETWEEN 1 AND 45 AND l_returnflag IN ('A', 'N', 'R') AND l_discount < 0.095)) AS dropped, avg(l_quantity) BETWEEN 10 AND 40 AS canary, 'lineitem' AS gate FROM lineitem""")
def sanity_gate(t: Tables):
    gate = gates.Gate("lineitem", F.col("l_quantity").between(1, 45) & F.col("l_returnflag").isin("A", "N", "R") & (F.col("l_discount") < 0.095), canary=F.avg("l_quantity").between(10, 40))
    return gate.report(t.lineitem)


_VOWELS = "length(regexp_replace({x}, '[^AEIOU]', '', 'g')) / nullif(length(regexp_replace({x}, '[^A-Z]', '', 'g')), 0) < 0.34"
_FILL = "length(w) >= 12 AND regexp_full_match(w, '[A-Z0-9]+') AND length(regexp_replace(w, '[^A-Z]', '', 'g')) >= 4 AND " + _VOWELS.format(x="w")


@query("K03,K04,I09,L01", f"""WITH d AS (SELECT upper(replace(unnest(regexp_split_to_array(coalesce(text, ''), '[ \t\r\n]+')), '.', '')) AS w FROM documents), s AS (SELECT count(*) AS rows, count(*) FILTER (WHERE {_FILL}) AS bad FROM d WHERE w <> '')
    SELECT rows, bad, CASE WHEN bad / rows >= 0.98 THEN 'fabricated' WHEN bad / rows <= 0.02 THEN 'clean' ELSE 'mixed' END AS verdict FROM s""")
def realness_gate(t: Tables):
    """All words of all texts."""
    # only a to z are raised: by upper() an ß would become two letters of filler
    text = F.translate(F.replace(F.coalesce("text", F.lit("")), F.lit("."), F.lit("")), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    words = t.documents.select(F.explode(F.split(text, "[ \t\r\n]+")).alias("w"))
    return gates.realness(words.where("w <> ''"), ["w"])


@query("K33", """WITH c AS (SELECT c_nationkey AS g, c_mktsegment AS i, count(*) AS n FROM customer GROUP BY 1, 2), f AS (SELECT g, CASE WHEN n < 8 THEN 'other' ELSE i END AS i, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY 1, 2) SELECT * FROM f WHERE n >= 8""")
def disclosure_floor(t: Tables):
    counts = t.customer.groupBy(F.col("c_nationkey").alias("g"), F.col("c_mktsegment").alias("i")).agg(F.count("*").alias("n"))
    return disclosure.fold_small(counts, ["g"], "i", "n", 8)


@query("K34", """WITH c AS (SELECT c_nationkey AS g, c_mktsegment AS i, count(*) AS n FROM customer GROUP BY 1, 2),
    h AS (SELECT *, sum(CASE WHEN n < 8 THEN n ELSE 0 END) OVER (PARTITION BY g) AS hidden, coalesce(sum(n) OVER (PARTITION BY g ORDER BY n, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS smaller FROM c)
    SELECT g, i, n FROM h WHERE n >= 8 AND (hidden = 0 OR smaller >= 8)""")
def residual_protection(t: Tables):
    counts = t.customer.groupBy(F.col("c_nationkey").alias("g"), F.col("c_mktsegment").alias("i")).agg(F.count("*").alias("n"))
    return disclosure.protect_residual(counts, "g", "i", "n", 8)


@query("K29", """WITH RECURSIVE e AS (SELECT DISTINCT c_custkey AS a, c_custkey + 7 * (c_custkey % 3) AS b FROM customer WHERE c_custkey % 3 <> 0), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    r(node, label) AS (SELECT a, a FROM u UNION SELECT u.b, r.label FROM r JOIN u ON u.a = r.node WHERE r.label <> u.b) SELECT node, min(least(label, node)) AS label FROM r GROUP BY 1""")
def connected_components(t: Tables):
    links = t.customer.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("a"), (F.col("c_custkey") + 7 * (F.col("c_custkey") % 3)).alias("b"))
    return graphs.components(links)


@query("D26,D27,K41", """WITH RECURSIVE p AS (SELECT p_partkey AS node, CASE WHEN p_partkey % 5 <> 0 THEN p_partkey // 2 END AS parent FROM part),
    w(node, here, g) AS (SELECT node, node, 0 FROM p UNION ALL SELECT w.node, p.parent, g + 1 FROM w JOIN p ON p.node = w.here WHERE p.parent IS NOT NULL AND g < 8), l AS (SELECT node, max(g) AS g, arg_max(here, g) AS root FROM w GROUP BY 1)
    SELECT node, CASE WHEN g < 8 THEN root END AS root, CASE WHEN g < 8 THEN CAST(g AS INTEGER) END AS generation, g >= 8 AS loop FROM l""")
def lineage(t: Tables):
    return graphs.lineage(t.part.select(F.col("p_partkey").alias("node"), F.when(F.col("p_partkey") % 5 != 0, F.floor(F.col("p_partkey") / 2)).alias("parent")))


@query("B03,B04,A21,A22,K10", "SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey <> 4")
def lake_time_travel(t: Tables):
    """Publishes the nations, then fewer of them, then the same again (no new snapshot), and reads the second snapshot."""
    import uuid

    store = lake.Lake(t.spark, f"{lake.shared_dir(t.spark)}/lake-{uuid.uuid4().hex}")
    store.publish({"nation": t.nation}, {"nation": ["n_nationkey"]})
    fewer = t.nation.where("n_regionkey <> 4")
    second = store.publish({"nation": fewer}, shrink=0.5)
    store.publish({"nation": fewer})
    return store.table("nation", version=second)


@query("J22,J18", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 2) AS v FROM events GROUP BY 1, 2")
def stream_tumbling(t: Tables):
    out = streams.drained(streams.tumbling(streams.stream(t.spark, f"{t.sf_dir}/events.parquet")), _folder(t), "complete")
    return out.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("v", 2).alias("v"))


@query("J01,J22", "SELECT user_id, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1")
def stream_deduplicated(t: Tables):
    out = streams.drained(streams.deduplicated(streams.stream(t.spark, f"{t.sf_dir}/events.parquet").select("user_id", "event_type", "ts"), ["user_id", "event_type"], "36500 days"), _folder(t), "append")
    return out.groupBy("user_id").agg(F.count("*").alias("kinds"))


def _folder(t: Tables) -> str:
    import uuid

    return f"{lake.shared_dir(t.spark)}/stream-{uuid.uuid4().hex}"


@query("J22", """WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS new FROM events), r AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS began, count(*) AS n FROM r GROUP BY user_id, k""")
def stream_sessions(t: Tables):
    """Sessions of users that end after twelve hours of quiet."""
    out = streams.drained(streams.sessions(streams.stream(t.spark, f"{t.sf_dir}/events.parquet").select("user_id", "ts"), "12 hours"), _folder(t), "complete")
    return out.select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("began"), "n")
