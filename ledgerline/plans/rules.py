"""Market rules over the given tables: best matches, net yields, lettings, claims, canonical values, sliding windows, real columns."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import keys
from ..operators import market
from ..sources import lake
from ..streaming import windows as streams
from .registry import Tables, query


@query("D06", """WITH l AS (SELECT o_orderkey AS a, o_custkey AS k, round(o_totalprice / 1000) AS price, o_orderkey % 97 * 0.7 AS size FROM orders WHERE o_orderkey % 2 = 0), r AS (SELECT o_orderkey AS b, o_custkey AS k, round(o_totalprice / 1000) AS price, o_orderkey % 89 * 0.7 AS size FROM orders WHERE o_orderkey % 2 = 1),
    p AS (SELECT a, b, 'price' AS by, 0 AS s, abs(l.price - r.price) AS d FROM l JOIN r ON l.k = r.k WHERE abs(l.price - r.price) <= 1 UNION ALL SELECT a, b, 'size', 1, abs(l.size - r.size) FROM l JOIN r ON l.k = r.k WHERE abs(l.size - r.size) <= 0.5)
    SELECT l.a, p.b, p.by FROM l LEFT JOIN (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY a ORDER BY s, d, b) = 1) p ON p.a = l.a""")
def best_in_key(t: Tables):
    """Of the other rows of a key, the one whose price is nearest, else whose size is."""
    k = F.col("o_orderkey")
    side = lambda rest, name, by: t.orders.where(k % 2 == rest).select(k.alias(name), F.col("o_custkey").alias("k"), F.round(F.col("o_totalprice") / 1000).alias("price"), (k % by * 0.7).alias("size"))
    return market.best_of(side(0, "a", 97), side(1, "b", 89), "k", [("price", 1.0), ("size", 0.5)])


_SALES = """sales AS (SELECT n.n_name AS label, CASE WHEN n.n_nationkey % 5 = 0 THEN NULL WHEN l_linenumber % 3 <> 0 THEN o.n_name ELSE n.n_name END AS area, l_extendedprice / l_quantity AS psf FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey JOIN {nation} n ON n.n_nationkey = s_nationkey JOIN {nation} o ON o.n_nationkey = (s_nationkey + 7) % 25),
    rents AS (SELECT n_name AS area, o_totalprice / (40000 + 60 * (c_custkey % 900)) * 20 AS psf FROM {orders} JOIN {customer} ON c_custkey = o_custkey JOIN {nation} ON n_nationkey = c_nationkey WHERE c_nationkey % 4 <> 1),
    alias AS (SELECT a.n_name AS label, b.n_name AS area FROM {nation} a JOIN {nation} b ON b.n_nationkey = (a.n_nationkey + 1) % 25), charges AS (SELECT n_name AS label, 10.0 + n_nationkey AS charge FROM {nation} WHERE n_nationkey % 2 = 0)"""
_NAMES = ("lineitem", "supplier", "nation", "orders", "customer")


@query("K36", f"""WITH {_SALES.format(**{n: n for n in _NAMES})}, r AS (SELECT area, count(*) AS n, median(psf) AS m FROM rents GROUP BY 1), s AS (SELECT area, count(*) AS n, median(psf) AS m FROM sales WHERE area IS NOT NULL GROUP BY 1),
    y AS (SELECT r.area, round(100 * r.m / s.m, 1) AS pct FROM r JOIN s ON s.area = r.area WHERE r.n >= 30 AND s.n >= 30 AND round(100 * r.m / s.m, 1) BETWEEN 1.5 AND 12),
    n AS (SELECT label, area, count(*) AS n FROM sales WHERE area IS NOT NULL GROUP BY 1, 2), top AS (SELECT label, area FROM (SELECT *, sum(n) OVER (PARTITION BY label) AS whole FROM n) WHERE 2 * n > whole),
    p AS (SELECT label, round(median(psf)) AS psf FROM sales GROUP BY 1)
    SELECT p.label, CASE WHEN y1.pct IS NOT NULL THEN top.area WHEN y2.pct IS NOT NULL THEN p.label WHEN y3.pct IS NOT NULL THEN alias.area END AS area, CASE WHEN y1.pct IS NOT NULL THEN 'register' WHEN y2.pct IS NOT NULL THEN 'area name' WHEN y3.pct IS NOT NULL THEN 'area alias' END AS route,
        coalesce(y1.pct, y2.pct, y3.pct) AS gross, round(coalesce(y1.pct, y2.pct, y3.pct) - 100 * coalesce(charge, 15.0) / psf, 1) AS net, charge IS NULL AS estimated
    FROM p LEFT JOIN top ON top.label = p.label LEFT JOIN alias ON alias.label = p.label LEFT JOIN y y1 ON y1.area = top.area LEFT JOIN y y2 ON y2.area = p.label LEFT JOIN y y3 ON y3.area = alias.area LEFT JOIN charges ON charges.label = p.label""")
def net_yields(t: Tables):
    """Yields of the area where most sales of a label are registered, gross and net of service charges."""
    tables = {n: getattr(t, n) for n in _NAMES}
    read = lambda name: t.spark.sql(f"WITH {_SALES} SELECT * FROM {name}", **tables)
    sales = read("sales")
    yields = market.area_yields(read("rents"), sales.select("area", "psf"))
    return market.card_yields(sales, yields, read("alias"), read("charges").withColumn("charge", F.col("charge").cast("double")), 15.0)


_LETTINGS = """lettings AS (SELECT CAST(o_orderdate AS DATE) AS day, 'A' || o_custkey % 8 AS area, CASE WHEN o_custkey % 6 = 0 THEN NULL ELSE 'P' || o_custkey % 40 END AS project, CASE WHEN o_custkey % 40 < 12 THEN 'office' ELSE 'flat' END AS kind, CASE WHEN o_orderkey % 3 = 0 THEN 'Renewed' ELSE 'New' END AS reg_type, o_orderkey // 2 AS contract,
    CASE WHEN o_custkey % 40 < 5 THEN o_totalprice / 50 ELSE o_totalprice END AS rent FROM {orders}), districts(area, district) AS (VALUES ('A0', 'north'), ('A0', 'south'), ('A1', 'south'), ('A2', 'east'), ('A2', 'west'), ('A3', 'west'))"""
_DESK = """as_of AS (SELECT max(day) - 40 AS d FROM lettings), desk AS (SELECT project FROM lettings, as_of WHERE kind = 'office' AND reg_type = 'New' AND day BETWEEN d - 30 AND d AND project IS NOT NULL GROUP BY 1 HAVING count(DISTINCT contract) >= 20 AND median(rent) < 25000),
    told AS (SELECT day, coalesce(x.district, '') AS district, l.area, project, kind, reg_type, count(DISTINCT contract) AS contracts, CASE WHEN count(DISTINCT contract) >= 3 THEN round(median(rent)) END AS median, kind = 'office' AND project IS NOT NULL AND project IN (SELECT project FROM desk) AS desk
        FROM lettings l JOIN as_of ON day BETWEEN d - 400 AND d + 31 LEFT JOIN districts x ON x.area = l.area GROUP BY day, x.district, l.area, project, kind, reg_type)"""


def _activity(t: Tables):
    lettings = t.spark.sql(f"WITH {_LETTINGS.replace('//', 'DIV')} SELECT * FROM lettings", orders=t.orders)
    districts = t.spark.sql(f"WITH {_LETTINGS.replace('//', 'DIV')} SELECT * FROM districts", orders=t.orders)
    as_of = F.date_sub(F.lit(lettings.agg(F.max("day")).first()[0]), 40)
    return market.letting_activity(lettings, districts, as_of)


@query("K49,J20", f"WITH {_LETTINGS.format(orders='orders')}, {_DESK} SELECT CAST(day AS VARCHAR) AS day, district, area, project, kind, reg_type, contracts, median, desk FROM told")
def letting_days(t: Tables):
    """Lettings by day and place, with licences of desks told apart; medians of few contracts are withheld."""
    return _activity(t)[0].withColumn("day", F.col("day").cast("string"))


@query("K49", f"WITH {_LETTINGS.format(orders='orders')}, {_DESK} SELECT CAST(day AS VARCHAR) AS day, t.area, CAST(sum(contracts) AS BIGINT) AS contracts FROM told t LEFT JOIN (SELECT area, min(district) AS district FROM districts GROUP BY 1) f ON f.area = t.area WHERE t.district = coalesce(f.district, '') GROUP BY 1, 2")
def letting_days_once(t: Tables):
    """The same by area, each area counted once however many districts it lies in."""
    return _activity(t)[1].withColumn("day", F.col("day").cast("string"))


_CLAIM = "SELECT '{m}' AS metric, {s} AS scope, CAST({v} AS DOUBLE) AS value, '{u}' AS unit, count(*) AS sample, min(CAST({d} AS DATE)) AS a, max(CAST({d} AS DATE)) AS b FROM {f} GROUP BY {s} HAVING count(*) >= {n}"
_TX = "(SELECT o_orderdate, o_totalprice, n_name FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"


@query("K51,J21", f"""WITH c AS ({_CLAIM.format(m='sales.count', s="'city'", v='count(*)', u='sales', d='o_orderdate', f=_TX, n=1)} UNION ALL {_CLAIM.format(m='sales.count', s='n_name', v='count(*)', u='sales', d='o_orderdate', f=_TX, n=1)}
    UNION ALL {_CLAIM.format(m='sales.mean', s="'city'", v='round(avg(o_totalprice), 2)', u='AED', d='o_orderdate', f=_TX, n=40)} UNION ALL {_CLAIM.format(m='sales.mean', s='n_name', v='round(avg(o_totalprice), 2)', u='AED', d='o_orderdate', f=_TX, n=40)}
    UNION ALL {_CLAIM.format(m='lines.returned_pct', s="'city'", v="round(100.0 * count(*) FILTER (l_returnflag = 'R') / count(*), 2)", u='per cent', d='l_shipdate', f='lineitem', n=1)}), x AS (SELECT greatest((SELECT max(CAST(o_orderdate AS DATE)) FROM orders), (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)) AS d)
    SELECT metric, scope, value, unit, sample, CAST(a AS VARCHAR) AS window_from, CAST(b AS VARCHAR) AS window_to, b > d - 30 AS provisional FROM c, x""")
def registered_claims(t: Tables):
    """Registered metrics as claims for the city and for areas, each with its sample and window."""
    sales = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).withColumn("at", F.col("o_orderdate"))
    lines = t.lineitem.withColumn("at", F.col("l_shipdate"))
    metrics = [
        market.Metric("sales.count", "sales", F.count("*"), "sales", "n_name"), market.Metric("sales.mean", "sales", F.round(F.avg("o_totalprice"), 2), "AED", "n_name", 40),
        market.Metric("lines.returned_pct", "lines", F.round(100.0 * F.count(F.when(F.col("l_returnflag") == "R", 1)) / F.count("*"), 2), "per cent"),
    ]
    out = market.claims(metrics, {"sales": sales, "lines": lines}, "at", "city", 30)
    return out.withColumns({c: F.col(c).cast("string") for c in ("window_from", "window_to")})


_EVIDENCE = """e AS (SELECT 'B' || l_suppkey AS entity, CASE l_linenumber % 2 WHEN 0 THEN 'name' ELSE 'floors' END AS attribute, CASE WHEN l_linenumber = 7 THEN NULL ELSE 'v' || l_partkey % 4 END AS value, CASE l_orderkey % 5 WHEN 0 THEN 'register' WHEN 1 THEN 'survey' WHEN 2 THEN 'map' ELSE 'advert' END AS source, CASE l_partkey % 3 WHEN 0 THEN 'STRUCTURAL' ELSE 'OFFICIAL' END AS role FROM {lineitem} WHERE l_orderkey % 5 > l_suppkey % 4)"""
_PLACES = "places(attribute, source, place) AS (VALUES ('name', 'register', 0), ('name', 'survey', 1), ('name', 'map', 2), ('floors', 'survey', 0), ('floors', 'register', 1))"


def _canonical(t: Tables):
    e = t.spark.sql(f"WITH {_EVIDENCE} SELECT * FROM e", lineitem=t.lineitem)
    return market.canonical_values(e, {"name": ["register", "survey", "map"], "floors": ["survey", "register"]}, {"STRUCTURAL": "OFFICIAL"})


@query("K24", f"""WITH {_EVIDENCE.format(lineitem='lineitem')}, {_PLACES} SELECT entity, attribute, value, source, role FROM (SELECT entity, attribute, value, source, role, place, count(*) AS n FROM e JOIN places USING (attribute, source) WHERE value IS NOT NULL GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY entity, attribute ORDER BY role = 'STRUCTURAL', place, n DESC, value, role) = 1""")
def canonical_by_authority(t: Tables):
    """What stands of each attribute by its own ranking of sources; structural names give way to official ones."""
    return _canonical(t)[0]


@query("K24", f"""WITH {_EVIDENCE.format(lineitem='lineitem')}, {_PLACES} SELECT entity, attribute, array_to_string(list_sort(list(DISTINCT value)), ',') AS given, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources FROM e JOIN places USING (attribute, source) WHERE value IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT value) > 1""")
def conflicting_values(t: Tables):
    """Attributes on which the ranked sources differ."""
    return _canonical(t)[1].select("entity", "attribute", F.array_join("values", ",").alias("given"), F.array_join("sources", ",").alias("sources"))


@query("J22", """WITH w AS (SELECT event_type, CAST(ts AS DATE) - CAST(i AS INTEGER) AS first, value FROM events, range(7) r(i)) SELECT event_type, CAST(first AS VARCHAR) AS first, count(*) AS n, round(sum(value), 2) AS v FROM w GROUP BY 1, 2""")
def stream_sliding(t: Tables):
    """Weeks that begin on every day, from the stream: each event falls into seven."""
    out = streams.drained(streams.sliding(streams.stream(t.spark, f"{t.sf_dir}/events.parquet")), f"{lake.shared_dir(t.spark)}/stream-{uuid.uuid4().hex}", "complete")
    return out.select("event_type", F.date_format("window.start", "yyyy-MM-dd").alias("first"), "n", F.round("v", 2).alias("v"))


_FAKE = "regexp_full_match({0}, '[A-Z]{{3,8}}') AND length(regexp_replace({0}, '[^AEIOU]', '', 'g')) / nullif(length(regexp_replace({0}, '[^A-Z]', '', 'g')), 0) < 0.34 AND {0} NOT IN ('JAN', 'FEB', 'MAR', 'APR', 'MAY', 'JUN', 'JUL', 'AUG', 'SEP', 'SEPT', 'OCT', 'NOV', 'DEC', 'MIGD', 'MIG', 'CLOSED')"
_COLUMNS = {"kind": "p_type", "made_up": "translate(p_type, 'AEIOUY', 'XZKXQX')", "mixed": "CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE translate(p_type, 'AEIOUY', 'XZKXQX') END"}


@query("K03,L01,I09", "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS name, count(x) AS n, count(*) FILTER ({_FAKE.format('x')}) AS fake, count(*) FILTER ({_FAKE.format('x')}) >= 0.6 * count(x) AS refused FROM (SELECT {x} AS x FROM part)" for n, x in _COLUMNS.items()) + ") v")
def fabricated_columns(t: Tables):
    """Columns most of whose values are words without vowels are refused as a whole."""
    df = t.part.select(*[F.expr(x).alias(n) for n, x in _COLUMNS.items()])
    long_ = df.unpivot([], list(_COLUMNS), "name", "x")
    fake = F.count(F.when(keys.is_word_fake(F.col("x")), 1))
    return long_.groupBy("name").agg(F.count("x").alias("n"), fake.alias("fake"), (fake >= 0.6 * F.count("x")).alias("refused"))
