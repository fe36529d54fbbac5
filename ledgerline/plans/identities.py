"""Linkage with estimated weights, groups by evidence, clusters and names: the identity rules over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import anchors, fellegi, groups
from ..sources import lake
from ..streaming import holds, windows
from .registry import Tables, query

# ---- linkage

#: m of name levels (equal, at least 0.95, 0.88, 0.80 alike, less), of equal digits and of equal areas.
_M = {"name": [0.80, 0.10, 0.05, 0.03, 0.02], "digits": [0.97, 0.03], "area": [0.60, 0.40]}
_WANTED = 200_000


def _register(t: Tables) -> DataFrame:
    """Names of registered parts; the brand gives the digits, the type the area."""
    name = F.upper(F.regexp_replace(F.concat_ws(" ", "p_name", "p_type", "p_brand"), "#", " "))
    return t.part.select(F.col("p_partkey").alias("b"), name.alias("name2"), F.regexp_extract("p_brand", "([0-9]+)", 1).alias("digits2"), F.col("p_type").alias("area2"), F.split_part(name, F.lit(" "), F.lit(1)).alias("first"), F.col("p_type").alias("area"))


def _written(t: Tables) -> DataFrame:
    """The same names as another register writes them, for keys divisible by 20: a letter lost or doubled, a word more, another area."""
    k, r = F.col("b"), _register(t).where("b % 20 = 0")
    name = F.when(k % 3 == 0, F.concat(F.substring("name2", 1, 3), F.expr("substring(name2, 5)"))).when(k % 3 == 1, F.concat("name2", F.lit(" TOWER"))).otherwise(F.concat(F.substring("name2", 1, 6), F.expr("substring(name2, 6)")))
    area = F.when(k % 7 == 0, "ELSEWHERE").otherwise(F.col("area2"))
    return r.select(k.alias("a"), name.alias("name1"), F.when(k % 9 != 0, F.col("digits2")).alias("digits1"), area.alias("area1"), F.split_part(name, F.lit(" "), F.lit(1)).alias("first"), area.alias("area"))


def _comparisons() -> list[fellegi.Comparison]:
    levels = {"name": fellegi.name_level(F.col("name1"), F.col("name2")), "digits": fellegi.exact_level(F.col("digits1"), F.col("digits2")), "area": fellegi.exact_level(F.col("area1"), F.col("area2"))}
    return [fellegi.Comparison(n, x, _M[n]) for n, x in levels.items()]


def _trained(left: DataFrame, right: DataFrame) -> list[fellegi.Comparison]:
    cs = _comparisons()
    pairs = fellegi.random_pairs(left.drop("first", "area"), right.drop("first", "area"), "a", "b", _WANTED)
    for c, u in zip(cs, fellegi.estimate_u(fellegi.vectors(pairs, cs), cs)):
        c.u = u
    return cs


_SIDES = """r AS (SELECT p_partkey AS b, upper(replace(p_name || ' ' || p_type || ' ' || p_brand, '#', ' ')) AS n, regexp_extract(p_brand, '([0-9]+)', 1) AS d, p_type AS area FROM part),
    l AS (SELECT b AS a, CASE b % 3 WHEN 0 THEN substr(n, 1, 3) || substr(n, 5) WHEN 1 THEN n || ' TOWER' ELSE substr(n, 1, 6) || substr(n, 6) END AS n, CASE WHEN b % 9 <> 0 THEN d END AS d, CASE WHEN b % 7 = 0 THEN 'ELSEWHERE' ELSE area END AS area FROM r WHERE b % 20 = 0)"""
_LEVELS = """CASE WHEN l.n = r.n THEN 0 WHEN jaro_winkler_similarity(l.n, r.n) >= 0.95 THEN 1 WHEN jaro_winkler_similarity(l.n, r.n) >= 0.88 THEN 2 WHEN jaro_winkler_similarity(l.n, r.n) >= 0.80 THEN 3 ELSE 4 END AS name,
    CASE WHEN l.d = r.d THEN 0 WHEN l.d IS NOT NULL AND r.d IS NOT NULL THEN 1 END AS digits, CASE WHEN l.area = r.area THEN 0 ELSE 1 END AS area"""
_U = f"""{_SIDES}, size AS (SELECT greatest(1, ((SELECT count(*) FROM l) * (SELECT count(*) FROM r)) // {_WANTED}) AS k),
    random AS (SELECT {_LEVELS} FROM (SELECT l.*, ('0x' || left(md5('1-l-' || a), 8))::BIGINT % k AS bucket FROM l, size) l JOIN (SELECT r.*, ('0x' || left(md5('1-r-' || b), 8))::BIGINT % k AS bucket FROM r, size) r USING (bucket)),
    levels(comparison, level, m) AS (VALUES {', '.join(f"('{n}', {i}, {x})" for n, m in _M.items() for i, x in enumerate(m))}),
    counted AS (SELECT 'name' AS comparison, name AS level, count(*) AS n FROM random GROUP BY name UNION ALL SELECT 'digits', digits, count(*) FROM random WHERE digits IS NOT NULL GROUP BY digits UNION ALL SELECT 'area', area, count(*) FROM random GROUP BY area),
    u AS (SELECT v.comparison, v.level, v.m, coalesce(c.n, 0.5) / greatest(1, sum(coalesce(c.n, 0)) OVER (PARTITION BY v.comparison)) AS u FROM levels v LEFT JOIN counted c USING (comparison, level))"""


@query("K14", f"WITH {_U} SELECT comparison, level, round(u, 9) AS u, round(log2(m / u), 6) AS weight FROM u")
def estimated_weights(t: Tables):
    """How often random pairs reach each level, and what a level is worth."""
    import math

    cs = _trained(_written(t), _register(t))
    rows = [(c.name, i, round(u, 9), round(math.log2(m / u), 6)) for c in cs for i, (m, u) in enumerate(zip(c.m, c.u))]
    return t.spark.createDataFrame(rows, "comparison string, level int, u double, weight double")


@query("K14,K15,D31", f"""WITH {_U}, pairs AS (SELECT a, b, {_LEVELS} FROM l JOIN r ON split_part(l.n, ' ', 1) = split_part(r.n, ' ', 1) OR l.area = r.area),
    scored AS (SELECT a, b, coalesce(x.m / x.u, 1) * coalesce(y.m / y.u, 1) * coalesce(z.m / z.u, 1) / ((SELECT count(*) FROM r) - 1) AS odds FROM pairs p
        LEFT JOIN u x ON x.comparison = 'name' AND x.level = p.name LEFT JOIN u y ON y.comparison = 'digits' AND y.level = p.digits LEFT JOIN u z ON z.comparison = 'area' AND z.level = p.area),
    best AS (SELECT a, b, odds / (1 + odds) AS p FROM scored WHERE odds / (1 + odds) >= 0.05 QUALIFY row_number() OVER (PARTITION BY a ORDER BY round(odds / (1 + odds), 9) DESC, b) = 1)
    SELECT a, b, round(p, 6) AS p, CASE WHEN p >= 0.95 THEN 'accepted' WHEN p >= 0.5 THEN 'review' ELSE 'unmatched' END AS status FROM best""")
def estimated_links(t: Tables):
    """The best register row of each name that another register writes otherwise."""
    left, right = _written(t), _register(t)
    best = fellegi.best_links(left, right, _trained(left, right), ["name", "digits", "area"], ["first", "area"], 1 / right.count())
    return best.select("a", "b", F.round("p", 6).alias("p"), fellegi.decided(F.col("p")).alias("status"))


@query("K13", """WITH r AS (SELECT s_suppkey AS b, 'NAME ' || (s_suppkey % 60 + CASE WHEN s_suppkey % 60 >= 30 THEN 100 * (s_suppkey // 60) ELSE 0 END) AS name, 'A' || s_nationkey % 5 AS area FROM supplier),
    l AS (SELECT c_custkey AS a, 'NAME ' || c_custkey % 70 AS name, 'A' || c_nationkey % 5 AS area FROM customer),
    d AS (SELECT a, a % 100 AS b, CASE WHEN a % 82 = 0 THEN 'accept' ELSE 'reject' END AS verdict FROM l WHERE a % 41 = 0),
    n AS (SELECT name, count(*) AS n, min(b) AS b1, min(area) AS area1 FROM r GROUP BY 1), k AS (SELECT name, area, count(*) AS k, min(b) AS b2 FROM r GROUP BY 1, 2)
    SELECT l.a, CASE WHEN d.verdict = 'accept' THEN d.b WHEN d.a IS NOT NULL THEN NULL WHEN n.n > 1 AND k.k = 1 THEN b2 ELSE b1 END AS b,
        CASE WHEN d.verdict = 'accept' THEN 1.0 WHEN d.a IS NOT NULL THEN 0.0 WHEN n.n = 1 AND l.area = area1 THEN 1.0 WHEN n.n = 1 THEN 0.97 WHEN k.k = 1 THEN 0.99 WHEN n.n > 1 THEN 0.6 ELSE 0.0 END::DOUBLE AS score,
        CASE WHEN d.a IS NOT NULL THEN 'by hand' WHEN n.n = 1 AND l.area = area1 THEN 'name' WHEN n.n = 1 THEN 'name, other area' WHEN k.k = 1 THEN 'name and area' WHEN n.n > 1 THEN 'name of several' ELSE 'no candidate' END AS method,
        CASE WHEN d.verdict = 'accept' THEN 'accepted' WHEN d.a IS NOT NULL THEN 'rejected' WHEN n.n = 1 OR k.k = 1 THEN 'accepted' WHEN n.n > 1 THEN 'review' ELSE 'unmatched' END AS status
    FROM l LEFT JOIN d ON d.a = l.a LEFT JOIN n ON n.name = l.name LEFT JOIN k ON k.name = l.name AND k.area = l.area""")
def five_step_cascade(t: Tables):
    """Decisions by hand, names of one, names and areas, names of several; what is left has no candidate here."""
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    right = t.supplier.select(s.alias("b"), F.concat(F.lit("NAME "), (s % 60 + F.when(s % 60 >= 30, 100 * F.floor(s / 60)).otherwise(0)).cast("string")).alias("name"), F.concat(F.lit("A"), (F.col("s_nationkey") % 5).cast("string")).alias("area"))
    left = t.customer.select(c.alias("a"), F.concat(F.lit("NAME "), (c % 70).cast("string")).alias("name"), F.concat(F.lit("A"), (F.col("c_nationkey") % 5).cast("string")).alias("area"))
    decisions = left.where("a % 41 = 0").select("a", (F.col("a") % 100).alias("b"), F.when(F.col("a") % 82 == 0, "accept").otherwise("reject").alias("verdict"))
    none = lambda l, r: l.select("a", F.lit(None).cast("long").alias("b"), F.lit(None).cast("double").alias("p")).limit(0)
    return fellegi.cascade(left, right, decisions, none)


# ---- holds as a stream

_COUNTS = """r AS (SELECT event_type || '-' || user_id % 4 AS unit, CAST(ts AS DATE) AS day, CASE WHEN (dayofyear(ts) + user_id % 4) % 9 = 0 THEN count(*) // 4 ELSE count(*) END AS n FROM events GROUP BY event_type, user_id % 4, CAST(ts AS DATE), (dayofyear(ts) + user_id % 4) % 9)"""


@query("J12,F19", f"""WITH RECURSIVE {_COUNTS}, o AS (SELECT unit, day, n, row_number() OVER (PARTITION BY unit ORDER BY day) AS i FROM r),
    f AS (SELECT *, EXISTS (SELECT 1 FROM o x WHERE x.unit = o.unit AND x.i > o.i AND abs(x.n - o.n) <= 0.25 * greatest(o.n, 1)) AS again FROM o),
    w(unit, day, n, i, accepted, held) AS (SELECT unit, day, n, i, CAST(NULL AS BIGINT), false FROM f WHERE i = 1
        UNION ALL SELECT f.unit, f.day, f.n, f.i, CASE WHEN w.held THEN w.accepted ELSE w.n END, coalesce(CASE WHEN w.held THEN w.accepted ELSE w.n END >= 10 AND f.n < 0.5 * CASE WHEN w.held THEN w.accepted ELSE w.n END AND NOT f.again, false) FROM w JOIN f ON f.unit = w.unit AND f.i = w.i + 1)
    SELECT unit, CAST(day AS VARCHAR) AS day, n, accepted, held FROM w""")
def stream_holds(t: Tables):
    """Daily counts of units through the stateful stream; the last reading of all lets the watermark pass the others."""
    k, day = F.col("user_id") % 4, F.to_date("ts")
    low = (F.dayofyear("ts") + k) % 9 == 0
    counts = t.events.groupBy(F.concat_ws("-", "event_type", k.cast("string")).alias("unit"), day.alias("day"), low.alias("low")).agg(F.count("*").alias("n"))
    readings = counts.select("unit", F.col("day").cast("timestamp").alias("at"), F.when(F.col("low"), F.floor(F.col("n") / 4)).otherwise(F.col("n")).cast("long").alias("n"))
    folder = f"{lake.shared_dir(t.spark)}/holds-{uuid.uuid4().hex}"
    readings.write.parquet(f"{folder}/in/readings")
    readings.groupBy(F.lit("").alias("unit")).agg((F.max("at") + F.expr("INTERVAL 1000 DAYS")).alias("at"), F.lit(0).cast("long").alias("n")).write.parquet(f"{folder}/in/z-end")
    kept, was = holds.STORE[0], t.spark.conf.get(holds.STORE[0], None)
    t.spark.conf.set(*holds.STORE)
    try:
        source = t.spark.readStream.schema(readings.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
        told = windows.drained(holds.stream(source), folder, "append")
    finally:
        t.spark.conf.unset(kept) if was is None else t.spark.conf.set(kept, was)
    return holds.latest(told).where("unit <> ''").select("unit", F.to_date("at").cast("string").alias("day"), "n", "accepted", "held")


# ---- groups by evidence

_GROUPS = """s AS (SELECT s_suppkey AS dev, s_nationkey AS nk, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey), c AS (SELECT count(*) AS k FROM supplier),
    developers AS (SELECT s.dev, CASE s.dev % 6 WHEN 0 THEN s.n_name || ' Estates' WHEN 1 THEN 'The ' || s.n_name || ' Fund' WHEN 2 THEN 'First ' || s.n_name || ' and ' || o.n_name ELSE 'Firm ' || s.dev END AS name FROM s JOIN nation o ON o.n_nationkey = (s.nk + 1) % 25),
    projects AS (SELECT p_partkey AS cid, dev, CASE WHEN p_partkey < k AND dev % 6 = 3 THEN 'Gardens of ' || n_name || ' ' || dev WHEN p_partkey % 7 = 0 THEN 'Twin ' || p_partkey % 30 ELSE 'Plot ' || p_partkey END AS name FROM part, c, s WHERE s.dev = p_partkey % k AND (s.dev % 6 <> 3 OR p_partkey < k)),
    seeds AS (SELECT DISTINCT n_name AS grp, p.name FROM projects p JOIN s ON s.dev = p.dev WHERE p.cid % 3 = 0 OR s.dev % 6 = 4 OR (s.dev % 6 = 3 AND s.dev % 4 < 3)
        UNION SELECT o.n_name, p.name FROM projects p JOIN s ON s.dev = p.dev JOIN nation o ON o.n_nationkey = (s.nk + 1) % 25 WHERE s.dev % 6 = 2 AND p.cid % 5 = 0),
    hand AS (SELECT n_name AS grp, dev, CASE WHEN dev % 2 = 1 THEN 'accepted' ELSE 'rejected' END AS verdict FROM s WHERE dev % 23 = 7)"""
_PADDED = "' ' || trim(regexp_replace(lower({0}), '[^a-z0-9]+', ' ', 'g')) || ' '"
_GROUPED = f"""{_GROUPS}, aliases AS (SELECT n_name AS grp, {_PADDED.format('n_name')} AS al FROM nation),
    named AS (SELECT grp, dev, bool_or(length(trim(al)) > length(replace(trim(al), ' ', '')) OR starts_with({_PADDED.format('name')}, al)) AS lead FROM developers, aliases WHERE contains({_PADDED.format('name')}, al) GROUP BY 1, 2),
    several AS (SELECT {_PADDED.format('name')} AS k, count(DISTINCT cid) AS n FROM projects GROUP BY 1),
    hits AS (SELECT z.grp, p.dev, p.cid, contains({_PADDED.format('z.name')}, a.al) AS brand FROM seeds z JOIN aliases a ON a.grp = z.grp JOIN several v ON v.k = {_PADDED.format('z.name')} JOIN projects p ON {_PADDED.format('p.name')} = v.k WHERE v.n = 1 OR contains({_PADDED.format('z.name')}, a.al)),
    folio AS (SELECT grp, dev, count(DISTINCT cid) AS b, count(DISTINCT cid) FILTER (brand) AS bb FROM hits GROUP BY 1, 2), owned AS (SELECT dev, count(DISTINCT cid) AS n FROM projects GROUP BY 1),
    tied AS (SELECT coalesce(n.grp, f.grp, h.grp) AS grp, coalesce(n.dev, f.dev, h.dev) AS dev, n.lead, coalesce(f.b, 0) AS b, coalesce(f.bb, 0) AS bb, h.verdict FROM named n FULL JOIN folio f ON f.grp = n.grp AND f.dev = n.dev FULL JOIN hand h ON h.grp = coalesce(n.grp, f.grp) AND h.dev = coalesce(n.dev, f.dev)),
    ruled AS (SELECT t.grp, t.dev, coalesce(b / n, 0) AS share, verdict, CASE WHEN lead AND b > 0 THEN 1 WHEN lead THEN 2 WHEN lead IS NOT NULL AND b > 0 THEN 3 WHEN b >= 2 AND coalesce(b / n, 0) >= 0.5 THEN 4 WHEN bb > 0 AND coalesce(b / n, 0) >= 0.5 THEN 5 WHEN lead IS NOT NULL THEN 6 WHEN b > 0 THEN 7 ELSE 8 END AS r FROM tied t LEFT JOIN owned o ON o.dev = t.dev),
    final AS (SELECT *, count(*) FILTER (verdict IS NULL AND r <= 5) OVER (PARTITION BY dev) AS claims FROM ruled)"""


@query("K18,K64", f"""WITH {_GROUPED} SELECT grp, dev, CASE WHEN verdict IS NOT NULL THEN 'hand' ELSE ['register name and portfolio', 'register name', 'brand inside the name and portfolio', 'portfolio', 'portfolio project with the brand', 'brand inside another name', 'portfolio, too few', 'hand only'][r] END
        || CASE WHEN verdict IS NULL AND r <= 5 AND claims > 1 THEN ', claimed by ' || claims || ' groups' ELSE '' END AS method, CASE WHEN verdict IS NOT NULL THEN 1.0 ELSE CASE r WHEN 1 THEN 1.0 WHEN 2 THEN 0.95 WHEN 3 THEN 0.9 WHEN 6 THEN 0.5 WHEN 8 THEN 0.0 ELSE round(share, 3) END END::DOUBLE AS score,
        CASE WHEN verdict IS NOT NULL THEN verdict WHEN r > 5 OR claims > 1 THEN 'review' ELSE 'accepted' END AS status, CASE WHEN verdict IS NOT NULL THEN 'hand' ELSE 'rule' END AS decided_by FROM final""")
def developer_groups(t: Tables):
    """Suppliers as developers of parts, tied to nations by name, portfolio and hand."""
    return groups.grouped(*_group_tables(t))


def _group_tables(t: Tables) -> tuple[DataFrame, ...]:
    """developers, aliases, seeds, projects and hand as in _GROUPS, join by join: projects and seeds are stored, else conditions on
    seeds move below the join of parts and suppliers, which then pairs them all."""
    n, k = t.supplier.count(), F.col("dev")
    s = lake.stored(t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).select(F.col("s_suppkey").alias("dev"), F.col("s_nationkey").alias("nk"), "n_name"))
    both = s.join(t.nation.select(F.col("n_nationkey").alias("after"), F.col("n_name").alias("other")), F.col("after") == (F.col("nk") + 1) % 25)
    text = lambda *xs: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in xs])
    nation, dev, cid = F.col("n_name"), k.cast("string"), F.col("cid").cast("string")
    firm = F.when(k % 6 == 0, text(nation, " Estates")).when(k % 6 == 1, text("The ", nation, " Fund")).when(k % 6 == 2, text("First ", nation, " and ", F.col("other"))).otherwise(text("Firm ", dev))
    parts = t.part.select(F.col("p_partkey").alias("cid"), (F.col("p_partkey") % F.nullif(F.lit(n), F.lit(0))).alias("dev"))
    made = parts.join(s, "dev").where((k % 6 != 3) | (F.col("cid") < n))
    title = F.when((F.col("cid") < n) & (k % 6 == 3), text("Gardens of ", nation, " ", dev)).when(F.col("cid") % 7 == 0, text("Twin ", (F.col("cid") % 30).cast("string"))).otherwise(text("Plot ", cid))
    projects = lake.stored(made.select("cid", "dev", title.alias("name")))
    own = projects.join(s, "dev").where((F.col("cid") % 3 == 0) | (k % 6 == 4) | ((k % 6 == 3) & (k % 4 < 3))).select(nation.alias("grp"), "name")
    seeds = lake.stored(own.union(projects.join(both, "dev").where((k % 6 == 2) & (F.col("cid") % 5 == 0)).select("other", "name")).distinct())
    hand = s.where("dev % 23 = 7").select(nation.alias("grp"), "dev", F.when(k % 2 == 1, "accepted").otherwise("rejected").alias("verdict"))
    return both.select("dev", firm.alias("name")), t.nation.select(nation.alias("grp"), nation.alias("alias")), seeds, projects, hand


@query("K67", f"""WITH {_GROUPED}, members AS (SELECT dev, min(grp) AS grp FROM final WHERE verdict = 'accepted' OR (verdict IS NULL AND r <= 5 AND claims = 1) GROUP BY dev HAVING count(*) = 1),
    sales AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 1 THEN o_custkey END AS cid, CASE o_orderkey % 5 WHEN 2 THEN 'PLOT ' || o_custkey WHEN 3 THEN n_name || ' Tower' WHEN 4 THEN 'Gardens of ' || n_name || ' ' || s.dev || ' phase 2' ELSE 'Twin ' || o_custkey % 30 END AS name
        FROM orders JOIN c ON true JOIN s ON s.dev = o_custkey % c.k),
    k AS (SELECT s.id, m.grp, 'key' AS route FROM sales s JOIN projects p ON p.cid = s.cid JOIN members m ON m.dev = p.dev),
    names AS (SELECT {_PADDED.format('name')} AS k, count(DISTINCT dev) AS n, min(dev) AS dev FROM projects GROUP BY 1),
    n AS (SELECT s.id, m.grp, 'name' AS route FROM sales s JOIN names ON names.k = {_PADDED.format('s.name')} AND n = 1 JOIN members m ON m.dev = names.dev WHERE s.id NOT IN (SELECT id FROM k)),
    rest AS (SELECT id, {_PADDED.format('name')} AS w FROM sales WHERE id NOT IN (SELECT id FROM k) AND {_PADDED.format('name')} NOT IN (SELECT k FROM names)),
    f AS (SELECT DISTINCT w, z.grp FROM (SELECT DISTINCT w FROM rest) r JOIN seeds z ON starts_with(w, {_PADDED.format('z.name')}) WHERE NOT EXISTS (SELECT 1 FROM aliases a WHERE a.grp <> z.grp AND contains(w, a.al))),
    p AS (SELECT w, min(grp) AS grp FROM f GROUP BY w HAVING count(*) = 1)
    SELECT s.id, coalesce(k.grp, n.grp, p.grp) AS grp, CASE WHEN k.id IS NOT NULL THEN 'key' WHEN n.id IS NOT NULL THEN 'name' WHEN p.w IS NOT NULL THEN 'portfolio' END AS route FROM sales s LEFT JOIN k ON k.id = s.id LEFT JOIN n ON n.id = s.id LEFT JOIN rest r ON r.id = s.id LEFT JOIN p ON p.w = r.w""")
def attributed_sales(t: Tables):
    """Orders as sales, given to nations by key, by name and by portfolio."""
    developers, aliases, seeds, projects, hand = _group_tables(t)
    members = groups.grouped(developers, aliases, seeds, projects, hand).where("status = 'accepted'").select("grp", "dev")
    kind, part, dev = F.col("o_orderkey") % 5, F.col("o_custkey"), F.col("s_suppkey")
    name = (
        F.when(kind == 2, F.concat(F.lit("PLOT "), part.cast("string"))).when(kind == 3, F.concat("n_name", F.lit(" Tower")))
        .when(kind == 4, F.concat(F.lit("Gardens of "), "n_name", F.lit(" "), dev.cast("string"), F.lit(" phase 2"))).otherwise(F.concat(F.lit("Twin "), (part % 30).cast("string")))
    )
    made = t.orders.join(t.supplier, part % t.supplier.count() == dev).join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
    sales = made.select(F.col("o_orderkey").alias("id"), F.when(kind == 1, part).alias("cid"), name.alias("name"))
    return groups.attributed(sales, members, projects, seeds, aliases)


@query("K30", None)
def anchored_adverts(t: Tables):
    """Lines as adverts without a building: buckets of a brand number, places of suppliers; tests replay the rule."""
    k = F.col("l_suppkey")
    adverts = t.lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item"), (F.col("l_partkey") % 25).alias("bucket"), F.col("l_shipdate").alias("at"), (F.col("l_quantity") * 30).alias("size"), F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_returnflag") == "A", "yes").when(F.col("l_returnflag") == "R", "no").alias("furnished"), (25 + (k * 91 % 1000) / 2000.0).alias("lat"), (55 + (k * 37 % 1000) / 1000.0).alias("lon"),
    )
    return anchors.clusters(adverts, lake.stored, geo=True)
