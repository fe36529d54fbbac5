"""Places: unions by authority, distances to edges, polygons that files carry, over points and rings of the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import space
from ..sources import lake, readers
from .registry import Tables, query

_LON, _LAT = "55 + ({0} * 37 % 1000) / 1000.0", "25 + ({0} * 91 % 1000) / 2000.0"
_METRES = "sqrt(power((l.lon - r.lon) * 111320.0 * cos(radians(l.lat)), 2) + power((l.lat - r.lat) * 110574.0, 2))"
_RADIUS = 900


def _points_sql(spark: bool) -> str:
    """Suppliers are the register, customers two other sources; figures come from the keys."""
    c, s = ("{customer}", "{supplier}") if spark else ("customer", "supplier")
    return f"""SELECT 'R' || s_suppkey AS p, 1 AS rank, {_LON.format('s_suppkey')} AS lon, {_LAT.format('s_suppkey')} AS lat, s_suppkey % 3 AS plugs, CAST(NULL AS DOUBLE) AS kw FROM {s}
    UNION ALL SELECT 'C' || c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 3 END, {_LON.format('(c_custkey * 3 + 1)')}, {_LAT.format('(c_custkey * 3 + 1)')}, c_custkey % 4, CASE WHEN c_custkey % 5 = 0 THEN 50.0 WHEN c_custkey % 5 = 1 THEN 22.0 END FROM {c}"""


def _sites_sql(spark: bool) -> str:
    s = "{supplier}" if spark else "supplier"
    return f"SELECT {_LON.format('(s_suppkey * 7 + 2)')} AS lon, {_LAT.format('(s_suppkey * 7 + 2)')} AS lat, 100.0 + s_suppkey % 5 * 50 AS site_kw, 4 + s_suppkey % 9 AS stalls FROM {s}"


_KIND = "CASE WHEN kw >= 100 THEN 'ultra fast' WHEN kw >= 43 THEN 'fast' WHEN plugs >= 2 THEN 'double' ELSE 'single' END"


@query("K48", f"""WITH a AS ({_points_sql(False)}), sites AS ({_sites_sql(False)}), k1 AS (SELECT * FROM a WHERE rank = 1),
    k2 AS (SELECT * FROM a l WHERE rank = 2 AND NOT EXISTS (SELECT 1 FROM k1 r WHERE {_METRES} < {_RADIUS})),
    k3 AS (SELECT * FROM a l WHERE rank = 3 AND NOT EXISTS (SELECT 1 FROM k1 r WHERE {_METRES} < {_RADIUS}) AND NOT EXISTS (SELECT 1 FROM k2 r WHERE {_METRES} < {_RADIUS})),
    l AS (SELECT * FROM k1 UNION ALL SELECT * FROM k2 UNION ALL SELECT * FROM k3), e AS (SELECT l.*, (SELECT max(site_kw) FROM sites r WHERE {_METRES} < {_RADIUS}) AS site_kw, (SELECT max(stalls) FROM sites r WHERE {_METRES} < {_RADIUS}) AS stalls FROM l),
    f AS (SELECT p, rank, nullif(greatest(coalesce(plugs, 0), coalesce(stalls, 0)), 0) AS plugs, nullif(greatest(coalesce(kw, 0), coalesce(site_kw, 0)), 0) AS kw, stalls IS NOT NULL AS enriched FROM e) SELECT *, {_KIND} AS kind FROM f""")
def charge_points(t: Tables):
    """Three sources as one: a point gives way to a kept one of higher authority near it; what stays takes the largest figures of
    the sites around it."""
    points, sites = t.spark.sql(_points_sql(True), supplier=t.supplier, customer=t.customer), t.spark.sql(_sites_sql(True), supplier=t.supplier)
    points = points.withColumns({c: F.col(c).cast("double") for c in ("lon", "lat")})
    kept = space.largest_within(space.authority_kept(points, _RADIUS), sites.withColumns({c: F.col(c).cast("double") for c in ("lon", "lat", "site_kw")}), ["site_kw", "stalls"], _RADIUS)
    most = lambda a, b, zero: F.nullif(F.greatest(F.coalesce(a, zero), F.coalesce(b, zero)), zero)
    out = kept.select("p", "rank", most("plugs", "stalls", F.lit(0).cast("bigint")).alias("plugs"), most("kw", "site_kw", F.lit(0.0)).alias("kw"), F.col("stalls").isNotNull().alias("enriched"))
    return out.withColumn("kind", F.expr(_KIND))


# long rings of six corners about each supplier; the wider the key's rest, the longer the edges
_CORNERS = [(1.0, 0.0), (0.5, 0.9), (-0.5, 0.9), (-1.0, 0.0), (-0.5, -0.9), (0.5, -0.9)]
_RINGS = "SELECT s_suppkey AS poly, v, {lon} + dx * (0.004 + s_suppkey % 7 * 0.004) AS lon, {lat} + dy * (0.002 + s_suppkey % 5 * 0.001) AS lat FROM {{supplier}}, (VALUES {corners}) k(v, dx, dy)".format(
    lon=_LON.format("s_suppkey"), lat=_LAT.format("s_suppkey"), corners=", ".join(f"({i}, CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))" for i, (x, y) in enumerate(_CORNERS))
)
_V = f"v AS ({_RINGS.replace('{supplier}', 'supplier')}), e AS (SELECT poly, lon AS x1, lat AS y1, coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS x2, coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS y2 FROM v WINDOW w AS (PARTITION BY poly ORDER BY v))"


def _rings(t: Tables) -> DataFrame:
    return t.spark.sql(_RINGS, supplier=t.supplier).select("poly", "v", F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat"))


@query("I17,D18", f"""WITH {_V}, l AS (SELECT c_custkey AS p, {_LON.format('(c_custkey * 11 + 3)')} AS lon, {_LAT.format('(c_custkey * 11 + 3)')} AS lat FROM customer),
    i AS (SELECT p, poly FROM l, e WHERE (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY 1, 2 HAVING count(*) % 2 = 1),
    u AS (SELECT p, poly, (x1 - lon) * k AS ax, (y1 - lat) * 110574.0 AS ay, (x2 - x1) * k AS ux, (y2 - y1) * 110574.0 AS uy FROM (SELECT *, cos(radians(lat)) * 111320.0 AS k FROM l, e)),
    s AS (SELECT *, greatest(0.0, least(1.0, -(ax * ux + ay * uy) / (ux * ux + uy * uy))) AS t FROM u), d AS (SELECT p, poly, min(sqrt(power(ax + t * ux, 2) + power(ay + t * uy, 2))) AS m FROM s GROUP BY 1, 2)
    SELECT d.p, d.poly, CASE WHEN i.p IS NULL THEN round(m, 1) ELSE 0.0 END AS metres FROM d LEFT JOIN i ON i.p = d.p AND i.poly = d.poly WHERE m <= 800 OR i.p IS NOT NULL""")
def edge_distances(t: Tables):
    """How far points are from the outlines of footprints, edges and not corners alone."""
    k = F.col("c_custkey") * 11 + 3
    points = t.customer.select(F.col("c_custkey").alias("p"), (55 + (k * 37 % 1000) / 1000.0).cast("double").alias("lon"), (25 + (k * 91 % 1000) / 2000.0).cast("double").alias("lat"))
    return space.edge_distance(points, _rings(t), 800).withColumn("metres", F.round("metres", 1))


@query("K63,K23", f"""WITH {_V}, c AS (SELECT poly, avg(lon) AS lon, avg(lat) AS lat FROM v GROUP BY 1), s AS (SELECT poly, abs(sum(x1 * y2 - x2 * y1)) / 2 AS deg FROM e GROUP BY 1)
    SELECT poly, round(deg * 111320.0 * 110574.0 * cos(radians(lat)) / 1e6, 3) AS square_km, 'P-' || left(sha1(printf('%.6f,%.6f', lon, lat)), 10) AS id FROM c JOIN s USING (poly)""")
def footprint_ids(t: Tables):
    """The area of each footprint and the id that its centroid gives."""
    m = space.ring_measures(_rings(t))
    return m.select("poly", F.round(F.col("square_metres") / 1e6, 3).alias("square_km"), geo.centroid_id(F.lit("P"), F.col("lon"), F.col("lat")).alias("id"))


def _in_files(t: Tables) -> DataFrame:
    """The rings of each nation's suppliers, one row a footprint."""
    v = _rings(t).join(t.supplier.select(F.col("s_suppkey").alias("poly"), F.col("s_nationkey").alias("file")), "poly")
    return v.groupBy("file", "poly").agg(F.array_sort(F.collect_list(F.struct("v", "lon", "lat"))).alias("ring"))


@query("A13", f"WITH {_V} SELECT CAST(poly AS VARCHAR) AS name, count(*) AS n, round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat FROM v GROUP BY 1")
def kml_footprints(t: Tables):
    """Footprints written as placemarks, many to a file, and read back."""
    at = f"{lake.shared_dir(t.spark)}/kml-{uuid.uuid4().hex}"
    points = F.array_join(F.transform("ring", lambda p: F.concat_ws(",", p["lon"].cast("string"), p["lat"].cast("string"), F.lit("0"))), "\n ")
    _in_files(t).select(F.concat(F.lit("<Placemark><name>"), F.col("poly").cast("string"), F.lit("</name>\n<coordinates>\n "), points, F.lit("\n</coordinates></Placemark>")).alias("value")).write.text(at)
    each = readers.kml_rings(t.spark, at).select("name", F.explode("ring").alias("p"))
    return each.groupBy("name").agg(F.count("*").alias("n"), F.round(F.avg("p.lon"), 6).alias("lon"), F.round(F.avg("p.lat"), 6).alias("lat"))


@query("A14", f"WITH {_V} SELECT CAST(poly AS VARCHAR) AS comm, CAST(v AS INTEGER) AS v, round(lon, 6) AS lon, round(lat, 6) AS lat FROM v")
def geojson_footprints(t: Tables):
    """Footprints written as feature collections, a file a nation, and read back as vertices."""
    at = f"{lake.shared_dir(t.spark)}/geojson-{uuid.uuid4().hex}"
    ring = F.transform("ring", lambda p: F.array(p["lon"], p["lat"]))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("poly").cast("string").alias("comm")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    files = _in_files(t).groupBy("file").agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features"))).alias("value"))
    files.write.partitionBy("file").text(at)
    return readers.geojson_vertices(t.spark, at, "comm").select("comm", "v", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))
