"""Sources and sinks: each query lands tables in files of its own in the shared folder and reads them through the operator."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import lake, readers
from .market import _HEX, _PT, _points
from .registry import Tables, query


def _new(t: Tables, name: str) -> str:
    return f"{lake.shared_dir(t.spark)}/{name}-{uuid4().hex}"


def _csv(df: DataFrame, path: str, **options: str) -> str:
    df.write.options(header="true", **options).csv(path)
    return path


@query("A01,A05,A24", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 2 = 1 THEN CAST(c_nationkey AS VARCHAR) END AS c_nationkey FROM customer")
def text_parts(t: Tables):
    """A plain part whose header begins with a byte-order mark and a gzip part with other columns, all as text."""
    at, c = _new(t, "parts"), t.customer
    plain = _csv(c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("﻿c_custkey"), "c_name", "c_mktsegment"), f"{at}/plain")
    packed = _csv(c.where("c_custkey % 2 = 1").select("c_custkey", "c_name", "c_nationkey"), f"{at}/packed", compression="gzip")
    return readers.text_csv(t.spark, plain, packed).select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")


@query("A02", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders WHERE o_orderkey % 3 <> 0")
def newest_extract(t: Tables):
    """No extract of this run is there, so the newest dated one is read, and not the later year-to-date one."""
    at, o = _new(t, "extracts"), t.orders.select("o_orderkey")
    _csv(o.where("o_orderkey % 5 = 0"), f"{at}/orders_2024-01-01")
    _csv(o.where("o_orderkey % 3 <> 0"), f"{at}/orders_2024-02-01")
    _csv(o, f"{at}/orders_ytd_2024-03-01")
    return readers.text_csv(t.spark, readers.newest_stamp(t.spark, at, "orders", "2024-04-01"))


@query("A03", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand FROM part")
def manifest_extract(t: Tables):
    """All parts of the newest finished extract; a later one has not finished."""
    at, p = _new(t, "manifest"), t.part.select("p_partkey", "p_brand")
    for k in range(3):
        _csv(p.where(f"p_partkey % 3 = {k}"), f"{at}/e2/part-{k}")
    _csv(p.where("p_partkey < 5"), f"{at}/e1/part-0")
    manifest = [("e1", "ok", ["part-0"]), ("e2", "ok", ["part-0", "part-1", "part-2"]), ("e3", "running", ["part-0"])]
    return readers.text_csv(t.spark, *readers.finished_parts(t.spark, at, manifest))


@query("A04", "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber FROM lineitem WHERE l_linenumber <= 3")
def daily_extract(t: Tables):
    """The newest day is too small, so the fuller variant of the day before is read."""
    at, l = _new(t, "daily"), t.lineitem.select("l_orderkey", "l_linenumber")
    _csv(l.where("l_linenumber = 1"), f"{at}/rents_2024-02-01")
    _csv(l.where("l_linenumber <= 3"), f"{at}/rents_2024-02-01_full")
    _csv(l.where("l_orderkey = 1"), f"{at}/rents_2024-02-02")
    return readers.text_csv(t.spark, readers.fullest_daily(t.spark, at, "rents", 100))


@query("A06,A07", "SELECT n_nationkey AS key, n_name AS place_name, r_name AS place_region_name FROM nation JOIN region ON r_regionkey = n_regionkey")
def envelope_flattened(t: Tables):
    """An envelope of nested records (nations, which are few) written, read and flattened to columns."""
    at = _new(t, "envelope")
    n = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    record = F.struct(F.col("n_nationkey").alias("key"), F.struct(F.col("n_name").alias("name"), F.struct(F.col("r_name").alias("name")).alias("region")).alias("place"))
    n.agg(F.to_json(F.struct(F.count("*").alias("total"), F.collect_list(record).alias("results"))).alias("value")).write.text(at)
    return readers.flatten(readers.json_envelope(t.spark, at)).select("key", "place_name", "place_region_name")


@query("A08", "SELECT c_custkey, c_nationkey FROM customer")
def ndjson_repeats(t: Tables):
    """JSON lines in which every third record stands twice; identical records are dropped."""
    at, c = _new(t, "ndjson"), t.customer.select("c_custkey", "c_nationkey")
    c.unionAll(c.where("c_custkey % 3 = 0")).write.json(at)
    return readers.json_lines(t.spark, at, "c_custkey long, c_nationkey long")


@query("A09", "SELECT event_id, user_id FROM events WHERE event_type = 'click'")
def projected_files(t: Tables):
    at = _new(t, "json")
    t.events.where("event_id % 2 = 0").write.json(f"{at}/a")
    t.events.where("event_id % 2 = 1").write.json(f"{at}/b")
    return readers.projected_json(t.spark, [f"{at}/a", f"{at}/b"], "event_id long, user_id long, event_type string", F.col("event_type") == "click").select("event_id", "user_id")


@query("A10", "SELECT p_partkey, p_name AS name, p_brand AS dataset FROM part")
def nested_parquet(t: Tables):
    at = _new(t, "nested")
    names = F.struct(F.create_map(F.lit("en"), F.col("p_name"), F.lit("type"), F.col("p_type")).alias("common"))
    t.part.select("p_partkey", names.alias("names"), F.array(F.struct(F.col("p_brand").alias("dataset"))).alias("sources")).write.parquet(at)
    return t.spark.read.parquet(at).select("p_partkey", F.col("names.common")["en"].alias("name"), F.element_at("sources", 1)["dataset"].alias("dataset"))


_RING = f"v(poly, v, lon, lat) AS (SELECT poly, v, CAST(lon AS DOUBLE), CAST(lat AS DOUBLE) FROM ({_HEX}) x(poly, v, lon, lat))"


def _hexagons(t: Tables) -> DataFrame:
    v = t.spark.sql(f"SELECT poly, v, CAST(lon AS DOUBLE) AS lon, CAST(lat AS DOUBLE) AS lat FROM ({_HEX}) AS x(poly, v, lon, lat)")
    return v.groupBy("poly").agg(F.array_sort(F.collect_list(F.struct("v", "lon", "lat"))).alias("ring"))


@query("A13", f"WITH {_RING} SELECT CAST(poly AS VARCHAR) AS name, count(*) AS n, round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat, round(min(lon), 6) AS w, round(max(lon), 6) AS e FROM v GROUP BY 1")
def kml_polygons(t: Tables):
    at = _new(t, "kml")
    points = F.array_join(F.transform("ring", lambda p: F.concat_ws(",", p["lon"], p["lat"], F.lit("0"))), "\n ")
    mark = F.concat(F.lit("<Placemark><name>"), F.col("poly").cast("string"), F.lit("</name>\n<coordinates>\n "), points, F.lit("\n</coordinates></Placemark>"))
    _hexagons(t).agg(F.concat(F.lit("<kml>"), F.array_join(F.collect_list(mark), "\n"), F.lit("</kml>")).alias("value")).write.text(at)
    each = readers.kml_rings(t.spark, at).select("name", F.explode("ring").alias("p"))
    r = lambda x: F.round(x, 6)
    return each.groupBy("name").agg(F.count("*").alias("n"), r(F.avg("p.lon")).alias("lon"), r(F.avg("p.lat")).alias("lat"), r(F.min("p.lon")).alias("w"), r(F.max("p.lon")).alias("e"))


@query("A14", f"WITH {_RING} SELECT CAST(poly AS VARCHAR) AS comm, 0 AS ring, v, round(lon, 6) AS lon, round(lat, 6) AS lat FROM v")
def geojson_polygons(t: Tables):
    at = _new(t, "polygons")
    ring = F.transform("ring", lambda p: F.array(p["lon"], p["lat"]))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("poly").cast("string").alias("comm")).alias("properties"), F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"))
    _hexagons(t).agg(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.collect_list(feature).alias("features"))).alias("value")).write.text(at)
    return readers.geojson_vertices(t.spark, at, "comm").select("comm", "ring", "v", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query("A16", """WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS m1, count(*) FILTER (WHERE o_orderkey % 35 = 0) AS m2 FROM orders)
    SELECT o_orderkey FROM orders, n WHERE o_orderkey % 5 <> 0 OR (m1 > greatest(50, 0.002 * n) AND (o_orderkey % 7 <> 0 OR (m2 > greatest(50, 0.002 * n) AND o_orderkey % 11 <> 0)))""")
def healed_pull(t: Tables):
    """Three pulls that each miss other rows; pulling stops when few known orders are missing."""
    o = t.orders.select("o_orderkey")
    return readers.healed(o, [o.where(f"o_orderkey % {k} <> 0") for k in (5, 7, 11)], "o_orderkey")


@query("A18", """WITH p AS (SELECT s_suppkey AS key, CASE WHEN s_suppkey % 3 = 0 THEN 'truncated' ELSE 'ok' END AS status, s_suppkey * 7 % 100 AS rows FROM supplier WHERE s_suppkey % 4 <> 0),
    s AS (SELECT s_suppkey AS key, CASE WHEN s_suppkey % 5 = 0 THEN 'error' ELSE 'ok' END AS status, s_suppkey * 11 % 100 AS rows FROM supplier WHERE s_suppkey % 7 <> 0)
    SELECT key, env, CASE WHEN env = 'sample' THEN srows ELSE prows END AS rows FROM (SELECT coalesce(p.key, s.key) AS key, p.rows AS prows, s.rows AS srows,
        CASE WHEN p.status = 'ok' THEN 'best' WHEN coalesce(p.rows, 0) > coalesce(s.rows, 0) THEN 'best_partial' WHEN s.status = 'ok' THEN 'sample' WHEN p.status IS NOT NULL THEN 'best' ELSE 'sample' END AS env FROM p FULL JOIN s ON p.key = s.key)""")
def environment_precedence(t: Tables):
    s, k = t.supplier, F.col("s_suppkey")
    best = s.where("s_suppkey % 4 <> 0").select(k, F.when(k % 3 == 0, "truncated").otherwise("ok"), k * 7 % 100)
    sample = s.where("s_suppkey % 7 <> 0").select(k, F.when(k % 5 == 0, "error").otherwise("ok"), k * 11 % 100)
    return readers.precedence(best, sample)


@query("A19", "SELECT n_nationkey, trim(n_name) AS label FROM nation")
def index_labels(t: Tables):
    """An index file whose titles end, after the last comma, with the series' label."""
    at = _csv(t.nation.select("n_nationkey", F.concat(F.lit("Prices, real, index, "), "n_name").alias("title")), _new(t, "index"))
    return readers.text_csv(t.spark, at).select(F.col("n_nationkey").cast("int").alias("n_nationkey"), readers.last_label(F.col("title")).alias("label"))


@query("A23", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def spill_replay(t: Tables):
    """What one run spilled, beside a run that spilled nothing."""
    at, schema = _new(t, "spill"), "o_orderkey long, o_totalprice double"
    for status, day in (("P", "2024-02-01"), ("F", "2024-02-02")):
        t.orders.where(F.col("o_orderstatus") == status).select("o_orderkey", "o_totalprice").write.json(f"{at}/run_date={day}")
    return readers.spilled(t.spark, at, "2024-02-01", schema).unionAll(readers.spilled(t.spark, at, "2024-03-01", schema))


# sinks


@query("B01", "SELECT r_regionkey, 'new' AS state FROM region")
def table_replaced(t: Tables):
    """One table of a snapshot replaced, the other as it was."""
    store = lake.Lake(t.spark, _new(t, "lake"))
    store.publish({"region": t.region.select("r_regionkey", F.lit("old").alias("state")), "nation": t.nation})
    store.replace("region", t.region.select("r_regionkey", F.lit("new").alias("state")))
    return store.table("region").join(store.table("nation").select("n_regionkey").distinct(), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("r_regionkey", "state")


@query("B02", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def table_appended(t: Tables):
    at = _new(t, "append")
    for status in ("F", "O", "P"):
        lake.append(t.orders.where(F.col("o_orderstatus") == status).select("o_orderkey", "o_orderstatus"), at)
    return t.spark.read.parquet(at).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("B05", "SELECT n_regionkey, count(*) AS n FROM nation GROUP BY 1")
def dependent_views(t: Tables):
    """Views given in the wrong order: the second pass makes the one whose source came later."""
    mark = f"v{uuid4().hex}"
    t.nation.createOrReplaceTempView(f"{mark}_base")
    order = lake.views(t.spark, {f"{mark}_top": f"SELECT n_regionkey, count(*) AS n FROM {mark}_mid GROUP BY 1", f"{mark}_mid": f"SELECT n_regionkey FROM {mark}_base"})
    return t.spark.table(order[-1])


@query("B06", "SELECT 2 AS snapshots, 2 AS folders, 1 AS gone, count(*) AS n FROM nation WHERE n_regionkey < 1")
def snapshot_expiry(t: Tables):
    """Three snapshots of a shrinking table: the first is forgotten and its folder deleted."""
    root = _new(t, "lake")
    store = lake.Lake(t.spark, root)
    for k in (3, 2, 1):
        store.publish({"nation": t.nation.where(F.col("n_regionkey") < k)}, shrink=0.0)
    gone = store.expire(keep=2)
    folders = len(readers.entries(t.spark, f"{root}/nation"))
    return store.table("nation").agg(F.lit(len(store.snapshots())).alias("snapshots"), F.lit(folders).alias("folders"), F.lit(gone).alias("gone"), F.count("*").alias("n"))


@query("B07", "SELECT strftime(o_orderdate, '%Y') AS run_date, count(*) AS n FROM orders GROUP BY 1")
def same_run_rewritten(t: Tables):
    """A run written wrongly and written again: no row of it stands twice."""
    at = _new(t, "runs")
    days = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy").alias("run_date"))
    lake.rewrite(days.unionAll(days), at, "run_date")
    lake.rewrite(days, at, "run_date")
    return t.spark.read.parquet(at).groupBy(F.col("run_date").cast("string").alias("run_date")).agg(F.count("*").alias("n"))


@query("B08", "SELECT o_custkey AS custkey, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS first_day, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_day FROM orders GROUP BY 1")
def master_upserted(t: Tables):
    """A master published, then published again with later rows merged in: matched rows updated, others inserted."""
    load = lambda df: df.groupBy(F.col("o_custkey").alias("custkey")).agg(F.min(F.to_date("o_orderdate")).cast("string").alias("a"), F.max(F.to_date("o_orderdate")).cast("string").alias("b"))
    store = lake.Lake(t.spark, _new(t, "lake"))
    early = F.year("o_orderdate") < 1996
    store.publish({"master": load(t.orders.where(early)).toDF("custkey", "first_day", "last_day")}, {"master": ["custkey"]})
    store.publish({"master": lake.upsert(store.table("master"), load(t.orders.where(~early)), "custkey", {"first_day": "a"}, {"last_day": "b"})}, {"master": ["custkey"]})
    return store.table("master")


@query("B09", "SELECT 'parts' AS job, p_partkey AS key FROM part WHERE p_size < 10 UNION ALL SELECT 'suppliers', s_suppkey FROM supplier")
def job_crosswalk(t: Tables):
    """Each job replaces its own rows of one crosswalk."""
    at = _new(t, "xref")
    lake.rewrite(t.part.select(F.col("p_partkey").alias("key"), F.lit("parts").alias("job")).unionAll(t.supplier.select("s_suppkey", F.lit("suppliers"))), at, "job")
    lake.rewrite(t.part.where("p_size < 10").select(F.col("p_partkey").alias("key"), F.lit("parts").alias("job")), at, "job")
    return t.spark.read.parquet(at).select(F.col("job").cast("string").alias("job"), "key")


@query("B10", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def json_artefact(t: Tables):
    at = _new(t, "artefact")
    lake.artefact(t.orders.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n")), at)
    return t.spark.read.schema("status string, n long").json(at)


@query("B12,B13", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand, CAST(NULL AS VARCHAR) AS decide FROM part WHERE p_size = 1")
def review_rows(t: Tables):
    """Rows to decide, stored as Parquet and offered as CSV in order."""
    at = _new(t, "review")
    t.part.where("p_size = 1").select("p_partkey", "p_brand").write.parquet(f"{at}/parquet")
    lake.review_queue(t.spark.read.parquet(f"{at}/parquet"), f"{at}/csv", ["p_brand", "p_partkey"])
    return readers.text_csv(t.spark, f"{at}/csv")


@query("B14", f"SELECT b, round(lon, 6) AS lon, round(lat, 6) AS lat FROM (SELECT s_suppkey AS b, {_PT.format(k='s_suppkey')} FROM supplier)")
def geojson_points(t: Tables):
    """Points exported as features, one a line, and read back."""
    at = _new(t, "points")
    lake.geojson(_points(t.supplier, "s_suppkey", "b"), "b", "lon", "lat", at)
    f = t.spark.read.schema("properties struct<b: int>, geometry struct<coordinates: array<double>>").json(at)
    return f.select("properties.b", F.round(F.element_at("geometry.coordinates", 1), 6).alias("lon"), F.round(F.element_at("geometry.coordinates", 2), 6).alias("lat"))


@query("J17", "SELECT n_nationkey FROM nation")
def same_stamp_twice(t: Tables):
    """The same extract published again is no new snapshot."""
    store = lake.Lake(t.spark, _new(t, "lake"))
    store.publish({"nation": t.nation.select("n_nationkey")})
    again = store.publish({"nation": t.nation.select("n_nationkey")})
    return store.table("nation").where(F.lit(again is None))
