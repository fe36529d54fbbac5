"""Registers that grow by extracts: merges into stored versions, holds and their release, series that cover each other."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import spans
from ..sources import lake, register
from .registry import Tables, query


def _register(t: Tables) -> register.Register:
    return register.Register(t.spark, f"{lake.shared_dir(t.spark)}/register-{uuid.uuid4().hex}", "k", ["status", "price", "day"], "day")


def _orders(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.to_date("o_orderdate").alias("day"))


_ORDERS = "o AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_totalprice AS price, CAST(o_orderdate AS DATE) AS day FROM orders)"
#: Days of the three rolling windows.
_WINDOWS = [("1995-01-01", "1999-02-08"), ("1995-10-27", "1999-12-04"), ("1996-08-23", "2000-09-30")]


def _pull(n: int) -> str:
    """What the n-th extract says: the second moves a status, the third lacks a few orders and moves a price."""
    a, b = _WINDOWS[n - 1]
    status = "status" if n == 1 else "CASE WHEN k % 7 = 0 THEN status || 'x' ELSE status END"
    price = "CASE WHEN k % 9 = 0 THEN price + 1 ELSE price END" if n == 3 else "price"
    lacks = " AND k % 1000 <> 0" if n == 3 else ""
    return f"SELECT k, {status} AS status, {price} AS price, day FROM o WHERE day BETWEEN DATE '{a}' AND DATE '{b}'{lacks}"


def _merged_sql() -> str:
    steps = [_ORDERS, f"p1 AS ({_pull(1)}), v1 AS (SELECT *, 1 AS recorded_from, CAST(NULL AS INTEGER) AS recorded_to, false AS vanished FROM p1)"]
    for n in (2, 3):
        same = "s.k = v.k AND s.status = v.status AND s.price = v.price AND s.day = v.day"
        steps.append(f"""p{n} AS ({_pull(n)}), w{n} AS (SELECT min(day) + 1 AS a, max(day) AS b FROM p{n}), c{n} AS (
            SELECT v.*, v.recorded_to IS NULL AND v.day BETWEEN a AND b AND NOT EXISTS (SELECT 1 FROM p{n} s WHERE {same}) AS closes, NOT EXISTS (SELECT 1 FROM p{n} s WHERE s.k = v.k) AS gone FROM v{n - 1} v, w{n}),
            v{n} AS (SELECT k, status, price, day, recorded_from, CASE WHEN closes THEN {n} ELSE recorded_to END AS recorded_to, CASE WHEN closes THEN gone ELSE vanished END AS vanished FROM c{n}
            UNION ALL SELECT s.*, {n}, NULL, false FROM p{n} s WHERE NOT EXISTS (SELECT 1 FROM v{n - 1} v WHERE v.recorded_to IS NULL AND {same}))""")
    return f"WITH {', '.join(steps)} SELECT k, status, price, day, CAST(recorded_from AS BIGINT) AS recorded_from, CAST(recorded_to AS BIGINT) AS recorded_to, vanished FROM v3"


@query("J02,J03,J07", _merged_sql())
def register_merged(t: Tables):
    """Three extracts of rolling windows, each merged into what is stored."""
    store, o = _register(t), _orders(t)
    for n in (1, 2, 3):
        store.merge(t.spark.sql(_pull(n).replace("FROM o ", "FROM {o} "), o=o), f"pull-{n}", n)
    return store.versions().select("k", "status", "price", "day", "recorded_from", "recorded_to", "vanished")


#: Which orders the extracts lack: the second lacks a seventh and is held, the third agrees, the next two do not.
_LACKS = {1: "false", 2: "k % 7 = 0", 3: "k % 7 = 0 AND k % 70 <> 0", 4: "k % 11 = 0", 5: "k % 5 = 0"}


@query("J06,K02", f"""WITH {_ORDERS}, e AS (SELECT * FROM (VALUES {', '.join(f"({n})" for n in _LACKS)}) v(n)),
    p AS (SELECT n, k, day, CASE n {' '.join(f'WHEN {n} THEN {x}' for n, x in _LACKS.items())} END AS lacks, CASE WHEN n <= 3 THEN false ELSE k % 7 = 0 AND k % 70 <> 0 END AS closed FROM o, e),
    w AS (SELECT n, count(*) AS rows, min(day) AS a, max(day) AS b FROM p WHERE NOT lacks GROUP BY n),
    g AS (SELECT p.n, any_value(w.rows) AS rows, count(*) FILTER (p.lacks AND NOT p.closed AND p.day BETWEEN w.a + 1 AND w.b) AS gone, count(*) FILTER (NOT p.closed AND p.day BETWEEN w.a + 1 AND w.b) AS overlap FROM p JOIN w ON w.n = p.n GROUP BY p.n)
    SELECT 'pull-' || n AS source, CASE WHEN n IN (1, 3) OR gone <= greatest(50, 0.002 * overlap) THEN 'loaded' ELSE 'held' END AS status, rows, CASE WHEN n = 1 THEN 0 ELSE gone END AS vanished FROM g""")
def vanish_release(t: Tables):
    """Five extracts: held for what they lack, and released where the next one lacks the same."""
    store, o = _register(t), _orders(t)
    for n, lacks in _LACKS.items():
        store.merge(o.where(f"NOT ({lacks})"), f"pull-{n}", n, "window")
    return store.loads().select("source", "status", "rows", "vanished")


@query("J03", "SELECT * FROM (VALUES ('every day once', 'window'), ('keys repeat', 'export'), ('times with a space', 'export'), ('year so far', 'export')) v(extract, series)")
def series_judged(t: Tables):
    """An extract told by its content: repeats of keys, times written with a space, or by its name."""
    store, o = _register(t), _orders(t)
    spelt = o.withColumn("written", F.date_format("day", "yyyy-MM-dd'T'HH:mm"))
    spaced = o.withColumn("written", F.date_format("day", "yyyy-MM-dd HH:mm"))
    found = [("every day once", store.series_of(spelt, "written")), ("keys repeat", store.series_of(spelt.unionAll(spelt.where("k % 50 = 1")), "written")), ("times with a space", store.series_of(spaced, "written")), ("year so far", store.series_of(spelt, "written", True))]
    return t.spark.createDataFrame(found, "extract string, series string")


#: Two windows with a gap of five months between them, and an export up to a day in the second.
_TWO = [("1996-01-01", "1996-12-31"), ("1997-06-01", "1998-06-30")]
_EXPORT_TO = "1998-01-31"


def _two_series(t: Tables) -> register.Register:
    store, o = _register(t), _orders(t)
    store.merge(o.where(f"day <= DATE '{_EXPORT_TO}'").withColumn("price", F.col("price") + 1), "export", 1, "export")
    for n, (a, b) in enumerate(_TWO, 2):
        store.merge(o.where(f"day BETWEEN DATE '{a}' AND DATE '{b}'"), f"window-{n}", n, "window")
    return store


_BOTH = _ORDERS + f""", w AS (SELECT 'window' AS series, k, price, day FROM o WHERE {' OR '.join(f"day BETWEEN DATE '{a}' AND DATE '{b}'" for a, b in _TWO)}), x AS (SELECT 'export' AS series, k, price + 1 AS price, day FROM o WHERE day <= DATE '{_EXPORT_TO}'),
    c AS (SELECT min(day) AS a, max(day) AS b FROM w WHERE day <= DATE '{_TWO[0][1]}' UNION ALL SELECT min(day), max(day) FROM w WHERE day >= DATE '{_TWO[1][0]}')"""


@query("J08", f"WITH {_BOTH} SELECT * FROM w UNION ALL SELECT * FROM x WHERE day < (SELECT max(a) FROM c)")
def current_two_series(t: Tables):
    """The present state: the export counts before the window of the last extract."""
    return _two_series(t).current().select("series", "k", "price", "day")


@query("J08", f"WITH {_BOTH} SELECT * FROM w UNION ALL SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM c WHERE x.day BETWEEN a AND b)")
def current_gaps_filled(t: Tables):
    """The present state: the export counts on the days that no window holds."""
    return _two_series(t).current(rule="union").select("series", "k", "price", "day")


@query("J08", f"""WITH {_BOTH}, days AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM x), (SELECT max(day) FROM x), INTERVAL 1 DAY)) AS DATE) AS d),
    f AS (SELECT d, d - CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS island FROM days WHERE NOT EXISTS (SELECT 1 FROM c WHERE d BETWEEN a AND b))
    SELECT min(d) AS first, max(d) AS last FROM f GROUP BY island""")
def coverage_gaps(t: Tables):
    """Days that only the export covers."""
    c = _two_series(t).coverage()
    one = lambda s: c.where(F.col("series") == s).select(F.lit("all").alias("register"), "first", "last")
    return spans.difference(one("export"), one("window"), ["register"]).select("first", "last")
