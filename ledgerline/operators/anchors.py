"""Anchored clusters: in order of time each row joins the first anchor of its bucket that it matches, or becomes one.

The rule is sequential, so a bucket that one task can hold is replayed as it is, many buckets at once: all take their first
row, then their second, and so on.  Of a larger one with places the islands, squares in touch with each other, are as good as
buckets of their own, since rows of different islands never match.  What is still too large is solved by rounds that all
tasks share.  Rows fall into cells so small that any two rows of a cell match, so a cell holds one anchor at most.  In a round
the oldest open row of a cell becomes an anchor if no cell near it has an older open row; then every open row that matches a
new anchor is closed, since it will join that one or an older one.  When a bucket's open rows fit a task they are replayed.
Last, each row joins the oldest anchor before it that it matches.  Rows meet anchors near them, never each other.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import METRES_LAT, METRES_LON
from . import graphs

#: Sizes and prices match if they differ by at most a share of the larger one, or by so much.
SIZE, PRICE = (0.03, 25.0), (0.02, 2000.0)
METRES = 150.0
#: Squares of this many metres (north, and east at the equator) have diagonals below METRES.
_NORTH, _EAST = 100.0, 110.0
_CELL = 0.94


def _place(x: Column, share: float, floor: float) -> Column:
    """A scale, straight and then logarithmic: values less than a step apart match, matching ones are less than 1.1 apart."""
    bend, step = floor / share, -math.log1p(-share)
    return F.when(x <= bend, x / floor).otherwise(bend / floor + F.log(x / bend) / step)


def _cell(geo: bool) -> Column:
    own = [_place(F.col("size"), *SIZE) / _CELL, _place(F.col("price"), *PRICE) / _CELL]
    if geo:
        own += [F.col("lat") * METRES_LAT / _NORTH, F.col("lon") * METRES_LON / _EAST]
    return F.array(*[F.floor(c).cast("bigint") for c in own])


def _matches(geo: bool, larger: bool) -> Column:
    """Does a row match the anchor whose columns begin with a_?"""
    of = lambda c: F.greatest(c, f"a_{c}") if larger else F.col(f"a_{c}")
    near = lambda c, share, floor: F.abs(F.col(c) - F.col(f"a_{c}")) <= F.greatest(share * of(c), F.lit(floor))
    same = near("size", *SIZE) & near("price", *PRICE) & F.coalesce(F.col("furnished") == F.col("a_furnished"), F.lit(True))
    if not geo:
        return same
    dx = (F.col("lon") - F.col("a_lon")) * METRES_LON * F.cos(F.radians((F.col("lat") + F.col("a_lat")) / 2))
    dy = (F.col("lat") - F.col("a_lat")) * METRES_LAT
    return same & (F.sqrt(dx * dx + dy * dy) <= METRES)


def replay(unit: np.ndarray, size: np.ndarray, price: np.ndarray, furnished: np.ndarray, lat: np.ndarray, lon: np.ndarray, geo: bool, larger: bool = True) -> np.ndarray:
    """Which row is the anchor of each row.  Rows are in order within their units, units are numbered from 0 and stand together.

    Units of like lengths take a row each at a time; each row is compared with all anchors of its unit so far at once."""
    n = len(unit)
    out, length = np.arange(n), np.bincount(unit)
    start = np.cumsum(length) - length
    values = [size, price, furnished.astype(float), *([lat, lon] if geo else [])]
    for k in range(1, int(length.max(initial=1) - 1).bit_length() + 1):  # over 2 ** (k - 1), up to 2 ** k rows
        own = np.flatnonzero((length > 1 << k - 1) & (length <= 1 << k))
        if not len(own):
            continue
        own = own[np.argsort(-length[own], kind="stable")]
        first, many, wide = start[own], length[own], int(length[own[0]])
        held = [np.full((len(own), wide), np.nan) for _ in values]
        at, found = np.zeros((len(own), wide), np.int64), np.zeros(len(own), np.int64)
        for i in range(wide):
            row = first[: np.searchsorted(-many, -i)]  # units that have an i-th row
            row, here = row + i, np.arange(len(row))
            m = int(found[: len(row)].max(initial=0))
            s, p, f, *place = (v[row][:, None] for v in values)
            a_s, a_p, a_f, *a_place = (h[: len(row), :m] for h in held)
            of = np.maximum if larger else lambda a, x: a
            ok = (np.abs(a_s - s) <= np.maximum(SIZE[0] * of(a_s, s), SIZE[1])) & (np.abs(a_p - p) <= np.maximum(PRICE[0] * of(a_p, p), PRICE[1]))
            ok &= (a_f == f) | (a_f < 0) | (f < 0)
            if geo:
                dx = (place[1] - a_place[1]) * METRES_LON * np.cos(np.radians((place[0] + a_place[0]) / 2))
                ok &= np.sqrt(dx * dx + ((place[0] - a_place[0]) * METRES_LAT) ** 2) <= METRES
            if m:
                best = ok.argmax(axis=1)
                hit = ok[here, best]
                out[row[hit]] = at[here[hit], best[hit]]
            else:
                hit = np.zeros(len(row), bool)
            new = here[~hit]
            for h, v in zip(held, values):
                h[new, found[new]] = v[row[new]]
            at[new, found[new]] = row[new]
            found[new] += 1
    return out


def _replayed(frame: pd.DataFrame, units: list[str], geo: bool, larger: bool) -> tuple[pd.DataFrame, np.ndarray]:
    """The frame in order, and the place in it of each row's anchor.  Rows equal in all that is compared are replayed once."""
    frame = frame.sort_values([*units, "at", "item", "size", "price"], ignore_index=True)
    same = [*units, "size", "price", "furnished", *(["lat", "lon"] if geo else [])]
    kind = frame.groupby(same, sort=False, dropna=False).ngroup().to_numpy()  # numbered as they come
    first = np.unique(kind, return_index=True)[1]
    one = frame.iloc[first]
    unit = one.groupby(units, sort=False, dropna=False).ngroup().to_numpy()
    column = lambda c: one[c].to_numpy(float) if c in one else np.zeros(len(one))
    anchor = replay(unit, column("size"), column("price"), pd.factorize(one["furnished"])[0], column("lat"), column("lon"), geo, larger)
    return frame, first[anchor][kind]


def _islands(rows: DataFrame, store: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """rows with the columns sx and sy of squares wider than a match reaches, and unit, n of each bucket, sx, sy: the island that
    the square belongs to and how many rows that has."""
    top = rows.agg(F.max(F.abs("lat"))).first()[0] or 0.0
    north, east = 1.01 * METRES / METRES_LAT, min(1.01 * METRES / METRES_LON / max(math.cos(math.radians(top)), 1e-9), 720.0)
    rows = rows.withColumn("sx", F.floor(F.col("lon") / east)).withColumn("sy", F.floor(F.col("lat") / north))
    node = F.concat_ws("|", F.col("bucket").cast("string"), F.col("sx").cast("string"), F.col("sy").cast("string"))
    squares = store(rows.groupBy("bucket", "sx", "sy").agg(F.count("*").alias("rows")).withColumn("node", node))
    beside = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((1, -1), (1, 0), (1, 1), (0, 1))])).alias("d")
    shifted = squares.select("bucket", "sx", "sy", F.col("node").alias("a"), beside).select("bucket", (F.col("sx") + F.col("d.x")).alias("sx"), (F.col("sy") + F.col("d.y")).alias("sy"), "a")
    links = store(shifted.join(squares.select("bucket", "sx", "sy", F.col("node").alias("b")), ["bucket", "sx", "sy"]).select("a", "b"))
    unit = squares.withColumn("unit", F.col("node"))
    if links.limit(1).count():
        unit = squares.join(graphs.components(links), "node", "left").withColumn("unit", F.coalesce("label", "node")).drop("label")
    sizes = unit.groupBy("unit").agg(F.sum("rows").alias("n"))
    return rows, store(unit.join(sizes, "unit").select("bucket", "sx", "sy", "unit", "n"))


def clusters(rows: DataFrame, store: Callable[[DataFrame], DataFrame], geo: bool = False, most: int = 20_000, larger: bool = True) -> DataFrame:
    """item, anchor for rows(item, bucket, at, size, price, furnished, lat, lon), in the order of (at, item, size, price).

    Rows without a bucket, size or price (with geo: a place), or of a negative size or price, match nothing and are their own
    anchors.  A null or empty furnished matches any.  Shares are of the larger of two values, else of the anchor's.  Rows equal in all that is compared are one, of the oldest item.  `most`
    is what a task replays; store(df) writes a table in the shared folder and reads it again."""
    compared = ["size", "price", *(["lat", "lon"] if geo else [])]
    base = rows.select("item", "bucket", "at", *[F.col(c).cast("double").alias(c) for c in ("size", "price", "lat", "lon")], F.nullif(F.lower(F.trim("furnished")), F.lit("")).alias("furnished"))
    if not geo:
        base = base.withColumns({c: F.lit(0.0) for c in ("lat", "lon")})
    whole = F.col("bucket").isNotNull() & (F.col("size") >= 0) & (F.col("price") >= 0)
    for c in compared:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(c)
    whole = F.coalesce(whole, F.lit(False))
    alone = base.where(~whole).select("item", F.col("item").alias("anchor"))
    rows, kind = base.where(whole), dict(base.dtypes)["item"]
    packs = max(1, rows.count() // most)
    cut = lambda c: F.pmod(F.xxhash64(c), F.lit(packs))

    def together(df: DataFrame, units: list[str]) -> DataFrame:
        """item, anchor of rows in units that a task can hold, some to a pack."""

        def each(frame: pd.DataFrame) -> pd.DataFrame:
            frame, at = _replayed(frame, units, geo, larger)
            return pd.DataFrame({"item": frame["item"], "anchor": frame["item"].to_numpy()[at]})

        needed = ["item", *units, "at", "size", "price", "furnished", *(["lat", "lon"] if geo else [])]
        return df.select(cut(units[-1]).alias("pack"), *needed).groupBy("pack").applyInPandas(each, f"item {kind}, anchor {kind}")

    # buckets are counted only where a pack is crowded; of those that a task can't hold there are fewer than packs
    crowded = rows.groupBy(cut("bucket").alias("pack")).agg(F.count("*").alias("n")).where(F.col("n") > 2 * most).select("pack")
    counted = rows.select("bucket", cut("bucket").alias("pack")).join(F.broadcast(crowded), "pack", "left_semi").groupBy("bucket").agg(F.count("*").alias("n"))
    large = store(counted.where(F.col("n") > most).select("bucket"))
    if not large.limit(1).count():
        return together(rows, ["bucket"]).unionByName(alone)
    out = alone.unionByName(together(rows.join(F.broadcast(large), "bucket", "left_anti"), ["bucket"]))
    hot = rows.join(F.broadcast(large), "bucket", "left_semi")
    if geo:
        hot, map_ = _islands(hot, store)
        map_ = F.broadcast(map_) if map_.count() <= 200_000 else map_
        hot = hot.join(map_, ["bucket", "sx", "sy"]).drop("sx", "sy")
        out = out.unionByName(together(hot.where(F.col("n") <= most).withColumn("unit", F.xxhash64("unit")), ["bucket", "unit"]))
        hot = hot.where(F.col("n") > most).drop("bucket", "n").withColumnRenamed("unit", "bucket")
        if not hot.limit(1).count():
            return out
    return out.unionByName(_crowded(hot, store, geo, most, larger, kind))


def _crowded(rows: DataFrame, store: Callable[[DataFrame], DataFrame], geo: bool, most: int, larger: bool, kind: str) -> DataFrame:
    """item, anchor of rows in buckets that a task may not hold: equal rows are one; buckets of few different rows are replayed,
    the others go by rounds."""
    same = ["bucket", "size", "price", "furnished", "lat", "lon"]
    rid = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in same]))
    rows = rows.withColumn("rid", rid)
    first = rows.groupBy("rid", *same).agg(F.min(F.struct("at", "item")).alias("f"))
    one = store(first.select("rid", *same, F.struct("f.at", "f.item", "size", "price", "rid").alias("o"), _cell(geo).alias("cell")))
    large = one.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > most).select("bucket")

    def each(frame: pd.DataFrame) -> pd.DataFrame:
        frame, at = _replayed(frame, ["bucket"], geo, larger)
        return pd.DataFrame({"rid": frame["rid"], "anchor": frame["item"].to_numpy()[at], "own": at == np.arange(len(at))})

    def replayed(df: DataFrame) -> DataFrame:
        return df.select("rid", F.col("o.item").alias("item"), F.col("o.at").alias("at"), *same).groupBy("bucket").applyInPandas(each, f"rid string, anchor {kind}, own boolean")

    found = replayed(one.join(large, "bucket", "left_anti")).select("rid", "anchor")
    if large.limit(1).count():
        found = found.unionByName(_rounds(one.join(large, "bucket", "left_semi"), store, geo, most, larger, replayed))
    return rows.select("rid", "item").join(found, "rid").select("item", "anchor")


def _rounds(hot: DataFrame, store: Callable[[DataFrame], DataFrame], geo: bool, most: int, larger: bool, replayed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """rid, anchor of the rows of large buckets."""
    shifts = [(-2, -1, 0, 1, 2)] * (3 if geo else 2)
    if geo:  # meridians draw together: farther north more squares lie within reach
        top = hot.agg(F.max(F.abs("lat"))).first()[0] or 0.0
        reach = int(METRES / (_EAST * max(math.cos(math.radians(top)), 0.01))) + 1
        shifts.append(tuple(range(-reach, reach + 1)))

    def near(df: DataFrame) -> DataFrame:
        """Each row in its own cell and in all cells near it."""
        for i, way in enumerate(shifts):
            df = df.withColumn(f"d{i}", F.explode(F.array(*map(F.lit, way))))
        return df.withColumn("cell", F.array(*[F.col("cell")[i] + F.col(f"d{i}") for i in range(len(shifts))])).drop(*[f"d{i}" for i in range(len(shifts))])

    def met(df: DataFrame, anchors: DataFrame) -> DataFrame:
        """Pairs of rows and anchors near them, not younger, that match."""
        a = near(anchors.select("bucket", "cell", *[F.col(c).alias(f"a_{c}") for c in ("o", "size", "price", "furnished", "lat", "lon")]))
        return df.join(a, ["bucket", "cell"]).where((F.col("a_o") <= F.col("o")) & _matches(geo, larger))

    open_, anchors = hot, None
    columns = hot.columns
    while True:
        large = open_.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > most).select("bucket")
        if not large.limit(1).count():
            break
        heads = store(open_.join(large, "bucket", "left_semi").groupBy("bucket", "cell", "furnished").agg(F.min_by(F.struct(*[c for c in columns if c not in ("bucket", "cell", "furnished")]), "o").alias("x")).select("bucket", "cell", "furnished", "x.*"))
        oldest = near(heads.select("bucket", "cell", F.col("o").alias("far"))).groupBy("bucket", "cell").agg(F.min("far").alias("oldest"))
        new = store(heads.join(oldest, ["bucket", "cell"]).where(F.col("o") <= F.col("oldest")).select(*columns))
        anchors = new if anchors is None else anchors.unionByName(new)
        open_ = store(open_.join(met(open_, new).select("rid").distinct(), "rid", "left_anti").select(*columns))
    last = open_.join(replayed(open_).where("own").select("rid"), "rid", "left_semi").select(*columns)
    every = store(last if anchors is None else anchors.unionByName(last))
    return met(hot, every).groupBy("rid").agg(F.min("a_o").alias("a")).select("rid", F.col("a.item").alias("anchor"))
