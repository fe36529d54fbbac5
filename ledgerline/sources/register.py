"""A register of versioned rows that grows by extracts: each is merged into the stored versions, never rebuilt from all.

An extract of the register covers a window of days.  Open versions of those days that it repeats stay, those whose content
it changes or that it lacks are closed, what is new is added; other days are not looked at (rows without a day are never closed).  Stored rows lie in folders by
series, month and whether they are open.  A merge reads the open folders of the extract's months and writes those months'
open versions and the versions that it closes; closed versions are never read or written again, nor are other months.

A merge takes effect by one file, the manifest of the next number: it lists the folders that are current and what became of
each extract.  It is made so that only one writer can make it; a manifest that is cut off counts as never written, and a merge
that fails or is held leaves all former folders as they were.  Readers take the folders of the manifest that they read.  The
manifest has an entry a folder (series, months and merges) and one an extract.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import spans
from .lake import Held

#: An extract with less than this share of the rows of the one before is held.
SHRINK = 0.8
#: Missing rows from which an extract is held: so many, and this share of what it should repeat.
VANISH_ROWS, VANISH_SHARE = 50, 0.002
#: A hold for missing rows is released by the next extract if it lacks this share of the same ones.
AGREE = 0.8


@dataclass
class Load:
    """What became of one extract."""

    source: str
    series: str
    status: str
    recorded_at: int
    rows: int
    window_from: str | None = None
    window_to: str | None = None
    new: int = 0
    closed: int = 0
    vanished: int = 0
    note: str = ""
    missing: str | None = None


@dataclass
class Manifest:
    number: int = 0
    open: dict[str, str] = field(default_factory=dict)
    closed: list[str] = field(default_factory=list)
    loads: list[Load] = field(default_factory=list)

    def text(self) -> str:
        return json.dumps({"number": self.number, "open": self.open, "closed": self.closed, "loads": [x.__dict__ for x in self.loads]})

    @staticmethod
    def of(text: str) -> Manifest:
        d = json.loads(text)
        return Manifest(d["number"], d["open"], d["closed"], [Load(**x) for x in d["loads"]])


def row_hash(df: DataFrame, columns: list[str], dates: list[str] = ()) -> Column:
    """The content of a row: trimmed, null as empty, the two spellings of a time of day as one."""
    text = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return F.md5(F.concat_ws("\x1f", *[F.replace(text(c), F.lit("T"), F.lit(" ")) if c in dates else text(c) for c in columns]))


class Register:
    """Versions of rows(key, columns, at); `at` is the day or time that places a row in a window."""

    def __init__(self, spark: SparkSession, root: str, key: str, columns: list[str], at: str):
        self.spark, self.root, self.key, self.columns, self.at = spark, root.rstrip("/"), key, columns, at

    # ---- the manifest

    def _fs(self):
        path = self._path("")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _numbers(self) -> list[int]:
        fs, folder = self._fs(), self._path("manifests")
        if not fs.exists(folder):
            return []
        return sorted((int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit()), reverse=True)

    def manifest(self) -> Manifest:
        """The newest manifest that is whole."""
        for n in self._numbers():
            text = "".join(r[0] for r in self.spark.read.text(f"{self.root}/manifests/{n}", wholetext=True).collect())
            try:
                return Manifest.of(text)
            except (ValueError, KeyError, TypeError):
                continue
        return Manifest()

    def _commit(self, seen: Manifest, new: Manifest) -> None:
        """Only the writer that makes the next file has committed."""
        new.number = max([seen.number, *self._numbers()[:1]]) + 1
        if self.manifest().number != seen.number:
            raise Held("another extract was merged meanwhile")
        try:
            out = self._fs().create(self._path(f"manifests/{new.number}"), False)
        except Exception as e:
            if "AlreadyExists" not in str(e):
                raise
            raise Held(f"merge {new.number} was made meanwhile") from e
        out.write(bytearray(new.text().encode()))
        out.close()

    # ---- reading

    def _read(self, paths: list[str]) -> DataFrame:
        """Versions in the folders, with the register's columns."""
        kinds = json.loads(self._text("schema")) if self._fs().exists(self._path("schema")) else None
        if kinds is None:
            raise Held("nothing is merged yet")
        schema = ", ".join(f"`{c}` {k}" for c, k in kinds)
        reader = self.spark.read.schema(schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _text(self, name: str) -> str:
        return "".join(r[0] for r in self.spark.read.text(f"{self.root}/{name}", wholetext=True).collect())

    def versions(self, series: str | None = None) -> DataFrame:
        """All versions: series, key, txn_key, columns, at, row_hash, recorded_from, recorded_to, vanished, source."""
        m = self.manifest()
        found = self._read([*m.open.values(), *m.closed])
        return found if series is None else found.where(F.col("series") == series)

    def loads(self) -> DataFrame:
        rows = [(x.source, x.series, x.status, x.recorded_at, x.rows, x.window_from, x.window_to, x.new, x.closed, x.vanished, x.note) for x in self.manifest().loads]
        return self.spark.createDataFrame(rows, "source string, series string, status string, recorded_at long, rows long, window_from string, window_to string, new long, closed long, vanished long, note string")

    def current(self, first: str = "window", second: str = "export", rule: str = "latest") -> DataFrame:
        """Open versions of both series, each day from one: the second series counts only where the first does not reach.

        rule `latest`: before the window of the last extract of the first series.  rule `union`: on days that no window of any
        loaded extract of it holds, so that the second series also fills gaps between windows."""
        m = self.manifest()
        open_ = self._read(list(m.open.values())).where(F.col("series").isin(first, second))
        loaded = [x for x in m.loads if x.series == first and x.status == "loaded" and x.window_from]
        if not loaded:
            return open_
        if rule == "latest":
            cover = F.lit(max(loaded, key=lambda x: x.recorded_at).window_from).cast("date")
            return open_.where((F.col("series") == first) | (F.to_date(F.col(self.at)) < cover))
        held = self.coverage().where(F.col("series") == first).withColumn("series", F.lit(second))  # it is the second that gives way
        return spans.covered(open_, held, ["series"], self.at, "__held").where((F.col("series") == first) | ~F.col("__held")).drop("__held")

    def coverage(self) -> DataFrame:
        """series, first, last: the days that loaded extracts of each series cover, as disjoint intervals."""
        return spans.union(self.loads().where("status = 'loaded'").withColumnsRenamed({"window_from": "first", "window_to": "last"}), ["series"])

    # ---- merging

    def series_of(self, rows: DataFrame, written_at: str | None = None, to_date: bool = False) -> str:
        """`export` if the extract is one of the year so far, repeats keys, or writes times (in the text column `written_at`)
        with a space; else `window`."""
        if to_date:
            return "export"
        repeated = rows.groupBy(self.key).agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        return "export" if repeated or (written_at and rows.where(F.col(written_at).contains(" ")).limit(1).count()) else "window"

    def _staged(self, rows: DataFrame, dates: list[str]) -> DataFrame:
        """txn_key (the key, or key#2, key#3 ... of repeats in the order of their content; a null key is empty), columns, at, row_hash, month."""
        hashed = rows.select(self.key, *self.columns, *([self.at] if self.at not in self.columns else [])).withColumn("row_hash", row_hash(rows, self.columns, dates))
        text, n = F.coalesce(F.col(self.key).cast("string"), F.lit("")), F.row_number().over(Window.partitionBy(self.key).orderBy("row_hash"))
        return hashed.withColumn("txn_key", F.when(n == 1, text).otherwise(F.concat(text, F.lit("#"), n.cast("string")))).withColumn("month", F.coalesce(F.date_format(self.at, "yyyy-MM"), F.lit("none")))

    def merge(self, rows: DataFrame, source: str, recorded_at: int, series: str | None = None, dates: list[str] = ()) -> Load:
        """Merges one extract and says what became of it.  An extract of a source that is loaded already changes nothing."""
        seen = self.manifest()
        if done := [x for x in seen.loads if x.source == source and x.status == "loaded"]:
            return done[-1]
        series = series or self.series_of(rows)
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        staged = self._staged(rows, list(dates))
        staged.write.parquet(f"{folder}/stage")  # the extract is read once
        stage = self.spark.read.schema(staged.schema).parquet(f"{folder}/stage")
        months = stage.groupBy("month").agg(F.count("*").alias("n"), F.min(F.to_date(self.at)).alias("a"), F.max(F.to_date(self.at)).alias("b")).collect()  # a row a month
        days = [d for r in months for d in (r["a"], r["b"]) if d]
        load = Load(source, series, "loaded", recorded_at, sum(r["n"] for r in months), str(min(days)) if days else None, str(max(days)) if days else None)
        if not self._fs().exists(self._path("schema")):
            self._describe(stage)
        if not load.rows:
            return self._held(seen, load, "no rows")
        earlier = [x for x in seen.loads if x.series == series]
        before = [x for x in earlier if x.status == "loaded"]
        if series == "window" and before and load.rows < SHRINK * before[-1].rows:
            return self._held(seen, load, f"shrank: {load.rows} rows after {before[-1].rows}")
        # the first day of a window is cut through by it, so it is judged from the second
        since = F.date_add(F.lit(load.window_from).cast("date"), 1 if series == "window" else 0)
        day = F.to_date(self.at)
        known = [p for k, p in seen.open.items() if k.partition("/")[0] == series and self._touched(k.partition("/")[2], load)]
        old = self._read(known).withColumn("scope", F.coalesce(day.between(since, F.lit(load.window_to).cast("date")), F.lit(False)))
        keys = stage.select("txn_key", F.lit(True).alias("there"))
        if series == "window":
            judged = old.where("scope").join(keys, "txn_key", "left")
            n = judged.agg(F.count("*").alias("overlap"), F.count(F.when(F.col("there").isNull(), 1)).alias("gone")).first()
            if n["gone"] > max(VANISH_ROWS, VANISH_SHARE * n["overlap"]):
                gone, last = judged.where("there IS NULL").select("txn_key"), earlier[-1] if earlier else None
                agree = gone.join(self.spark.read.parquet(last.missing), "txn_key", "left_semi").count() / n["gone"] if last and last.missing else 0.0
                if agree < AGREE:
                    load.missing, load.vanished = f"{folder}/missing", n["gone"]
                    gone.write.parquet(load.missing)
                    return self._held(seen, load, f"vanish: {n['gone']} of {n['overlap']} missing" + (f", {agree:.0%} of them from the extract before too" if agree else ""))
        self._merged(seen, load, old, stage, keys, folder)
        return load

    def _touched(self, month: str, load: Load) -> bool:
        return month == "none" or bool(load.window_from) and load.window_from[:7] <= month <= load.window_to[:7]

    def _held(self, seen: Manifest, load: Load, why: str) -> Load:
        load.status, load.note = "held", why
        self._commit(seen, Manifest(0, seen.open, seen.closed, [*seen.loads, load]))
        return load

    def _describe(self, stage: DataFrame) -> None:
        kinds = dict(stage.dtypes)
        own = [self.key, "txn_key", *self.columns, *([self.at] if self.at not in self.columns else []), "row_hash"]
        more = [("series", "string"), ("recorded_from", "bigint"), ("recorded_to", "bigint"), ("vanished", "boolean"), ("source", "string")]
        out = self._fs().create(self._path("schema"), True)
        out.write(bytearray(json.dumps([*((c, kinds[c]) for c in dict.fromkeys(own)), *more]).encode()))
        out.close()

    def _merged(self, seen: Manifest, load: Load, old: DataFrame, stage: DataFrame, keys: DataFrame, folder: str) -> None:
        kept = [c for c in old.columns if c != "scope"]
        fresh = stage.select("txn_key", "row_hash", F.lit(True).alias("same"))
        judged = old.join(fresh, ["txn_key", "row_hash"], "left").join(keys, "txn_key", "left")
        closes = F.col("scope") & F.col("same").isNull()
        judged = judged.withColumn("closes", closes).withColumn("recorded_to", F.when(F.col("closes"), F.lit(load.recorded_at)).otherwise(F.col("recorded_to"))).withColumn("vanished", F.col("closes") & F.col("there").isNull())
        new = stage.join(old.select("txn_key", "row_hash"), ["txn_key", "row_hash"], "left_anti")
        new = new.select("*", F.lit(load.series).alias("series"), F.lit(load.recorded_at).cast("bigint").alias("recorded_from"), F.lit(None).cast("bigint").alias("recorded_to"), F.lit(False).alias("vanished"), F.lit(load.source).alias("source"))
        month = F.coalesce(F.date_format(self.at, "yyyy-MM"), F.lit("none")).alias("month")
        out = judged.select(*kept, month, (~F.col("closes")).alias("open")).unionByName(new.select(*kept, month, F.lit(True).alias("open")))
        out.write.partitionBy("month", "open").parquet(f"{folder}/rows")
        # what was written is counted, so that a task that ran twice counts once
        n = lambda c: F.count(F.when(c, 1))
        wrote = self.spark.read.parquet(f"{folder}/rows").groupBy(F.col("month").cast("string").alias("month"))
        got = wrote.agg(n(F.col("open") & (F.col("source") == load.source)).alias("new"), n(~F.col("open")).alias("closed"), n(~F.col("open") & F.col("vanished")).alias("vanished")).collect()
        load.new, load.closed, load.vanished = (sum(r[c] for r in got) for c in ("new", "closed", "vanished"))
        now = Manifest(0, dict(seen.open), list(seen.closed), [*seen.loads, load])
        fs = self._fs()
        for month in (r["month"] for r in got if r["new"] or r["closed"]):
            for state in ("true", "false"):
                path = f"{folder}/rows/month={month}/open={state}"
                there = fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(path))
                if state == "false":
                    now.closed += [path] if there else []
                elif there:
                    now.open[f"{load.series}/{month}"] = path
                else:
                    now.open.pop(f"{load.series}/{month}", None)
        self._commit(seen, now)
