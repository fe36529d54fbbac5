"""Snapshots of tables as Parquet under a shared path: publish, hold, time travel, expiry.

A snapshot is a row in the log, written last: readers see a table only through the log, so a publish that fails or is held
leaves the former snapshot as it was.  A table is written once, and what was written is checked; if its fingerprint has not
changed it is deleted again and the former files stand.  A snapshot's number is claimed by a file that only one publisher can
make; a claim that is older than STALE and led to no snapshot was left by a publisher that died and is taken over.

The log lies in a folder with a number; the highest that is whole is the log.  Expiry writes the next one beside it, so
readers have a whole log at any moment.
"""

from __future__ import annotations

import datetime
import tempfile
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stats import fingerprint

#: Seconds after which a claim without a snapshot was left behind.
STALE = 3600.0
LOG = "snapshot long, published_at timestamp, name string, path string, row_count long, mark string"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of this process only on a local master, where all tasks run beside it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set")
    return found or tempfile.mkdtemp(prefix="spark-ledgerline-")


def stored(df: DataFrame) -> DataFrame:
    """df, written once in the shared folder and read again."""
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Held(RuntimeError):
    """A publish was refused; the former snapshot stands."""


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self) -> str:
        """The newest log that is whole: in the making of the next one its mark of success comes last."""
        fs, root = self._fs(), self._path("")
        found = [int(f.getPath().getName()[5:]) for f in (fs.listStatus(root) if fs.exists(root) else []) if f.getPath().getName().startswith("_log-") and fs.exists(self._path(f"{f.getPath().getName()}/_SUCCESS"))]
        return f"_log-{max(found, default=0)}"

    def log(self) -> DataFrame:
        name = self._log()
        if not self._fs().exists(self._path(name)):  # no publish yet
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).parquet(f"{self.root}/{name}")

    def _current(self, version: int | None = None, timestamp: str | None = None) -> dict[str, tuple[str, int, str, int]]:
        log = self.log()
        if version is not None:
            log = log.where(F.col("snapshot") <= version)
        if timestamp is not None:
            log = log.where(F.col("published_at") <= F.lit(timestamp).cast("timestamp"))
        last = log.agg(F.max("snapshot")).first()[0]
        return {} if last is None else {r["name"]: (r["path"], r["row_count"], r["mark"], r["snapshot"]) for r in log.where(F.col("snapshot") == last).collect()}

    def table(self, name: str, version: int | None = None, timestamp: str | None = None) -> DataFrame:
        return self.spark.read.parquet(self._current(version, timestamp)[name][0])

    def publish(self, tables: dict[str, DataFrame], keys: dict[str, list[str]] | None = None, shrink: float = 0.8) -> int | None:
        """The new snapshot's number, or None if nothing changed.  Raises Held where a key repeats or a table shrank."""
        now = self._current()
        number = max([0, *(r[3] for r in now.values())]) + 1
        rows, fresh, changed = [], [], set(now) != set(tables)
        try:
            for name, df in tables.items():
                path = f"{self.root}/{name}/{number}-{uuid.uuid4().hex}"
                df.write.parquet(path)
                fresh.append(path)
                wrote = self.spark.read.schema(df.schema).parquet(path)
                f = fingerprint(wrote).first()
                mark = f"{f['rows']}/{f['xor']}/{f['total']}"
                if name in now and now[name][2] == mark:
                    self._delete(fresh.pop())
                    rows.append((name, now[name][0], f["rows"], mark))
                    continue
                changed = True
                if name in now and f["rows"] < shrink * now[name][1]:
                    raise Held(f"{name}: {f['rows']} rows after {now[name][1]}")
                if (key := (keys or {}).get(name)) and wrote.groupBy(*key).count().where("count > 1").limit(1).count():
                    raise Held(f"{name}: {key} repeats")
                rows.append((name, path, f["rows"], mark))
            if not changed:
                return None
            self._claim(number)
        except Held:
            for path in fresh:
                self._delete(path)
            raise
        entry = self.spark.createDataFrame([(number, *r) for r in rows], "snapshot long, name string, path string, row_count long, mark string")
        entry.select("snapshot", F.current_timestamp().alias("published_at"), "name", "path", "row_count", "mark").coalesce(1).write.mode("append").parquet(f"{self.root}/{self._log()}")
        return number

    def _claim(self, number: int) -> None:
        """Only one publisher at a time goes on from here."""
        fs, path = self._fs(), self._path(f"_claims/{number}")
        if fs.createNewFile(path):
            return
        age = time.time() - fs.getFileStatus(path).getModificationTime() / 1000
        if age < STALE or number in self.snapshots() or not (fs.delete(path, False) and fs.createNewFile(path)):
            raise Held(f"snapshot {number} was published meanwhile")

    def _delete(self, path: str) -> None:
        self._fs().delete(self.spark._jvm.org.apache.hadoop.fs.Path(path), True)

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def replace(self, name: str, df: DataFrame) -> int | None:
        """A new snapshot in which one table is replaced and the others stand."""
        others = {n: self.table(n) for n in self._current() if n != name}
        return self.publish({**others, name: df}, shrink=0.0)

    def snapshots(self) -> list[int]:
        return sorted(r[0] for r in self.log().select("snapshot").distinct().collect())

    def expire(self, older_than: datetime.datetime | None = None, keep: int = 1) -> int:
        """Forgets the snapshots published before a time (the last `keep` always stay), deletes the table folders that none that
        is left refers to, and returns how many went.  The next log is written beside the old one, which goes last."""
        log, numbers = self.log(), self.snapshots()
        old = log if older_than is None else log.where(F.col("published_at") < F.lit(older_than))
        gone = {r[0] for r in old.select("snapshot").distinct().collect()} - set(numbers[-keep:])
        if not gone:
            return 0
        left = log.where(~F.col("snapshot").isin(list(gone))).collect()
        number, was = numbers[-1] + 1, self._log()
        self._claim(number)  # no publish meanwhile
        try:
            self.spark.createDataFrame(left, LOG).coalesce(1).write.parquet(f"{self.root}/_log-{int(was[5:]) + 1}")
            orphans = {r["path"] for r in log.select("path").distinct().collect()} - {r["path"] for r in left}
            for path in orphans:
                self._delete(path)
            self._fs().delete(self._path(was), True)
        finally:
            self._fs().delete(self._path(f"_claims/{number}"), False)
        return len(orphans)


def views(spark: SparkSession, texts: dict[str, str]) -> list[str]:
    """Creates views that may read each other, in passes: one whose sources are not there yet waits for the next.  Returns the
    order; raises if a pass creates none."""
    left, order = dict(texts), []
    while left:
        made = []
        for name, text in left.items():
            try:
                spark.sql(text).createOrReplaceTempView(name)
                made.append(name)
            except Exception as e:
                if "TABLE_OR_VIEW_NOT_FOUND" not in str(e):
                    raise
        if not made:
            raise Held(f"views without sources: {sorted(left)}")
        order += made
        left = {n: x for n, x in left.items() if n not in made}
    return order


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def rewrite(df: DataFrame, path: str, by: str) -> None:
    """Replaces the partitions (a run date, a job) that df has rows of; the others stand.  Running it again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def geojson(df: DataFrame, key: str, lon: str, lat: str, path: str) -> None:
    """Points as GeoJSON features, one a line."""
    point = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col(key)).alias("properties"), point.alias("geometry"))
    df.select(F.to_json(feature).alias("value")).write.text(path)


def review_queue(df: DataFrame, path: str, order: list[str]) -> None:
    """The rows that a person is to decide, in order, as CSV with a header and an empty column for the decision."""
    df.withColumn("decide", F.lit(None).cast("string")).orderBy(*order).write.option("header", True).csv(path)


def artefact(df: DataFrame, path: str) -> None:
    """A small table of figures as one JSON object a line."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).coalesce(1).write.text(path)


@dataclass
class JobResult:
    """What a job returns: tables to publish, its rows of the crosswalk, how many keys it had and matched, and why it is held."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    crosswalk: DataFrame | None = None
    keys_in: int = 0
    keys_matched: int = 0
    hold: str | None = None


def run_jobs(store: Lake, crosswalk: str, jobs: dict[str, Callable[[], JobResult]], last: dict[str, float], least: float = 0.8) -> dict[str, str]:
    """Runs each job and publishes what it returns, unless it is held or matches less than `least` of its last accepted rate; says
    of each what was done.  One job's hold does not stop the others."""
    said = {}
    for name, job in jobs.items():
        r = job()
        rate = r.keys_matched / r.keys_in if r.keys_in else 0.0
        if r.hold or rate < least * last.get(name, 0.0):
            said[name] = f"held: {r.hold or 'join rate fell'}"
            continue
        now = {n: store.table(n) for n in store._current() if n not in r.tables}
        store.publish({**now, **r.tables}, shrink=0.0)
        if r.crosswalk is not None:
            rewrite(r.crosswalk.withColumn("job", F.lit(name)), crosswalk, "job")
        said[name] = "published"
    return said


def upsert(master: DataFrame, fresh: DataFrame, key: str, first: dict[str, str], last: dict[str, str]) -> DataFrame:
    """Master rows updated and new ones inserted: columns in `first` keep the oldest value, those in `last` take the newest;
    both map a column of the master to one of `fresh`."""
    f = fresh.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in {*first.values(), *last.values()}])
    both = master.join(f, F.col(key) == F.col("__key"), "full")
    return both.select(F.coalesce(key, "__key").alias(key), *[F.coalesce(m, f"__{c}").alias(m) for m, c in first.items()], *[F.coalesce(f"__{c}", m).alias(m) for m, c in last.items()])
