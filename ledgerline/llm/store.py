"""Tables written in the folder that all machines share: they cut lineage and survive the loss of an executor."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session.  Only where it is unset on a local master, as in tests, a folder of this process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="spark-ledgerline-"))
    return _OWN[0]


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """From now on the session sends rows to Python in batches of at most so many bytes: a task holds a few copies of a batch in
    the JVM and in its worker, and rows with long texts are large.  It is not set back here, as what a caller returns is read
    later under the same setting."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/ledgerline/{name}-{uuid.uuid4().hex}"


#: The setting by which an execution deletes its shuffle files, and of sessions that are inside brief_shuffles: how often, and its value before.
_BRIEF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_INSIDE: dict[SparkSession, tuple[int, str | None]] = {}

#: Paths written under an owner's name (all threads), and the present owner of a thread.
_MADE: dict[str, list[str]] = {}
_LOCK = threading.Lock()
_OWNER = threading.local()


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes and counts that start inside delete their shuffle files when they end.  Else these stay on the disks until the driver
    happens to collect its garbage.  Frames to return are made outside: one that runs twice reads its shuffle files again."""
    with _LOCK:
        depth, before = _INSIDE.get(spark) or (0, spark.conf.get(_BRIEF, None))
        _INSIDE[spark] = depth + 1, before
        spark.conf.set(_BRIEF, "true")
    try:
        yield
    finally:
        with _LOCK:
            depth, before = _INSIDE.pop(spark)
            if depth > 1:  # another thread, or around this one
                _INSIDE[spark] = depth - 1, before
            elif before is None:
                spark.conf.unset(_BRIEF)
            else:
                spark.conf.set(_BRIEF, before)


@contextmanager
def owned(name: str) -> Iterator[None]:
    """Tables that this thread writes inside can be deleted together, once nothing reads them, by drop(name)."""
    before = getattr(_OWNER, "name", None)
    _OWNER.name = name
    try:
        yield
    finally:
        _OWNER.name = before


def drop(spark: SparkSession, name: str) -> None:
    with _LOCK:
        paths = _MADE.pop(name, ())
    for path in paths:
        there = spark._jvm.org.apache.hadoop.fs.Path(path)
        there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """df, stored once as Parquet in the shared folder (or at `path`) and read again."""
    if path is None:
        path = new_path(df.sparkSession, name)
        if (owner := getattr(_OWNER, "name", None)) is not None:
            with _LOCK:
                _MADE.setdefault(owner, []).append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
