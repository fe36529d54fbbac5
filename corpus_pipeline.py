"""The corpus pipeline: quality, near duplicates, benchmark passages, personal data, packing.

Each stage takes what the one before it stored and returns the columns of `documents` (the last: packed pieces).  As a
stage begins, the tables that the one before it wrote for itself in the same thread are no longer read and are deleted;
what the last one wrote stays, since its result reads it.  Stages make the session send small batches to Python.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontamination, near_dup, packing, pii, quality
from ledgerline.llm.store import drop, new_path, owned, small_batches, written

#: Not expressible in SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def _stage(place: int) -> Callable:
    """A stage: its tables are its own, those of the stage before it go."""
    owner = lambda sf_dir, n: f"pipeline {threading.get_ident()} {n} {sf_dir}"

    def made(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
        @wraps(work)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            drop(spark, owner(sf_dir, place - 1))
            small_batches(spark)
            with owned(owner(sf_dir, place)):
                return work(spark, docs, sf_dir)

        return run_stage

    return made


@_stage(0)
def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose quality score is below the threshold."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage(1)
def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return near_dup.deduplicated(docs)


@_stage(2)
def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a window of a benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage(3)
def _personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets and n_chars by the new length."""
    return pii.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


@_stage(4)
def _packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences: one row a piece, with its ids."""
    return packing.pack(docs)


STAGES = [("quality", _quality), ("near duplicates", _near_duplicates), ("decontamination", _decontamination), ("personal data", _personal_data), ("packing", _packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stored as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name, new_path(spark, f"pipeline-{name.replace(' ', '-')}"))
    return STAGES[-1][1](spark, docs, sf_dir)
