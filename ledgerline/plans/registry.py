"""Queries by name: a Spark plan over the tables of a folder, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


class Tables:
    """Lazy access to the tables of a folder: t.orders, t.lineitem ..."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str, *names: str, **frames: DataFrame) -> DataFrame:
        """Spark SQL with {name} for tables and frames."""
        return self.spark.sql(text, **{n: getattr(self, n) for n in names}, **frames)


def query(ids: str, oracle: str | None = None):
    """Registers plan(t: Tables) under its name."""

    def add(plan: Callable[[Tables], DataFrame]):
        name = plan.__name__
        QUERIES[name] = lambda spark, sf_dir: plan(Tables(spark, sf_dir))
        COVERS[name] = ids
        if oracle:
            ORACLES[name] = oracle
        return plan

    return add


def same_sql(name: str, ids: str, text: str, *tables: str) -> None:
    """A query whose text is the same SQL for Spark and for the oracle; tables stand as {table}."""
    QUERIES[name] = lambda spark, sf_dir: Tables(spark, sf_dir).sql(text, *tables)
    COVERS[name] = ids
    ORACLES[name] = text.format(**{t: t for t in tables})
