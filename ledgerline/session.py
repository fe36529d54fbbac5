"""Session defaults.  Sizes that depend on the cluster (shuffle partitions, split size) stay with the caller."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "ledgerline", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    defaults = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for k, v in (defaults | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
