"""Structured Streaming forms of the time operators; each gives, at the end of its input, what the batch form gives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or folder as a stream."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")


def tumbling(events: DataFrame, width: str = "1 day", late: str = "1 day") -> DataFrame:
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("v"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))


def deduplicated(events: DataFrame, keys: list[str], late: str = "56 days") -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def drained(df: DataFrame, folder: str, mode: str) -> DataFrame:
    """Runs a stream over all input that is there and returns the last state that it wrote.  A batch that is tried again writes
    its own folder again."""

    def put(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out" if mode == "complete" else f"{folder}/out/batch={n}")

    query = df.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(put).start()
    query.awaitTermination()
    return df.sparkSession.read.parquet(f"{folder}/out").drop(*([] if mode == "complete" else ["batch"]))


def sliding(events: DataFrame, width: str = "7 days", step: str = "1 day", late: str = "1 day") -> DataFrame:
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", width, step), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("v"))
