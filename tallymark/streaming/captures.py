"""Structured Streaming over a landing folder: an extension of the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import validation as V


def landed(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def classified(captures: DataFrame) -> DataFrame:
    """Adds outcome to a (batch or streaming) DataFrame of html, capture_kind."""
    return captures.withColumn("outcome", V.outcome(F.col("html"), F.col("capture_kind")))


def challenges_by_window(events: DataFrame, size: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "run").agg(F.count("*").alias("challenges"))


def first_blobs(captures: DataFrame, late: str = "1 day") -> DataFrame:
    """Captures of contents not seen before within the watermark."""
    hashed = captures.withColumn("content_hash", F.sha2(F.col("html").cast("binary"), 256))
    return hashed.withWatermark("collected_at", late).dropDuplicatesWithinWatermark(["content_hash"])


def start(df: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    return df.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)
