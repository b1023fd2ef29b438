"""The monitor as a stream: new lines of log files, counted per file as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voxmill.jobs.logs import log_counts


def follow(spark: SparkSession, folder: str) -> DataFrame:
    lines = spark.readStream.format("text").load(folder)
    return lines.select(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1).alias("file"), F.col("value").alias("line"))


def watch(spark: SparkSession, folder: str, name: str, seconds: int = 600) -> StreamingQuery:
    """Running counts per log file in the in-memory table ``name``, every ``seconds``."""
    return log_counts(follow(spark, folder)).writeStream.outputMode("complete").format("memory").queryName(name).trigger(processingTime=f"{seconds} seconds").start()
