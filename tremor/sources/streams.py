"""Streaming readers. Every reader yields one text line per row, in column ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """Lines of the text files in a folder, new files included as they arrive."""
    reader = spark.readStream.options(**options)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def socket_lines(spark: SparkSession, host: str, port: int, **options: str) -> DataFrame:
    """Lines from a TCP server. Not replayable after a failure: for demonstrations only."""
    return spark.readStream.format("socket").options(host=host, port=port, **options).load()


def kafka_lines(spark: SparkSession, **options: str) -> DataFrame:
    """Lines from a Kafka topic (needs Spark's Kafka package); the replayable live source."""
    records = spark.readStream.format("kafka").options(**options).load()
    return records.select(F.col("value").cast("string").alias("value"))
