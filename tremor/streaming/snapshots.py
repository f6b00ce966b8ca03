"""Per-batch result tables, one folder per batch so that a replayed batch replaces its rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators.ranking import top_k


def write_batch(rows: DataFrame, root: str, batch_id: int) -> None:
    """The batch's folder, and then the one-row table beside ``root`` that names the newest batch."""
    rows.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")
    newest = rows.sparkSession.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id"))
    newest.coalesce(1).write.mode("overwrite").parquet(f"{root}_newest")


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """All batches, with a ``batch_id`` column."""
    return spark.read.parquet(root).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def last_batch(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the newest batch: two folders are read, however many batches there are.

    If a writer was lost while it named the newest batch, all batches are looked through.
    """
    try:
        named = spark.read.schema("batch_id BIGINT").parquet(f"{root}_newest").first()
    except AnalysisException:
        named = None
    newest = named.batch_id if named else read_batches(spark, root).agg(F.max("batch_id")).first()[0]
    return spark.read.parquet(f"{root}/batch_id={newest}")


def top_places(counts: DataFrame, k: int = 10) -> DataFrame:
    return top_k(counts, "location_count", k, "location")


def dashboard_payload(top: DataFrame) -> DataFrame:
    """One row of two parallel arrays, ``label`` and ``data``, highest count first.

    For the few rows of a top-k only: they are gathered into one row.
    """
    entry = F.struct((-F.col("location_count")).alias("rank"), "location", "location_count")
    ordered = top.agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    return ordered.select(
        F.col("entries.location").alias("label"), F.col("entries.location_count").alias("data")
    )


def as_json_fields(payload: DataFrame) -> DataFrame:
    """The payload's arrays as JSON text, the form in which a dashboard takes them."""
    return payload.select(F.to_json("label").alias("label"), F.to_json("data").alias("data"))
