"""Readers for stored tables and generated ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored_table(
    spark: SparkSession, fmt: str = "parquet", path: str | None = None, schema: str | None = None, **options: str
) -> DataFrame:
    """A persisted table through any installed data source (parquet, jdbc, a store's connector)."""
    return spark.read.format(fmt).options(**options).load(path, schema=schema)


def number_range(spark: SparkSession, start: int, stop: int, step: int, name: str = "id") -> DataFrame:
    """Whole numbers from ``start`` up to but not including ``stop``."""
    return spark.range(start, stop, step).withColumnRenamed("id", name)
