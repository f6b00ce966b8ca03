"""Sorting and top-k with a total order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.workspace import new_folder


def _order(by: str | Column, descending: bool, ties: tuple[str, ...]) -> list[Column]:
    column = F.col(by) if isinstance(by, str) else by
    return [column.desc() if descending else column.asc(), *[F.col(t).asc() for t in ties]]


def sorted_by(df: DataFrame, by: str | Column, *ties: str, descending: bool = False) -> DataFrame:
    """Global sort.

    The tie columns make the order repeatable, and let the range partitioner cut through
    a sort value that many rows share instead of sending them all to one task.
    """
    return df.orderBy(*_order(by, descending, ties))


def top_k(df: DataFrame, by: str | Column, k: int, *ties: str, descending: bool = True) -> DataFrame:
    """The first ``k`` rows of the order; each task keeps ``k`` rows, nothing is sorted in full."""
    return df.orderBy(*_order(by, descending, ties)).limit(k)


def running_totals(df: DataFrame, order: list[str], value: str, scale: int = 2) -> DataFrame:
    """``df`` with ``rank``, from 1, in the order of the columns, and ``running``, the exact sum of ``value``
    (to ``scale`` decimals) up to and with the row.

    The rows are sorted into ranges, of which every task ranks and sums one; what comes before a range is
    added from a row per range. So no task sees the whole, and rows that are equal in all of ``order``
    may be cut anywhere: they come in any order among themselves. The sorted rows are
    written once, as the second pass has to meet the same ranges. NULL values add nothing.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = new_folder(spark, "ranked")
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    ordered = salted.repartitionByRange(tasks, *order, "_salt").sortWithinPartitions(*order, "_salt")
    places = {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}
    ordered.withColumns(places).write.parquet(folder)
    rows = spark.read.parquet(folder).withColumn("_value", F.col(value).cast(f"decimal(28,{scale})"))
    # A row per task.
    totals = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.sum("_value").alias("total")).orderBy("_part").collect()
    bases, count, total = [], 0, Decimal(0)
    for part in totals:
        bases.append((part._part, count, total))
        count, total = count + part.n, total + (part.total or 0)
    before = spark.createDataFrame(bases, f"_range int, _rows bigint, _sum decimal(38,{scale})")
    within = Window.partitionBy("_part").orderBy("_at")
    summed = F.sum("_value").over(within.rowsBetween(Window.unboundedPreceding, 0))
    numbered = rows.withColumns({"_number": F.row_number().over(within), "_running": F.coalesce(summed, F.lit(0))})
    joined = numbered.join(before, F.col("_part") == F.col("_range"))
    return joined.select(
        *df.columns,
        (F.col("_rows") + F.col("_number")).alias("rank"),
        (F.col("_sum") + F.col("_running")).cast(f"decimal(38,{scale})").alias("running"),
    )
