"""Joins and lookups.

No broadcast hints on caller data: Spark broadcasts a side whose measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise, splitting skewed
partitions at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(rows: DataFrame, key: str, value: str, version: str) -> DataFrame:
    """``(key, value)`` with one row per key, the one with the highest version.

    Of equal versions the highest value counts; a NULL version is below all others, and a NULL value below
    all of its version.
    """
    latest = F.max(F.struct(F.col(version).alias("version"), F.col(value).alias("value")))
    return rows.groupBy(key).agg(latest.alias("_latest")).select(key, F.col("_latest.value").alias(value))


def looked_up(totals: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Each total with its dimension value, NULL where the dimension lacks the key.

    Both sides hold one row per key (aggregate first), so no key is frequent.
    """
    return totals.join(dimension, key, "left")


def key_match_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: sizes of both sides and of their inner join, and rows without a partner.

    The join's size is a decimal, as a key frequent on both sides can exceed 64 bits.
    Both sides are reduced to counts per key, which give the join's size by multiplication;
    the joined rows are never formed.
    """
    sides = left.select(F.col(key), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(F.col(key), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_key = sides.groupBy(key).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    matched = F.col(key).isNotNull()
    lonely = lambda mine, other: F.sum(F.when(matched & (F.col(other) > 0), 0).otherwise(F.col(mine)))
    return per_key.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.when(matched, F.col("l").cast("decimal(38,0)") * F.col("r"))), F.lit(0)).alias("joined_rows"),
        F.coalesce(lonely("l", "r"), F.lit(0)).alias("left_without_partner"),
        F.coalesce(lonely("r", "l"), F.lit(0)).alias("right_without_partner"),
    )


def paired_with(df: DataFrame, values: Sequence[int | float | str], name: str) -> DataFrame:
    """Every row with every value of a short fixed list: the Cartesian product with a constant.

    A product of two tables is not offered; its output outgrows any cluster.
    """
    return df.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))


def dimension_counts(
    facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, dimension_id: str
) -> DataFrame:
    """The dimension with ``n``, the number of facts whose key equals its own; 0 where none does.

    Facts are matched before they are counted, so values outside the dimension, of which
    free text has any number, are not shuffled when the dimension is small.
    """
    keys = dimension.select(F.col(dimension_id), F.col(dimension_key).alias("_key"))
    hits = facts.select(F.col(fact_key).alias("_fact")).join(keys, F.col("_fact") == F.col("_key"))
    counts = hits.groupBy(dimension_id).agg(F.count(F.lit(1)).alias("n"))
    return dimension.join(counts, dimension_id, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
