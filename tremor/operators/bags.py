"""Set and bag operations. NULL equals NULL, as it does for the values of a collection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bag_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both sides, duplicates kept."""
    return left.unionByName(right)


def distinct_intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows on both sides, once each.

    One grouped pass over the union instead of a semi join followed by a distinct: copies
    of a frequent row collapse before the only shuffle.
    """
    columns = left.columns
    tagged = left.withColumns({"_l": F.lit(1), "_r": F.lit(0)}).unionByName(
        right.withColumns({"_l": F.lit(0), "_r": F.lit(1)})
    )
    sides = tagged.groupBy(*columns).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return sides.where("_l = 1 AND _r = 1").select(*columns)


def bag_subtract(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows that equal no right row; the copies of a surviving row are all kept.

    The right side is made distinct first, so only the left side can hold a frequent key,
    and that is the side an adaptive anti join splits.
    """
    columns = left.columns
    others = right.select(*[F.col(c).alias(f"_r_{c}") for c in columns]).distinct()
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(others[f"_r_{c}"]) for c in columns])
    return left.join(others, same, "left_anti")
