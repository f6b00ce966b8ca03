"""Running totals over a whole table, or over each group of it, without a single task for either.

The rows' order is that of a hash bucket of the id, then of the id itself: as good as any for
packing or shuffling, a function of the data alone, and free of hot ranges. Sums are taken per
bucket first, then per thousand buckets, and so on; no window sees more than ``FAN`` of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.common import stored

#: Rows that a bucket holds on average.
BUCKET_ROWS = 1024
#: Buckets that are summed together.
FAN = 1024
#: How many times the average a bucket may hold before its equal rows are dealt to others.
UNEVEN = 8


def with_offsets(
    rows: DataFrame, weight: Column, name: str, by: str | None = None, order: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The rows with ``name``: the weights of all rows before it, within equal ``by`` if given.

    ``order`` decides within a bucket; where its first column repeats, a hash of the others
    spreads the repeats over buckets as well. Rows that are equal in all of them, if they are more than a
    bucket's worth, are dealt to buckets by their number among themselves, so that how many of them a bucket gets
    depends on the data alone.
    """
    kept = stored(rows.withColumn("_at", F.monotonically_increasing_id()), "numbering-rows")
    buckets = max(1, -(-kept.count() // BUCKET_ROWS))
    group = [F.col(by)] if by else []
    bucket = F.pmod(F.xxhash64(*order), F.lit(buckets))
    full = kept.groupBy(*group, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    hot = full.where(F.col("_n") > UNEVEN * BUCKET_ROWS)
    if hot.head(1):
        copies = _copies(kept, by, order)
        dealt = F.xxhash64(*order, F.floor(F.col("_copy") / BUCKET_ROWS))
        kept = stored(
            kept.join(copies, F.col("_at") == F.col("_copy_at"), "left")
            .withColumn("_bucket", F.pmod(F.when(F.col("_copy").isNull(), F.xxhash64(*order)).otherwise(dealt), F.lit(buckets)))
            .drop("_copy", "_copy_at"),
            "numbering-dealt",
        )
        bucket = F.col("_bucket")
    placed = kept.withColumns({"_bucket": bucket, "_weight": weight.cast("bigint")})
    totals = placed.groupBy(*[g.alias("_g") for g in group], F.col("_bucket").alias("_b")).agg(F.sum("_weight").alias("_total"))
    bases = _bases(totals, ["_g"] if by else [], buckets)
    inner = Window.partitionBy(*group, "_bucket").orderBy(*order, "_at").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_before", F.coalesce(F.sum("_weight").over(inner), F.lit(0)))
    same = F.col("_bucket") == F.col("_b")
    if by:
        same = same & F.col(by).eqNullSafe(F.col("_g"))
    joined = summed.join(bases, same).withColumn(name, F.col("_base") + F.col("_before"))
    return joined.select(*rows.columns, name)


def _bases(totals: DataFrame, group: list[str], buckets: int) -> DataFrame:
    """``(*group, _b, _base)`` from ``(*group, _b, _total)``: what the buckets before each hold together."""
    parent = F.floor(F.col("_b") / FAN)
    earlier = Window.partitionBy(*group, "_parent").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("_total").over(earlier), F.lit(0))
    placed = totals.withColumn("_parent", parent).withColumn("_base", within)
    if buckets <= FAN:
        return placed.select(*group, "_b", "_base")
    above = totals.groupBy(*[F.col(g).alias(f"{g}_up") for g in group], parent.alias("_b")).agg(F.sum("_total").alias("_total"))
    above = _bases(above.toDF(*group, "_b", "_total"), group, -(-buckets // FAN))
    named = above.toDF(*[f"{g}_up" for g in group], "_up", "_more")
    same = reduce(lambda a, g: a & F.col(g).eqNullSafe(F.col(f"{g}_up")), group, F.col("_parent") == F.col("_up"))
    return placed.join(named, same).select(*group, "_b", (F.col("_base") + F.col("_more")).alias("_base"))


def _copies(kept: DataFrame, by: str | None, order: tuple[str, ...]) -> DataFrame:
    """``(_copy_at, _copy)``: the number among its equals of every row that has more than a bucket's worth of them.

    Equal rows are numbered within the partition they were written in, and the partitions after each other, so
    no task sees them all.
    """
    keys = [*([by] if by else []), *order]
    part = F.shiftright("_at", 33).alias("_part")
    named = kept.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_at", part)
    names = [f"_k{i}" for i in range(len(keys))]
    heavy = named.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > BUCKET_ROWS)
    heavy = stored(heavy.select(F.struct(*names).alias("_key"), F.monotonically_increasing_id().alias("_heavy")), "numbering-heavy")
    fields = [F.col(f"_key.{n}").eqNullSafe(F.col(n)) for n in names]
    own = stored(
        named.join(heavy, reduce(lambda a, b: a & b, fields)).select("_heavy", "_part", "_at"), "numbering-copies"
    )
    sizes = own.groupBy(F.col("_heavy").alias("_h"), F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_h").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_h", "_p", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    number = F.row_number().over(Window.partitionBy("_heavy", "_part").orderBy("_at")) - 1
    numbered = own.withColumn("_number", number)
    joined = numbered.join(starts, (F.col("_heavy") == F.col("_h")) & (F.col("_part") == F.col("_p")))
    return joined.select(F.col("_at").alias("_copy_at"), (F.col("_start") + F.col("_number")).alias("_copy"))
