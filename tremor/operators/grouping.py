"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Each limb of a sum holds 40 bits less than the one before. Doubles are cut there without a loss.
_LIMB = float(1 << 40)
#: From here on a value has no room in the first limb.
_HUGE = float(1 << 93)


def exact_sum(value: Column | str) -> Column:
    """Sum as a double that does not depend on the order in which partitions arrive.

    A plain sum of doubles does, so a retried task could change its last digits. Here every value is cut into
    whole multiples of 2 ** 40, 1, 2 ** -40, 2 ** -80 and 2 ** -120, whose sums are exact; nothing above
    2 ** -121 is lost. Values from 2 ** 93 on, infinities and NaN are added as they are. NULL values add
    nothing, and without any other the sum is NULL. Round the result, if at all.
    """
    column = (F.col(value) if isinstance(value, str) else value).cast("double")
    huge = F.isnan(column) | (F.abs(column) >= _HUGE)
    rest = F.when(~huge, column) / _LIMB
    limbs = []
    for _ in range(5):
        limbs.append(F.sum(F.rint(rest).cast("decimal(20,0)")).cast("double"))
        rest = (rest - F.rint(rest)) * _LIMB
    whole = limbs.pop()
    while limbs:
        whole = limbs.pop() + whole / _LIMB
    whole = whole * _LIMB
    beyond = F.sum(F.when(huge, column))
    return F.coalesce(whole + beyond, whole, beyond)


def word_counts(df: DataFrame, words: Column, weight: Column | None = None) -> DataFrame:
    """``(word, n)`` over an array expression, most frequent first.

    With ``weight`` each row stands for that many equal rows.
    """
    weight = F.lit(1) if weight is None else weight
    exploded = df.select(F.explode(words).alias("word"), weight.cast("bigint").alias("_weight"))
    counts = exploded.groupBy("word").agg(F.sum("_weight").alias("n"))
    return counts.orderBy(F.desc("n"), "word")


def grouped_values(df: DataFrame, key: str, value: str, spread: Column, max_values: int) -> DataFrame:
    """The values of each key as sorted arrays ``(key, slice, values)`` of about ``max_values`` each.

    NULL values are kept, last in their array. A key of n values gives ``ceil(n / max_values)``
    rows: one row has to fit into memory, and a key may hold a third of all rows. It is cut by ``spread``, a whole
    number that differs between the rows of a key and has no pattern, such as a hash of a row
    id, or by a hash of the row where that is NULL. The explicit repartition keeps the grouping from
    reusing the join's partitioning, which would put all slices of a frequent key back into
    one task.
    """
    rows = df.select(F.col(key), F.col(value), F.coalesce(spread, F.xxhash64(*df.columns)).alias("_spread"))
    slices = rows.groupBy(F.col(key).alias("_key")).agg(F.ceil(F.count(F.lit(1)) / F.lit(max_values)).alias("_slices"))
    sliced = rows.join(slices, rows[key].eqNullSafe(slices["_key"])).withColumn(
        "slice", F.pmod(F.col("_spread"), F.col("_slices"))
    )
    spread_out = sliced.repartition(key, "slice")
    # Wrapped, as collect_list leaves NULLs out.
    wrapped = F.collect_list(F.struct(F.col(value).alias("value")))
    values = F.array_sort(F.transform(wrapped, lambda v: v["value"]))
    return spread_out.groupBy(key, "slice").agg(values.alias("values"))
