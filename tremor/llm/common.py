"""Helpers that several operators share: stored steps, bounded groups, text pieces."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.workspace import new_folder, ship_package

# Fixed value: a word is a run of anything but a space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The rows, written below ``spark.checkpoint.dir`` and read back.

    It cuts the lineage: a lost executor costs the tasks at hand, not what came before, and
    later passes read the result instead of computing it again.
    """
    spark = df.sparkSession
    folder = new_folder(spark, f"llm-{label}")
    df.write.parquet(folder, compression=compression)
    return spark.read.schema(df.schema).parquet(folder)


def prepared(spark: SparkSession) -> None:
    """What a session needs for the operators that run Python.

    Texts are long, so Arrow batches are bounded at 8 MB instead of Spark's default of 64, unless
    the session has a bound of its own; each task holds a few of them. The executors get this
    package, once a session, unless they share its folder by PYTHONPATH.
    """
    if spark.conf.get(_BATCH_BYTES) == "67108864b":
        spark.conf.set(_BATCH_BYTES, "8m")
    ship_package(spark)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8(text: str | Column) -> Column:
    """A text's UTF-8 bytes, which Arrow hands to Python without decoding. NULL counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def bounded_groups(postings: DataFrame, key: str, member: Column, block: int) -> DataFrame:
    """``(key, i, j, members)`` such that any two members of a key meet in at least one array.

    Keys with one member are left out. A key of up to ``block`` members gives one array. A
    larger one is cut into chunks by a hash of the member, and every pair of chunks ``i <= j``
    gives an array, so none exceeds about ``2 * block`` members, a frequent key is worked on by
    many tasks, and still no pair is lost. Elements are ``(chunk, member)``: two members of the
    same chunk meet in several arrays, but in one with ``i = j`` only.
    """
    rows = postings.select(F.col(key).alias("_key"), member.alias("_member"))
    sizes = rows.groupBy(F.col("_key").alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    sized = rows.join(sizes, F.col("_key") == F.col("_k"))
    chunks = F.ceil(F.col("_n") / F.lit(block))
    mine = F.pmod(F.xxhash64("_member"), chunks)
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("i"), F.lit(0).cast("bigint").alias("j")))
    cut = F.transform(
        F.sequence(F.lit(0).cast("bigint"), chunks - 1),
        lambda other: F.struct(F.least(mine, other).alias("i"), F.greatest(mine, other).alias("j")),
    )
    element = F.struct(mine.alias("chunk"), F.col("_member").alias("member")).alias("_element")
    placed = sized.select("_key", element, F.explode(F.when(chunks == 1, whole).otherwise(cut)).alias("_block"))
    groups = placed.groupBy(F.col("_key").alias("key"), F.col("_block.i").alias("i"), F.col("_block.j").alias("j"))
    return groups.agg(F.collect_list("_element").alias("members")).where(F.size("members") > 1)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for ``mapInArrow``, after which the worker gives freed memory back to the machine.

    Workers wait for their next task beside the JVM; what they hold meanwhile is lost to both.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return task


def trim() -> None:
    """Freed memory goes back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trimming = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trimming:
        trimming(0)


def numbered_columns(docs: DataFrame) -> DataFrame:
    """The same rows with columns ``c0``, ``c1``, ... so that no name can clash with another."""
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])


def strings_over(offsets: np.ndarray, raw: bytes) -> pa.StringArray:
    """Strings between the offsets of their bytes, which are taken as they are."""
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw))


def slices(values: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of a binary array that hold about ``most`` bytes, or a single longer value."""
    if not len(values):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False))
    first, before = 0, 0
    while first < len(values):
        last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield first, last
        first, before = last, int(ends[last - 1])
