"""Mixing sources to target weights, in blocks of a fixed number of words.

Each source's documents are packed end to end into blocks. The mix is a number of output shards;
how many blocks a shard takes from each source is a multinomial draw from the quotas that are
left, so shards vary as random draws do while the totals meet the quotas exactly. A source's
slots run through all its blocks in the order of a pseudorandom index permutation, another one
for each pass, and the blocks are joined to the slots by their index.

The mix is a table of its shards: for each place of a shard its source, block and pass, and the words of the
documents that the block holds. Totals and mixed documents are read off that table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm.common import WORD, numbered_columns, stored
from tremor.llm.numbering import with_offsets
from tremor.llm.permute import permuted
from tremor.llm.spans import let
from tremor.workspace import new_folder


@dataclass(frozen=True)
class Mix:
    """``weights`` repeat over the sources in code point order, NULL last."""

    weights: tuple[float, ...] = (5, 2, 1)
    most_passes: int = 3
    block_words: int = 64
    shards: int = 256
    seed: int = 20


def word_count(text: str) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0))).cast("bigint")


def targets(sizes: Sequence[int], weights: Sequence[float], most_passes: float) -> list[float]:
    """What each source gives: shares of the whole by weight, none above ``most_passes`` times its size.

    What a source cannot take goes to the others by weight, again and again until nothing is above.
    """
    whole = float(sum(sizes))
    caps = [most_passes * float(s) for s in sizes]
    result = [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        rest = whole - sum(caps[i] for i in range(len(sizes)) if i not in free)
        weight = sum(weights[i] for i in free)
        shares = {i: rest * weights[i] / weight for i in free}
        above = {i for i in free if shares[i] > caps[i]}
        if not above:
            for i in free:
                result[i] = shares[i]
            break
        free -= above
        for i in above:
            result[i] = caps[i]
    return result


def shard_draws(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """``[shard, source]`` counts: multinomial draws from what is left, cut to it; columns sum to the quotas."""
    rng = np.random.default_rng(seed)
    left = np.array(quotas, np.int64)
    drawn = np.zeros((shards, len(left)), np.int64)
    for shard in range(shards):
        room = -(-int(left.sum()) // (shards - shard))
        while room and left.any():
            take = np.minimum(rng.multinomial(room, left / left.sum()), left)
            drawn[shard] += take
            left -= take
            room -= int(take.sum())
    return drawn


def _sources(sized: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: number, size, target, blocks and block quota.

    The sources are those that a mix is configured for, so their list is short, and the
    driver works out the targets.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = totals.orderBy(F.col("source").asc_nulls_last()).collect()
    sizes = [r.source_size for r in rows]
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(rows))]
    aims = targets(sizes, weights, mix.most_passes)
    table = []
    for number, (row, aim) in enumerate(zip(rows, aims, strict=True)):
        blocks = -(-row.source_size // mix.block_words)
        passes = int(aim // row.source_size) if row.source_size else 0
        part = round((aim - passes * row.source_size) / mix.block_words) if blocks else 0
        quota = min(passes * blocks + part, mix.most_passes * blocks)
        table.append((number, row.source, row.source_size, float(aim), blocks, quota))
    schema = "source_no int, _source string, source_size bigint, target double, blocks bigint, quota bigint"
    return sized.sparkSession.createDataFrame(table, schema)


def _slots(sources: DataFrame, mix: Mix) -> DataFrame:
    """``(source_no, block, pass_no, shard, place)``: the block each slot of the mix takes. The slots of a shard,
    of all its sources, are shuffled over its places."""
    rows = sources.select("source_no", "blocks", "quota").orderBy("source_no").collect()
    spark = sources.sparkSession
    drawn = shard_draws([r.quota for r in rows], mix.shards, mix.seed) if rows else np.zeros((0, 0), np.int64)
    firsts = np.cumsum(drawn, axis=0) - drawn
    befores = np.cumsum(drawn, axis=1) - drawn
    table = [
        (r.source_no, r.blocks, shard, int(firsts[shard, k]), int(drawn[shard, k]), int(befores[shard, k]), int(drawn[shard].sum()))
        for k, r in enumerate(rows)
        for shard in range(len(drawn))
        if drawn[shard, k]
    ]
    columns = "source_no int, blocks bigint, shard int, first bigint, n bigint, before bigint, shard_size bigint"
    counts = spark.createDataFrame(table, columns)
    # Two steps, so that no row explodes into more than a few thousand at once.
    starts = F.sequence(F.col("first"), F.col("first") + F.col("n") - 1, F.lit(4096).cast("bigint"))
    parts = counts.repartition(mix.shards).withColumn("start", F.explode(starts))
    last = F.least(F.col("start") + 4095, F.col("first") + F.col("n") - 1)
    slots = parts.withColumn("slot", F.explode(F.sequence("start", last)))
    seed = mix.seed

    @F.pandas_udf("bigint")
    def block_of(slot: pd.Series, blocks: pd.Series, source_no: pd.Series) -> pd.Series:
        n = blocks.to_numpy()
        turn = slot.to_numpy() // n
        keys = (np.int64(seed) * 1_000_003 + source_no.to_numpy().astype(np.int64)) * 1_009 + turn
        return pd.Series(permuted(slot.to_numpy() % n, n, keys))

    @F.pandas_udf("bigint")
    def place_of(at: pd.Series, size: pd.Series, shard: pd.Series) -> pd.Series:
        keys = np.int64(seed) * 1_000_003 + 500_009 + shard.to_numpy().astype(np.int64)
        return pd.Series(permuted(at.to_numpy(), size.to_numpy(), keys))

    return slots.select(
        "source_no",
        block_of("slot", "blocks", "source_no").alias("block"),
        F.floor(F.col("slot") / F.col("blocks")).cast("int").alias("pass_no"),
        "shard",
        place_of(F.col("before") + F.col("slot") - F.col("first"), "shard_size", "shard").alias("place"),
    )


def _plan(docs: DataFrame, mix: Mix, text: str, doc_id: str) -> DataFrame:
    """Every row's id, text hash, size, source facts and place in its source; no texts."""
    content = F.coalesce(F.col(text), F.lit(""))
    sized = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.xxhash64(content).alias("text_hash"),
        "source",
        word_count(text).alias("size"),
    )
    return stored(sized, "mix-sizes")


def _drawn(sized: DataFrame, folder: str, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """The rows with their places in their sources, and the mix, which is written to the folder shard by shard:
    ``(shard, place, source, block, pass_no, doc_id, text_hash, source_no, position, size, first, last)``."""
    sources = _sources(sized, mix)
    placed = sized.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    numbered = with_offsets(placed, F.col("size"), "position", "source_no", ("doc_id", "text_hash"))
    plan = stored(numbered, "mix-plan")
    words = F.lit(mix.block_words)
    start, end = F.col("position"), F.col("position") + F.col("size")
    blocks = F.sequence(F.floor(start / words), F.floor((end - 1) / words))
    pieces = plan.where("size > 0").select(
        "doc_id", "text_hash", "source", "source_no", "position", "size", F.explode(blocks).alias("block")
    )
    pieces = pieces.withColumns(
        {
            "first": F.greatest(F.col("block") * words, start) - start,
            "last": F.least((F.col("block") + 1) * words, end) - start,
        }
    )
    # Spark takes the slots for as small as the few rows they come from; they grow with the mix.
    met = pieces.join(_slots(sources, mix).hint("merge"), ["source_no", "block"])
    met.repartition("shard").sortWithinPartitions("shard", "place", "position").write.partitionBy("shard").parquet(folder)
    return plan, read_mix(sized.sparkSession, folder)


_MIX = (
    "place bigint, source string, block bigint, pass_no int, doc_id bigint, text_hash bigint, source_no int, "
    "position bigint, size bigint, first bigint, last bigint, shard int"
)


def read_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The mix in a folder: the words ``first`` to before ``last`` of the document are at the ``place`` of the shard."""
    return spark.read.schema(_MIX).parquet(folder)


def write_mix(docs: DataFrame, folder: str, mix: Mix, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Writes the mix of the documents' words, one folder per shard, and returns it as ``read_mix`` does.

    Of shard s and source k it holds as many places as ``shard_draws`` drew, without gaps from 0. NULL sources,
    texts and ids and repeated rows are as in ``mix_totals``. An empty table gives an empty mix.
    """
    _, draws = _drawn(_plan(docs, mix, text, doc_id), folder, mix)
    return draws


def mix_totals(docs: DataFrame, mix: Mix, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row.

    ``taken`` counts the words the mix takes from the document, repeats included: at most
    ``most_passes`` times its size, as no pass visits a block twice. A NULL source is a source of
    its own, a NULL text has no words, NULL ids and repeated rows keep places of their own, other
    columns are not read, and an empty table gives an empty result.
    """
    plan, draws = _drawn(_plan(docs, mix, text, doc_id), new_folder(docs.sparkSession, "llm-mix"), mix)
    taken = draws.groupBy(F.col("source_no").alias("_s"), F.col("position").alias("_p")).agg(
        F.sum(F.col("last") - F.col("first")).alias("n")
    )
    # A document without words shares its place with the next one, but nothing is taken from it.
    same = (F.col("source_no") == F.col("_s")) & (F.col("position") == F.col("_p")) & (F.col("size") > 0)
    return plan.join(taken, same, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("n", F.lit(0).cast("bigint")).alias("taken")
    )


def mixed_documents(docs: DataFrame, mix: Mix, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each pass that takes words of a document.

    A pass that takes all its words gives the text as it is; another gives the words it takes,
    joined by spaces. ``n_chars``, if there, is counted anew. Rows that repeat both id and text
    count as one document here. Documents without words take no part in a mix.
    """
    rows = numbered_columns(docs)
    own_text, own_id = (f"c{docs.columns.index(name)}" for name in (text, doc_id))
    sized = _plan(docs, mix, text, doc_id)
    once = sized.dropDuplicates(["doc_id", "text_hash"])
    marked = rows.withColumn("own_hash", F.xxhash64(F.coalesce(F.col(own_text), F.lit(""))))
    if sized.count() > once.count():
        sized = stored(once, "mix-distinct")
        marked = marked.dropDuplicates([own_id, "own_hash"])
    _, draws = _drawn(sized, new_folder(docs.sparkSession, "llm-mix"), mix)
    ranges = F.sort_array(F.collect_list(F.struct("first", "last")))
    taken = draws.groupBy("doc_id", "text_hash", "pass_no").agg(ranges.alias("ranges"), F.max("size").alias("size"))
    same = F.col(own_id).cast("bigint").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("text_hash"))
    joined = marked.join(taken, same)

    taken_words = let(
        F.regexp_extract_all(F.col(own_text), F.lit(WORD), F.lit(0)),
        lambda words: F.flatten(
            F.transform("ranges", lambda r: F.slice(words, (r["first"] + 1).cast("int"), (r["last"] - r["first"]).cast("int")))
        ),
    )
    n_taken = F.aggregate("ranges", F.lit(0).cast("bigint"), lambda n, r: n + r["last"] - r["first"])
    whole = n_taken == F.col("size")
    made = joined.withColumn(own_text, F.when(whole, F.col(own_text)).otherwise(F.array_join(taken_words, " ")))
    if "n_chars" in docs.columns:
        n_chars = f"c{docs.columns.index('n_chars')}"
        made = made.withColumn(n_chars, F.char_length(own_text).cast(docs.schema["n_chars"].dataType))
    return made.select(*rows.columns).toDF(*docs.columns)
