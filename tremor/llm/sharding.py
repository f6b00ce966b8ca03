"""Sharding by a computed shuffle.

All rows get global numbers; a Feistel permutation with cycle walking moves number ``r`` of ``n``
to place ``p``, and ``p`` is slot ``p div shards`` of shard ``p mod shards``. Nothing is drawn or
stored: the same table and seed give the same shuffle, shard sizes differ by one at most, slots
have no gaps, and either side can be computed from the other for any row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import stored
from tremor.llm.numbering import with_offsets
from tremor.llm.permute import permuted, restored


def place(row_no, rows: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of each row number."""
    at = permuted(row_no, rows, seed)
    return at % shards, at // shards


def row_at(shard, slot, rows: int, shards: int, seed: int) -> np.ndarray:
    """The row number at each shard and slot: what a reader that resumes in mid-epoch asks for."""
    return restored(np.asarray(slot) * shards + np.asarray(shard), rows, seed)


def sharded(rows: DataFrame, shards: int, seed: int, order: tuple[str, ...]) -> DataFrame:
    """``rows`` with ``row_no``, ``shard`` and ``slot``.

    ``order`` names the columns that tell rows apart; rows equal in all of them may change
    places among themselves, which no result shows. NULLs and repeated rows are rows like any
    other; an empty table gives an empty result.
    """
    kept = stored(rows, "shard-rows")
    numbered = with_offsets(kept, F.lit(1), "row_no", None, order)
    total = kept.count()

    @F.pandas_udf("shard int, slot bigint")
    def placed(row_no: pd.Series) -> pd.DataFrame:
        shard, slot = place(row_no.to_numpy(), total, shards, seed)
        return pd.DataFrame({"shard": shard.astype(np.int32), "slot": slot})

    named = numbered.withColumn("_place", placed("row_no"))
    return named.select(*rows.columns, "row_no", "_place.shard", "_place.slot")
