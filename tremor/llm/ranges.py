"""Cutting a table into ranges of ids by values the table holds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_bounds(rows: DataFrame, parts: int, doc_id: str = "doc_id") -> np.ndarray:
    """Ids of the table, ascending, that end about ``parts`` ranges of equal rows; the last is the largest."""
    shares = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    found = rows.agg(F.percentile_approx(doc_id, shares, 10_000).alias("cuts"), F.max(doc_id).alias("top")).first()
    return np.unique([*(found.cuts or []), *([] if found.top is None else [found.top])]).astype(np.int64)


def range_part(doc_id: Column, bounds: np.ndarray) -> Column:
    """``part``, the number of the id's range (0 for NULL), and ``bound``, whether the id ends it."""

    @F.pandas_udf("part int, bound boolean")
    def part_of(ids: pd.Series) -> pd.DataFrame:
        own = ids.astype("Int64")
        numbers = own.fillna(0).to_numpy(np.int64)
        known = ~own.isna().to_numpy()
        part = np.where(known, np.searchsorted(bounds, numbers), 0).astype(np.int32)
        ends = known & (bounds[part] == numbers) if len(bounds) else np.zeros(len(own), bool)
        return pd.DataFrame({"part": part, "bound": ends})

    return part_of(doc_id)
