"""The queries of this subpackage; SQL only where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tremor.llm.common import prepared

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        @wraps(query)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepared(spark)
            return query(spark, sf_dir)

        QUERIES[query.__name__] = shipped
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return add
