"""Queries that have SQL give its rows."""

from __future__ import annotations

import pytest

from tests.helpers import duck, duck_bag, spark_bag
from tremor.llm import queries  # noqa: F401  (importing it registers the queries)
from tremor.llm.registry import ORACLES, QUERIES


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_rows(spark, key):
    folder = "/root/testdata/sf0.001"
    columns, rows = spark_bag(QUERIES[key](spark, folder))
    connection = duck(folder)
    expected_columns, expected = duck_bag(connection, ORACLES[key])
    connection.close()
    assert columns == expected_columns and rows == expected and rows
