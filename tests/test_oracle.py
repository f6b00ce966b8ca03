"""Every registered query gives the rows of its SQL counterpart."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from tests.helpers import duck, duck_bag, spark_bag
from tremor.plans.registry import ORACLES as SQL
from tremor.plans.registry import QUERIES



@pytest.fixture(scope="module")
def data():
    """At this size there are more than ten places, so that a top 10 is a real cut."""
    folder = "/root/testdata/sf0.01"
    connection = duck(folder)
    yield folder, connection
    connection.close()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_same_rows(spark, data, key):
    folder, connection = data
    columns, rows = spark_bag(QUERIES[key](spark, folder))
    expected_columns, expected = duck_bag(connection, SQL[key])
    assert columns == expected_columns
    assert sum(rows.values()) == sum(expected.values())
    assert rows == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_flagship_runs(spark):
    rows = entry_point.entry(spark).collect()
    counts = [row.location_count for row in rows]
    assert 0 < len(rows) <= 10
    assert counts == sorted(counts, reverse=True)


ORDERED = {
    "sort_by_key": lambda r: r.k,
    "sort_column": lambda r: (r.o_orderpriority, r.o_orderkey),
    "wordcount": lambda r: (-r.n, r.word.encode()),
    "agg_sales_by_product": lambda r: (-r.sub_total, r.product_id),
    "join_broadcast_lookup": lambda r: (-r.n_chars, r.doc_id),
    "json_location_count": lambda r: -r.n,
    "sql_sum_by_country": lambda r: (-r.UnitPrice, r.Country),
    "topk_locations": lambda r: (-r.location_count, r.location),
    "topk_smallest": lambda r: (r.o_totalprice, r.o_orderkey),
}


@pytest.mark.parametrize("key", sorted(ORDERED))
def test_rows_come_in_order(spark, key):
    rows = QUERIES[key](spark, "/root/testdata/sf0.001").collect()
    places = [ORDERED[key](row) for row in rows]
    assert len(rows) > 1 and places == sorted(places)
