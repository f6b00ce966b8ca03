"""Sharding: the law, reproducibility, and computable places."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import docs_frame
from tremor.llm import sharding
from tremor.llm.queries import op3_sharding

SF = "/root/testdata/sf0.01"


def test_query_keeps_its_law(spark):
    rows = op3_sharding(spark, SF).collect()
    texts = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r["size"] == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
        assert r.law == "rows" and r.grown_shard is None
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    assert sorted(op3_sharding(spark, SF).collect()) == sorted(rows)
    ids = np.array([r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))])
    assert abs(np.corrcoef(ids, np.arange(len(ids)))[0, 1]) < 0.15


def test_odd_rows(spark):
    docs = docs_frame(spark, [(1, None), (1, None), (None, "x"), (None, None), (2, ""), (3, "y")])
    rows = sharding.sharded(docs.select("doc_id", "text", "_key"), 4, 1, ("doc_id", "text")).collect()
    assert sorted(r.row_no for r in rows) == list(range(6))
    assert Counter(r.shard for r in rows) == {0: 2, 1: 2, 2: 1, 3: 1}
    assert Counter((r.doc_id, r.text) for r in rows)[1, None] == 2
    assert sharding.sharded(docs_frame(spark, []).select("doc_id", "text"), 4, 1, ("doc_id",)).collect() == []


@pytest.mark.parametrize("rows", [1, 7, 8, 1001])
def test_places_can_be_computed_back(rows):
    numbers = np.arange(rows)
    shard, slot = sharding.place(numbers, rows, 8, 5)
    assert (sharding.row_at(shard, slot, rows, 8, 5) == numbers).all()
