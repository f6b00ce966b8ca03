"""Mixing, and the permutation and numbering under it."""

from __future__ import annotations

import os
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import docs_frame
from tremor.llm import mixing, numbering
from tremor.llm.common import WORD
from tremor.llm.mixing import Mix
from tremor.llm.permute import permuted, restored
from tremor.llm.queries import op8_mix_sources
from tremor.workspace import new_folder

SF = "/root/testdata/sf0.01"


def slow_targets(sizes, weights, cap):
    """The excess handed on round by round, as the rule says it."""
    whole = sum(sizes)
    share = [whole * w / sum(weights) for w in weights]
    while excess := sum(max(0, s - cap * n) for s, n in zip(share, sizes, strict=True)):
        share = [min(s, cap * n) for s, n in zip(share, sizes, strict=True)]
        open_ = [i for i, (s, n) in enumerate(zip(share, sizes, strict=True)) if s < cap * n]
        if excess < 1e-9 or not open_:
            break
        for i in open_:
            share[i] += excess * weights[i] / sum(weights[k] for k in open_)
    return share


def test_query_meets_the_targets(spark):
    rows = op8_mix_sources(spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: r["size"] for r in rows} == {k: len(re.findall(WORD, d.text)) for k, d in docs.items()}
    per_source = defaultdict(int)
    for k, d in docs.items():
        per_source[d.source] += len(re.findall(WORD, d.text))
    names = sorted(per_source)
    aims = slow_targets([per_source[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 3)
    taken = Counter()
    for r in rows:
        source = docs[r.doc_id].source
        assert r.source_size == per_source[source]
        assert r.target == pytest.approx(aims[names.index(source)], rel=1e-9)
        assert 0 <= r.taken <= 3 * r["size"]
        taken[source] += r.taken
    for name, aim in zip(names, aims, strict=True):
        assert abs(taken[name] - aim) <= 2 * Mix().block_words
    assert sorted(op8_mix_sources(spark, SF).collect()) == sorted(rows)


def test_odd_rows(spark):
    texts = ["a b c", "", None, "a b c", "d " * 300, "d " * 300, " x\ty\x0bz "]
    ids = [1, 2, 3, None, 5, 5, 6]
    docs = docs_frame(spark, list(zip(ids, texts, strict=True)), source=["p", "p", None, None, "q", "q", "q"])
    rows = mixing.mix_totals(docs, Mix(block_words=4)).collect()
    assert sorted((r.doc_id or 0, r["size"]) for r in rows) == [(0, 3), (1, 3), (2, 0), (3, 0), (5, 300), (5, 300), (6, 3)]
    by = {(r.source_size, round(r.target, 6)) for r in rows}
    assert {s for s, _ in by} == {3, 603}
    assert sum(r.taken for r in rows) <= 609 + 8 and all(r.taken <= 3 * r["size"] for r in rows)
    assert mixing.mix_totals(docs_frame(spark, []), Mix()).collect() == []


def test_mixed_documents_hold_what_the_totals_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mix = Mix()
    totals = {r.doc_id: r for r in mixing.mix_totals(docs, mix).collect()}
    out = mixing.mixed_documents(docs, mix)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    texts = {r.doc_id: r.text for r in docs.collect()}
    words = Counter()
    for r in out.collect():
        mine = re.findall(WORD, r.text)
        words[r.doc_id] += len(mine)
        assert r.n_chars == len(r.text)
        assert r.text == texts[r.doc_id] or len(mine) < totals[r.doc_id]["size"]
    assert {k: n for k, n in words.items()} == {k: t.taken for k, t in totals.items() if t.taken}


def test_mixed_documents_of_odd_rows(spark):
    docs = docs_frame(spark, [(1, "a b"), (1, "a b"), (2, None), (None, "c d e"), (3, "")], source=["p"] * 5)
    out = mixing.mixed_documents(docs, Mix(block_words=2)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in out) == [(0, "c d e"), (1, "a b")]
    assert mixing.mixed_documents(docs_frame(spark, []), Mix()).collect() == []


def test_draws_meet_the_quotas():
    quotas = [0, 5, 1000, 37]
    drawn = mixing.shard_draws(quotas, 16, 1)
    assert drawn.sum(axis=0).tolist() == quotas
    assert drawn.sum(axis=1).max() - drawn.sum(axis=1).min() <= 1
    assert (drawn == mixing.shard_draws(quotas, 16, 1)).all()
    assert len({tuple(r) for r in drawn.tolist()}) > 4


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1009])
def test_permutation(n):
    at = np.arange(n)
    to = permuted(at, n, 7)
    assert sorted(to.tolist()) == at.tolist()
    assert (restored(to, n, 7) == at).all()
    if n > 50:
        assert (to != permuted(at, n, 8)).any() and np.abs(np.corrcoef(at, to)[0, 1]) < 0.2


def test_permutation_with_different_sizes():
    n = np.array([5, 5, 9, 2, 1])
    to = permuted([4, 0, 8, 1, 0], n, [1, 1, 2, 3, 4])
    assert (to < n).all() and (restored(to, n, [1, 1, 2, 3, 4]) == [4, 0, 8, 1, 0]).all()
    assert permuted([], 5, 1).size == 0


def test_offsets_run_through_the_table(spark, monkeypatch):
    monkeypatch.setattr(numbering, "BUCKET_ROWS", 16)
    rows = spark.range(300).select(
        (F.col("id") % 150).alias("doc_id"), "id", (F.col("id") % 3).alias("g"), (F.col("id") % 5).alias("w")
    )
    whole = numbering.with_offsets(rows, F.lit(1), "row", None, ("doc_id", "id")).collect()
    assert sorted(r.row for r in whole) == list(range(300))
    for group in range(3):
        own = sorted((r for r in numbering.with_offsets(rows, F.col("w"), "at", "g", ("doc_id", "id")).collect() if r.g == group), key=lambda r: (r["at"], r.w > 0))
        total = 0
        for r in sorted(own, key=lambda r: (r["at"], r.w)):
            assert r["at"] == total
            total += r.w


@pytest.mark.parametrize("fan", [1024, 3])
def test_equal_rows_are_dealt_over_buckets(spark, monkeypatch, fan):
    """A third of the rows are one row; numbers still run through, and depend on the data alone."""
    monkeypatch.setattr(numbering, "BUCKET_ROWS", 16)
    monkeypatch.setattr(numbering, "FAN", fan)
    monkeypatch.setattr(numbering, "UNEVEN", 2)
    same = spark.range(300).select(F.lit(7).alias("doc_id"), F.lit("a").alias("g"))
    rest = spark.range(1000, 1600).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "a").alias("g"))
    rows = same.unionByName(rest)
    for by, sizes in ((None, [900]), ("g", [300, 600])):
        one = numbering.with_offsets(rows, F.lit(1), "row", by).collect()
        groups = defaultdict(list)
        for r in one:
            groups[r.g if by else 0].append(r.row)
        assert sorted(len(v) for v in groups.values()) == sizes
        assert all(sorted(v) == list(range(len(v))) for v in groups.values())
        again = numbering.with_offsets(rows.repartition(7), F.lit(1), "row", by).collect()
        assert sorted(map(str, again)) == sorted(map(str, one))


def test_numbering_has_no_window_over_everything(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"))
    plan = numbering.with_offsets(rows, F.lit(1), "row")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan


def test_shards_hold_what_was_drawn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mix = Mix(shards=16)
    folder = new_folder(spark, "test-mix")
    table = mixing.write_mix(docs, folder, mix)
    places = {(r.shard, r.place): r for r in table.collect()}
    counts = Counter((s, r.source_no) for (s, _), r in places.items())
    per_source = table.select("source_no", "shard", "place").distinct().groupBy("source_no").count().orderBy("source_no").collect()
    drawn = mixing.shard_draws([r["count"] for r in per_source], mix.shards, mix.seed)
    assert counts == Counter({(s, k): int(n) for s, row in enumerate(drawn) for k, n in enumerate(row) if n})
    for shard in range(mix.shards):
        assert sorted(p for s, p in places if s == shard) == list(range(int(drawn[shard].sum())))
    # Sources lie mixed in a shard, and each place holds one block.
    first = [places[0, p].source_no for p in range(int(drawn[0].sum()))]
    assert first != sorted(first)
    blocks = table.groupBy("shard", "place").agg(F.count_distinct("source", "block", "pass_no").alias("n"), F.sum(F.col("last") - F.col("first")).alias("words"))
    assert blocks.agg(F.max("n"), F.max("words")).first() == (1, mix.block_words)
    assert (folder_names := {f"shard={s}" for s in range(16)}) and folder_names <= set(os.listdir(folder))
