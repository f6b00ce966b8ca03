"""Merkle manifests, against plain Python."""

from __future__ import annotations

import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import docs_frame
from tremor.llm.common import documents
from tremor.llm.merkle import Shape, addresses, folded, leaf_digest, nodes_of, proofs, write_manifest
from tremor.llm.queries import op12_merkle_manifest
from tremor.workspace import new_folder

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def digest(*values):
    texts = [None if v is None else str(v) for v in values]
    return H(*["-" if t is None else f"{len(t.encode())}:{t}" for t in texts])


def levels_of(nodes, fan=8):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][k : k + fan]) for k in range(0, len(levels[-1]), fan)])
    return levels


def path(levels, k, fan=8):
    found = []
    for nodes in levels[:-1]:
        first = k - k % fan
        found.append(("".join(nodes[first:k]), "".join(nodes[k + 1 : first + fan])))
        k //= fan
    return found


def expected(leaves, fan=8):
    """Rows for ``(group, doc_id, leaf, claim)``."""
    groups = sorted({g for g, *_ in leaves}, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for group in groups:
        own = sorted([x[1:] for x in leaves if x[0] == group], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[group] = own, levels_of([leaf for _, leaf, _ in own], fan)
    top = levels_of([levels[-1][0] for _, levels in trees.values()], fan)
    rows = []
    for place, (own, levels) in enumerate(trees.values()):
        for k, (doc_id, leaf, claim) in enumerate(own):
            steps = path(levels, k, fan) + path(top, place, fan)
            end = folded(claim or leaf, steps)
            proof = H(*[b + a for b, a in steps])
            rows.append((doc_id, leaf, levels[-1][0], top[-1][0], proof, end, end == top[-1][0]))
    return sorted(rows, key=str)


def manifest_rows(spark, rows, shape):
    leaves = spark.createDataFrame(rows, "group string, doc_id bigint, leaf string, claim string")
    folder = new_folder(spark, "test-merkle")
    write_manifest(leaves, folder, shape)
    return sorted(map(tuple, proofs(spark, folder).collect()), key=str)


def test_whole_table(spark):
    rows = documents(spark, "/root/testdata/sf0.001").select(*COLUMNS).collect()
    leaves = []
    for doc_id, source, lang, n_chars, text in rows:
        claim = None
        if text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            claim = digest(doc_id, source, lang, n_chars, text.encode().lower().decode())
        leaves.append((lang, doc_id, digest(doc_id, source, lang, n_chars, text), claim))
    found = op12_merkle_manifest(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.collect()), key=str) == expected(leaves)


@pytest.mark.parametrize(("fan", "levels"), [(8, 1), (8, 2), (8, 5), (2, 7), (3, 4)])
def test_layout_is_a_permutation_with_subtrees_together(fan, levels):
    places = [addresses(d, np.arange(fan**d), levels, fan) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range(nodes_of(levels, fan)))
    if levels > 1:
        top, below = levels // 2, levels - levels // 2
        for subtree in range(fan**top):
            own = []
            for depth in range(top, levels):
                wide = fan ** (depth - top)
                own += places[depth][subtree * wide : (subtree + 1) * wide].tolist()
            assert sorted(own) == list(range(min(own), min(own) + nodes_of(below, fan)))


@pytest.mark.parametrize(("sizes", "shape"), [
    ([1, 8, 9, 64, 65, 200], Shape(8, 1)), ([1, 2, 3, 4, 5, 33], Shape(2, 2)), ([700, 0, 5], Shape(8, 2)), ([90], Shape(3, 4)),
])
def test_trees_of_many_tiers(spark, sizes, shape):
    rows = []
    for group, size in enumerate(sizes):
        name = [None, "", "b", "é", "a", "zz"][group]
        for k in range(size):
            rows.append((name, k * 7 % 1000, digest(group, k), digest("x") if k % 3 == 0 else None))
    assert manifest_rows(spark, rows, shape) == expected(rows, shape.fan)


def test_more_groups_than_a_block_holds(spark):
    rows = [(f"g{k % 30}", k, digest(k), None) for k in range(100)]
    assert manifest_rows(spark, rows, Shape(2, 2)) == expected(rows, 2)


def test_repeated_rows_and_null_ids(spark):
    """Two thirds of the rows are one row, which still comes out as often as it went in."""
    rows = [("a", 5, digest("same"), None)] * 400 + [("a", None, digest(k), None) for k in range(100)]
    rows += [(None, k // 2, digest(k), None) for k in range(100)]
    assert manifest_rows(spark, rows, Shape(8, 2)) == expected(rows)


def test_leaves_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, "Ünï\U0001f600"), (None, "x" * 2_000_000)]
    docs = docs_frame(spark, rows, lang=[None, "", "é", "-"], source=["s", None, "1:x", "s"])
    found = docs.select(*COLUMNS, leaf_digest(*COLUMNS).alias("leaf")).collect()
    assert [r.leaf for r in found] == [digest(*r[:5]) for r in found]


def test_path_and_empty_table(spark):
    leaves = spark.createDataFrame([("a", k, digest(k)) for k in range(20)], "group string, doc_id bigint, leaf string")
    folder = new_folder(spark, "test-merkle")
    write_manifest(leaves, folder)
    found = proofs(spark, folder, with_path=True)
    for row in found.collect():
        assert row.verified and folded(row.leaf, [tuple(step) for step in row.path]) == row.root
    empty = new_folder(spark, "test-merkle")
    write_manifest(leaves.limit(0), empty)
    assert proofs(spark, empty).collect() == []


def test_no_task_numbers_a_whole_tree(spark):
    leaves = spark.range(10).select(F.lit("a").alias("group"), F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    folder = new_folder(spark, "test-merkle")
    write_manifest(leaves, folder)
    plan = proofs(spark, folder)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "SinglePartition" not in plan
