"""A Merkle manifest of a dataset, in blocks of van Emde Boas layout.

Every group of rows (a tree) has its leaves in order; runs of ``fan`` neighbours become their parent
until one node is left, and the trees' roots become one root in the same way. Nodes are kept in blocks:
aligned subtrees of ``height`` levels over their leaves, each an array of digests in van Emde Boas order
(the top half of the levels first, then each subtree below it, both laid out likewise). Where a
node lies follows from its depth and number alone, so building a block and reading the siblings of a leaf
are index arithmetic. A block's root is a leaf of a block of the next tier, until a tree has one block.

A folder holds Parquet tables: ``forest/<tier>`` and ``crown/<tier>`` with the blocks (tree, block, n,
levels, nodes, root, alone; in the forest's first tier also doc_ids and claims), ``trees`` with the trees'
roots in their order, and ``shape`` with the numbers of tiers. A tree is named by ``tree_name`` of its group,
so that NULL differs from every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremor.llm.common import stored

_BLOCK = "tree string, block bigint, n int, levels int, nodes binary, root binary, alone boolean"
_LEAVES = ", doc_ids array<bigint>, claims array<binary>"
_PATH = "array<struct<before: string, after: string>>"
_STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


@dataclass(frozen=True)
class Shape:
    """``fan`` decides the digests; ``height``, the levels above a block's leaves, only the storage."""

    fan: int = 8
    height: int = 4

    @property
    def leaves(self) -> int:
        return self.fan**self.height


def leaf_digest(*columns: str | Column) -> Column:
    """Lower-case hex SHA-256 of the columns' values one after the other: byte count, colon and
    value in UTF-8 (numbers in decimals), or ``-`` for NULL."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def tree_name(group: Column) -> Column:
    """A text for each group, NULL included, in the groups' bytewise order with NULL first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def nodes_of(levels: int, fan: int) -> int:
    """Nodes of a complete tree."""
    return (fan**levels - 1) // (fan - 1)


def addresses(depth: int, index: np.ndarray, levels: int, fan: int) -> np.ndarray:
    """Where the nodes ``index`` at ``depth`` (the root's is 0) of a complete tree lie in its layout."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return addresses(depth, index, top, fan)
    below = levels - top
    subtree, inner = np.divmod(index, fan ** (depth - top))
    return nodes_of(top, fan) + subtree * nodes_of(below, fan) + addresses(depth - top, inner, below, fan)


def _levels(n: int, alone: bool, shape: Shape) -> int:
    """Node levels of a block of ``n`` leaves. Where a tree goes on above its blocks, all have their full height."""
    if not alone:
        return shape.height + 1
    levels = 1
    while shape.fan ** (levels - 1) < n:
        levels += 1
    return levels


def built(leaves: list[bytes], alone: bool, shape: Shape) -> tuple[int, bytes]:
    """A block's node levels and its digests in van Emde Boas order; nodes that do not exist are zeros."""
    fan, levels = shape.fan, _levels(len(leaves), alone, shape)
    nodes = np.zeros((nodes_of(levels, fan), 32), np.uint8)
    digests = b"".join(leaves)
    for depth in range(levels - 1, -1, -1):
        own = np.frombuffer(digests, np.uint8).reshape(-1, 32)
        nodes[addresses(depth, np.arange(len(own)), levels, fan)] = own
        text, run = digests.hex().encode(), 64 * fan
        digests = b"".join(sha256(text[at : at + run]).digest() for at in range(0, len(text), run))
    return levels, nodes.tobytes()


def level_texts(nodes: bytes, n: int, levels: int, fan: int) -> list[str]:
    """The digests of a block in hex, level by level from the leaves to below the root."""
    table = np.frombuffer(nodes, np.uint8).reshape(-1, 32)
    texts = []
    for depth in range(levels - 1, 0, -1):
        texts.append(table[addresses(depth, np.arange(n), levels, fan)].tobytes().hex())
        n = -(-n // fan)
    return texts


def siblings(texts: list[str], leaf: int, fan: int) -> list[tuple[str, str]]:
    """For a leaf of the block its siblings level by level: those before and those after, in hex."""
    found = []
    for text in texts:
        first, last = 64 * (leaf - leaf % fan), 64 * (leaf - leaf % fan + fan)
        found.append((text[first : 64 * leaf], text[64 * (leaf + 1) : last]))
        leaf //= fan
    return found


def folded(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf's digest and its siblings lead to, in hex."""
    for before, after in path:
        leaf = sha256((before + leaf + after).encode()).hexdigest()
    return leaf


def _numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """The leaves with ``rank`` in their tree and the tree's ``total``.

    The rows are sorted into ranges by the whole table's order, ``salt`` last, so that equal rows spread
    over ranges as well, and numbered within each; a row per range and tree then gives the offsets.
    """
    spark = leaves.sparkSession
    kept = [c for c in leaves.columns if c != "salt"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["tree", *order, "salt"]
    ordered = leaves.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    places = F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")
    inside = stored(ordered.select(*kept, *places), "merkle-sorted")
    sizes = inside.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    bases = sizes.select(
        F.col("tree").alias("_tree"),
        F.col("part").alias("_part"),
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("base"),
        F.sum("rows").over(whole).alias("total"),
    )
    joined = inside.join(bases, (F.col("tree") == F.col("_tree")) & (F.col("part") == F.col("_part")))
    return joined.select(*kept, (F.col("at") + F.col("base")).alias("rank"), "total")


def _blocks(nodes: DataFrame, shape: Shape, with_ids: bool) -> DataFrame:
    """The blocks over nodes ``(tree, rank, total, digest)``, each made by the task that gets its nodes."""

    def make(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        n, alone = table.num_rows, table["total"][0].as_py() <= shape.leaves
        levels, digests = built(table["digest"].to_pylist(), alone, shape)
        columns = {
            "tree": [table["tree"][0].as_py()],
            "block": pa.array([table["block"][0].as_py()], pa.int64()),
            "n": pa.array([n], pa.int32()),
            "levels": pa.array([levels], pa.int32()),
            "nodes": pa.array([digests], pa.binary()),
            "root": pa.array([digests[:32]], pa.binary()),
            "alone": [alone],
        }
        if with_ids:
            columns["doc_ids"] = pa.array([table["doc_id"].to_pylist()], pa.list_(pa.int64()))
            columns["claims"] = pa.array([table["claim"].to_pylist()], pa.list_(pa.binary()))
        return pa.table(columns)

    placed = nodes.withColumn("block", F.floor(F.col("rank") / shape.leaves))
    return placed.groupBy("tree", "block").applyInArrow(make, _BLOCK + (_LEAVES if with_ids else ""))


def _written(nodes: DataFrame, folder: str, shape: Shape, with_ids: bool) -> tuple[int, DataFrame]:
    """Writes all tiers of blocks; their number, and the trees' roots as ``(tree, digest)``."""
    spark, tier, roots = nodes.sparkSession, 0, None
    while True:
        path = f"{folder}/{tier}"
        _blocks(nodes, shape, with_ids and not tier).write.parquet(path)
        blocks = spark.read.parquet(path).select("tree", "block", "root", "alone")
        done = blocks.where("alone").select("tree", F.col("root").alias("digest"))
        roots = done if roots is None else roots.unionByName(done)
        tier += 1
        above = blocks.where("NOT alone")
        if not above.head(1):
            return tier, roots
        totals = above.groupBy(F.col("tree").alias("_tree")).agg(F.count(F.lit(1)).alias("total"))
        nodes = above.join(totals, F.col("tree") == F.col("_tree")).select(
            "tree", F.col("block").alias("rank"), "total", F.col("root").alias("digest")
        )


def write_manifest(leaves: DataFrame, folder: str, shape: Shape = Shape()) -> None:
    """Writes the manifest of ``(group, doc_id, leaf)`` rows, ``leaf`` in hex as ``leaf_digest`` gives it.

    Leaves of a group ascend by ``doc_id`` (NULL first) and, where it repeats, by digest; the groups
    ascend bytewise with NULL first. A column ``claim``, a digest in hex or NULL, is kept beside each leaf for
    ``proofs`` to verify. Other columns are not read. Without rows there are no blocks and no root.
    """
    spark = leaves.sparkSession
    claim = F.unhex("claim") if "claim" in leaves.columns else F.lit(None).cast("binary")
    rows = leaves.select(
        tree_name(F.col("group")).alias("tree"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.unhex("leaf").alias("digest"),
        claim.alias("claim"),
        F.monotonically_increasing_id().alias("salt"),
    )
    nodes = _numbered(stored(rows, "merkle-leaves"), ["doc_id", "digest"])
    forest, roots = _written(nodes, f"{folder}/forest", shape, with_ids=True)
    trees = stored(roots.withColumn("salt", F.lit(0)), "merkle-trees")
    # One tree over the others, in their order; it is numbered as they are.
    named = trees.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", "salt")
    _numbered(named, ["name"]).write.parquet(f"{folder}/trees")
    crown, _ = _written(spark.read.parquet(f"{folder}/trees"), f"{folder}/crown", shape, with_ids=False)
    sizes = [(shape.fan, shape.height, forest, crown)]
    tiers = spark.createDataFrame(sizes, "fan int, height int, forest int, crown int")
    tiers.coalesce(1).write.parquet(f"{folder}/shape")


def _paths(blocks: DataFrame, shape: Shape) -> DataFrame:
    """``(tree, rank, path)`` of the leaves of blocks ``(tree, block, n, levels, nodes, path)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                texts = level_texts(row["nodes"], row["n"], row["levels"], shape.fan)
                above = [(step["before"], step["after"]) for step in row["path"]]
                own = [siblings(texts, leaf, shape.fan) + above for leaf in range(row["n"])]
                first = row["block"] * shape.leaves
                steps = [[{"before": b, "after": a} for b, a in path] for path in own]
                columns = [
                    pa.array([row["tree"]] * row["n"], pa.string()),
                    pa.array(range(first, first + row["n"]), pa.int64()),
                    pa.array(steps, _STEPS),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "rank", "path"])

    columns = blocks.select("tree", "block", "n", "levels", "nodes", "path")
    return columns.mapInArrow(run, f"tree string, rank bigint, path {_PATH}")


def _descended(spark: SparkSession, folder: str, tiers: int, tops: DataFrame, shape: Shape, label: str) -> DataFrame:
    """The first tier's blocks, each with the ``path`` from its root to the top of all and its tree's root.

    ``tops`` holds ``(top, tree_root, above)`` of every tree: its name, root, and path from that root.
    """
    reached = None
    for tier in range(tiers - 1, -1, -1):
        blocks = spark.read.parquet(f"{folder}/{tier}")
        alone = blocks.where("alone").join(tops, F.col("tree") == F.col("top"))
        found = alone.select(*blocks.columns, "tree_root", F.col("above").alias("path"))
        if reached is not None:
            own = blocks.where("NOT alone").join(
                reached, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_rank"))
            )
            found = found.unionByName(own.select(*blocks.columns, "tree_root", "path"))
        if tier:
            below = _paths(found, shape).select(F.col("tree").alias("_tree"), F.col("rank").alias("_rank"), "path")
            roots = tops.select("top", "tree_root")
            reached = stored(below.join(roots, F.col("_tree") == F.col("top")).drop("top"), f"merkle-{label}-{tier}")
    return found


def proofs(spark: SparkSession, folder: str, with_path: bool = False) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of every leaf, digests in hex.

    ``proof_sha256`` is the digest of all siblings' hex digests, level by level from the leaf to the
    root and each level from left to right. ``folded_root`` is recomputed from the leaf's claim, or the leaf
    itself where there is none, and the siblings; ``verified`` says whether it is the root. On request
    ``path`` holds the siblings, those before and those after for each level.
    """
    sizes = spark.read.parquet(f"{folder}/shape").first()
    shape = Shape(sizes.fan, sizes.height)
    no_path = F.from_json(F.lit("[]"), _PATH)
    top = spark.read.parquet(f"{folder}/crown/{sizes.crown - 1}").select(
        F.col("tree").alias("top"), F.col("root").alias("tree_root"), no_path.alias("above")
    )
    crown = _paths(_descended(spark, f"{folder}/crown", sizes.crown, top, shape, "crown"), shape)
    trees = spark.read.parquet(f"{folder}/trees").select(
        F.col("name").alias("top"), F.col("rank").alias("_place"), F.col("digest").alias("tree_root")
    )
    placed = trees.join(crown, F.col("_place") == F.col("rank"))
    tops = stored(placed.select("top", "tree_root", F.col("path").alias("above")), "merkle-tops")
    root = top.first()
    blocks = _descended(spark, f"{folder}/forest", sizes.forest, tops, shape, "forest")
    names = ["doc_id", "leaf", "subroot", "proof_sha256", "folded_root", *["path"] * with_path]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, levels, fan = row["n"], row["levels"], shape.fan
                texts = level_texts(row["nodes"], n, levels, fan)
                places = addresses(levels - 1, np.arange(n), levels, fan)
                table = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
                leaves = table[places].tobytes().hex()
                above = [(step["before"], step["after"]) for step in row["path"]]
                high = "".join(before + after for before, after in above)
                proof, ends, paths = [], [], []
                own = [leaves[64 * k : 64 * (k + 1)] for k in range(n)]
                for k, claim in enumerate(row["claims"]):
                    path = siblings(texts, k, fan)
                    low = "".join([before + after for before, after in path])
                    proof.append(sha256((low + high).encode()).hexdigest())
                    ends.append(folded(own[k] if claim is None else claim.hex(), path + above))
                    if with_path:
                        paths.append([{"before": b, "after": a} for b, a in path + above])
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(own),
                    pa.array([row["tree_root"].hex()] * n),
                    pa.array(proof),
                    pa.array(ends),
                ]
                if with_path:
                    columns.append(pa.array(paths, _STEPS))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, leaf string, subroot string, proof_sha256 string, folded_root string"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Few and wide rows: dealt out, so that every task folds some.
    dealt = blocks.select("n", "levels", "nodes", "doc_ids", "claims", "tree_root", "path", "tree", "block").repartition(
        tasks, "tree", "block"
    )
    found = dealt.mapInArrow(run, schema + (f", path {_PATH}" if with_path else ""))
    checked = found.withColumn("root", F.lit(root.tree_root.hex() if root else None).cast("string"))
    checked = checked.withColumn("verified", F.col("folded_root") == F.col("root"))
    return checked.select("doc_id", "leaf", "subroot", "root", *names[3:], "verified")
