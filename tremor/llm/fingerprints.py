"""Document fingerprints: 128-bit SimHash, and permuted block tables to find near ones.

A text's terms (pairs of neighbouring words, ASCII letters in lower case) are hashed; each
hash votes on every bit with its sign, weighted by how often the term occurs, and the sign of
the sum is the bit. Likeness is the share of equal bits.

To find all fingerprints within ``radius`` bits the bits are cut into ``radius + 2`` blocks, of
which at least two are equal in any such pair. There is one table per pair of blocks; it holds
the fingerprints permuted so that these blocks lead, and only what shares them is compared.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import bounded_groups, slices, stored
from tremor.llm.ranges import range_bounds, range_part

BITS = 128
#: Members of a table's entry that one array may hold; larger entries are cut into chunk pairs.
ENTRY_BLOCK = 512


def fingerprint(text: str) -> bytes:
    """16 bytes; all zero for a text without words. A text of one word has that word as its term."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return bytes(BITS // 8)
    terms = Counter([a + b" " + b for a, b in zip(words, words[1:], strict=False)] if len(words) > 1 else words)
    digest = xxhash.xxh3_128_digest
    bits = np.unpackbits(np.frombuffer(b"".join(map(digest, terms)), np.uint8)).reshape(-1, BITS)
    weights = np.fromiter(terms.values(), np.int64, len(terms))
    votes = _column_sums(bits)
    heavy = np.flatnonzero(weights > 1)
    if heavy.size:
        votes = votes + (weights[heavy] - 1) @ bits[heavy].astype(np.int64)
    return np.packbits(2 * votes > weights.sum()).tobytes()


def _column_sums(bits: np.ndarray) -> np.ndarray:
    """Sums over rows of zeros and ones, eight columns per addition, 255 rows at a time."""
    lanes = bits.view(np.uint64)
    sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
    return sums.view(np.uint8).reshape(-1, bits.shape[1]).sum(axis=0, dtype=np.int64)


def likeness(a: bytes, b: bytes) -> float:
    differing = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return 1 - differing.bit_count() / BITS


def with_next(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(part, role, doc_id, text)`` sorted so that each row's next row is its next document.

    The order is descending ids, NULL ids last, ties by text. The table is cut into ranges of
    ids; the first rows of each range are sent along to the end of the range before it (role 1),
    and those of the first range to the last, so texts are shuffled once and no task sees more
    than its range.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(rows, 4 * tasks)
    parts = max(1, len(bounds))
    placed = rows.withColumn("_part", range_part(F.col("doc_id"), bounds))
    # Where no row has an id, there is one part, and any row may stand for its first.
    head = F.col("_part.bound") if len(bounds) else F.lit(True)
    part = F.col("_part.part")
    own = F.struct(part.alias("part"), F.lit(0).alias("role"))
    ahead = F.struct(((part + 1) % parts).alias("part"), F.lit(1).alias("role"))
    sent = placed.select(
        "doc_id", "text", F.explode(F.when(head, F.array(own, ahead)).otherwise(F.array(own))).alias("_to")
    )
    dealt = sent.select("_to.part", "_to.role", "doc_id", "text").repartition(tasks, "part")
    return dealt.sortWithinPartitions("part", "role", F.col("doc_id").desc_nulls_last(), "text")


def edited(text: str, following: str) -> str:
    """The text whose last third is replaced by as much of the beginning of the following one."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def fingerprinted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next)`` for every row.

    A NULL text counts as empty. Rows with equal ids follow each other in the order of their
    texts, rows without an id come last. A table of one row is its own next document, and an
    empty table gives an empty result. Other columns are not read.
    """

    def compared(doc: tuple, following: tuple) -> tuple:
        number, own, fp = doc
        _, other, other_fp = following
        changed = edited(own, other)
        changed_fp = fingerprint(changed)
        sha = hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest()
        return number, len(own), sha, fp, changed_fp, likeness(fp, changed_fp), likeness(fp, other_fp)

    names = ["doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None
        waiting_part = -1
        for batch in batches:
            texts = batch.column(3)
            for first, last in slices(texts):
                out = []
                columns = [batch.column(k)[first:last].to_pylist() for k in range(4)]
                for part, role, number, own in zip(*columns, strict=True):
                    if role and (waiting is None or waiting_part != part):
                        continue
                    doc = (number, own, fingerprint(own))
                    if waiting is not None:
                        out.append(compared(waiting, doc))
                    waiting, waiting_part = (None if role else doc), part
                values = list(zip(*out, strict=True)) if out else [()] * len(names)
                arrays = [pa.array(v, t) for v, t in zip(values, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return with_next(docs, text, doc_id).mapInArrow(
        run,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fp binary, edited_fp binary, "
        "near_edited double, near_next double",
    )


def _half(fp: str, first: int) -> Column:
    return F.conv(F.hex(F.substring(fp, first, 8)), 16, -10).cast("bigint")


def _blocks(radius: int) -> list[tuple[str, int, int]]:
    """``(half, shift, width)`` of ``radius + 2`` blocks, as many in either half."""
    if radius % 2 or not 0 <= radius <= 14:
        raise ValueError("the radius must be even and at most 14")
    count = radius // 2 + 1
    edges = [round(64 * k / count) for k in range(count + 1)]
    return [(half, low, high - low) for half in ("hi", "lo") for low, high in zip(edges, edges[1:], strict=False)]


def _block(half, shift: int, width: int):
    return F.shiftrightunsigned(half, shift).bitwiseAND(F.lit((1 << width) - 1))


def near_counts(fps: DataFrame, radius: int) -> DataFrame:
    """``(hi, lo, n_near)``: how many other rows lie within ``radius`` bits of each distinct fingerprint.

    ``fps`` has the halves ``hi`` and ``lo``. Equal fingerprints are counted before the tables
    are made, and a pair that meets in several tables counts in the first of them alone.
    """
    nodes = stored(fps.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("copies")), "fingerprint-nodes")
    blocks = _blocks(radius)
    tables = list(combinations(range(len(blocks)), 2))
    entries = [
        F.struct(F.lit(t).alias("table"), _block(*blocks[x]).alias("x"), _block(*blocks[y]).alias("y"))
        for t, (x, y) in enumerate(tables)
    ]
    postings = nodes.select("hi", "lo", "copies", F.explode(F.array(*entries)).alias("entry"))
    groups = bounded_groups(postings, "entry", F.struct("hi", "lo", "copies"), ENTRY_BLOCK)

    def first_table(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The first table in which pairs with these differing bits meet."""
        equal = []
        for half, shift, width in blocks:
            bits = hi if half == "hi" else lo
            equal.append((bits >> np.uint64(shift)) & np.uint64((1 << width) - 1) == 0)
        found = np.full(hi.shape, len(tables))
        for t in reversed(range(len(tables))):
            found[equal[tables[t][0]] & equal[tables[t][1]]] = t
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            bounds = lists.offsets.to_numpy()
            member = lists.values.field("member")
            chunk = lists.values.field("chunk").to_numpy()
            hi, lo = (member.field(h).to_numpy().view(np.uint64) for h in ("hi", "lo"))
            copies = member.field("copies").to_numpy()
            table = batch.column(0).field("table").to_numpy()
            across = batch.column(1).to_numpy() != batch.column(2).to_numpy()
            near = np.zeros(len(copies), np.int64)
            for k in range(len(lists)):
                own = np.arange(bounds[k], bounds[k + 1])
                for at, i in enumerate(own[:-1]):
                    rest = own[at + 1 :]
                    dh, dl = hi[rest] ^ hi[i], lo[rest] ^ lo[i]
                    hit = np.bitwise_count(dh) + np.bitwise_count(dl) <= radius
                    if across[k]:
                        hit &= chunk[rest] != chunk[i]
                    if hit.any():
                        hit[hit] = first_table(dh[hit], dl[hit]) == table[k]
                        near[i] += copies[rest[hit]].sum()
                        near[rest[hit]] += copies[i]
            found = near > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in (hi[found].view(np.int64), lo[found].view(np.int64), near[found])],
                ["hi", "lo", "near"],
            )

    parts = groups.mapInArrow(run, "hi bigint, lo bigint, near bigint")
    sums = parts.groupBy(F.col("hi").alias("_hi"), F.col("lo").alias("_lo")).agg(F.sum("near").alias("near"))
    joined = nodes.join(sums, (F.col("hi") == F.col("_hi")) & (F.col("lo") == F.col("_lo")), "left")
    others = F.col("copies") - 1 + F.coalesce("near", F.lit(0))
    return joined.select("hi", "lo", others.cast("bigint").alias("n_near"))


def with_near_counts(marked: DataFrame, radius: int) -> DataFrame:
    """Rows with a fingerprint ``fp``, with ``n_near``: how many other rows are within the radius."""
    halves = marked.withColumns({"hi": _half("fp", 1), "lo": _half("fp", 9)})
    counts = stored(near_counts(halves.select("hi", "lo"), radius), "near-counts")
    counts = counts.select(F.col("hi").alias("_hi"), F.col("lo").alias("_lo"), "n_near")
    return halves.join(counts, (F.col("hi") == F.col("_hi")) & (F.col("lo") == F.col("_lo"))).drop("hi", "lo", "_hi", "_lo")
