"""Spelling variants: words one edit apart, grouped under the form that is written far more often.

Pairs are compared in tiles: the words of two blocks as padded matrices of code points, one pushed to
the left and one to the right, give all common prefixes and suffixes at once, and a pair is one edit
apart when they reach its longer length less one. A tiling of the whole vocabulary would grow with its
square, so a tile only holds words that agree outside one part of their length. An edit lies within one
part, so every pair meets, and by the part of its first difference it counts exactly once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import bounded_groups, slices, stored, utf8

#: Cells of the tiles that are compared at a time.
_CELLS = 1 << 20


@dataclass(frozen=True)
class Spelling:
    """``slips``: of the runs, those whose hash it divides lose a letter; none if 0. ``parts``, ``block``
    and ``held`` (different words a task counts before it hands its counts on) only cut the work."""

    least_chars: int = 6
    least_count: int = 5
    ratio: int = 5
    slips: int = 0
    parts: int = 3
    block: int = 512
    held: int = 300_000

    def __post_init__(self) -> None:
        if self.ratio < 2 or self.parts < 1 or self.least_chars < 1:
            raise ValueError("a form must be more frequent than its variant, and words have a character and a part")


def slipped(run: str, hashed: int, every: int) -> str:
    """The run, or without one letter if ``every`` divides its hash."""
    if not every or hashed % every:
        return run
    at = hashed % len(run)
    return run[:at] + run[at + 1 :]


def frequent_words(docs: DataFrame, spelling: Spelling, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(word, n)`` of the words with at least ``least_chars`` characters and ``least_count`` occurrences.

    Words are runs of basic and Latin-1 letters with A-Z in lower case. A run's hash is the CRC-32 of
    ``<doc_id>:<run>``; a NULL id counts as an empty one there, a NULL text has no words. Repeated
    rows count each time.
    """
    find = re.compile("[a-zÀ-ÿ]{%d,}" % spelling.least_chars).findall
    least, every, held = spelling.least_chars, spelling.slips, spelling.held

    def counted(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for low, high in slices(batch.column(1)):
                heads, texts = batch.column(0)[low:high].to_pylist(), batch.column(1)[low:high].to_pylist()
                for head, raw in zip(heads, texts, strict=True):
                    runs = find(raw.lower().decode())
                    if not every:
                        counts.update(runs)
                        continue
                    start = zlib.crc32(b"%b:" % head)
                    for word, n in Counter(runs).items():
                        hashed = zlib.crc32(word.encode(), start)
                        if hashed % every == 0:
                            word = slipped(word, hashed, every)
                            if len(word) < least:
                                continue
                        counts[word] += n
                if len(counts) > held:
                    yield counted(counts)
                    counts.clear()
        yield counted(counts)

    rows = docs.select(utf8(F.col(doc_id).cast("string")).alias("doc_id"), utf8(text).alias("text"))
    totals = rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return totals.where(F.col("n") >= spelling.least_count)


def _postings(words: DataFrame, spelling: Spelling) -> DataFrame:
    """``(key, word, n)``: each word under its characters outside each part, as the word of its own
    length and as the longer word by one. Part k of length c ends where ``c * (k + 1) // parts`` does."""
    size = F.char_length("word")
    places = [
        F.struct((size - more).alias("c"), F.lit(part).alias("k"), F.lit(more).alias("more"))
        for more in (0, 1)
        for part in range(spelling.parts)
    ]
    placed = words.select("word", "n", F.explode(F.array(*places)).alias("_p")).where(
        F.col("_p.c") >= spelling.least_chars
    )
    start = F.floor(F.col("_p.c") * F.col("_p.k") / spelling.parts).cast("int")
    end = F.floor(F.col("_p.c") * (F.col("_p.k") + 1) / spelling.parts).cast("int") + F.col("_p.more")
    front, back = F.substr("word", F.lit(1), start), F.substr("word", end + 1)
    key = F.concat_ws(":", F.col("_p.c").cast("string"), F.col("_p.k").cast("string"), F.concat(front, back))
    return placed.select(key.alias("key"), "word", "n")


def near_pairs(words: DataFrame, spelling: Spelling) -> DataFrame:
    """``(word, other, other_n)``, both ways round, of the words ``(word, n)`` that are one edit apart."""
    tiles = bounded_groups(_postings(words, spelling), "key", F.struct("word", "n"), spelling.block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column(3)
            sizes = pc.list_value_length(members).to_numpy(zero_copy_only=False).astype(np.int64)
            # Tiles come in portions, so a batch of large ones is not opened at once.
            portions = np.cumsum(sizes) // 50_000
            for portion in np.unique(portions):
                low, high = np.searchsorted(portions, [portion, portion + 1])
                yield from _compared(batch.slice(low, high - low), sizes[low:high], spelling.parts)

    keyed = tiles.select("key", "i", "j", "members")
    return keyed.mapInArrow(run, "word string, other string, other_n bigint")


def _compared(tiles: pa.RecordBatch, sizes: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    heads = [key.split(":", 2) for key in tiles.column(0).to_pylist()]
    shorter = np.array([int(c) for c, _, _ in heads])
    part = np.array([int(k) for _, k, _ in heads])
    whole = tiles.column(1).to_numpy() == tiles.column(2).to_numpy()
    flat = tiles.column(3).flatten()
    chunk = flat.field("chunk").to_numpy()
    words, counts = flat.field("member").field("word"), flat.field("member").field("n")
    points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4")
    lengths = pc.utf8_length(words).to_numpy().astype(np.int64)
    begins = np.cumsum(lengths) - lengths
    first = np.cumsum(sizes) - sizes
    # Tiles of like size and width are compared together; the places that are left over hold no word.
    places = 1 << np.ceil(np.log2(sizes)).astype(np.int64)
    for place, length in sorted(set(zip(places.tolist(), shorter.tolist(), strict=True))):
        alike = np.flatnonzero((places == place) & (shorter == length))
        step = max(1, _CELLS // (place * place))
        for at in range(0, len(alike), step):
            own = alike[at : at + step]
            slot = np.arange(place)
            filled = slot < sizes[own][:, None]
            member = np.where(filled, first[own][:, None] + slot, 0)
            near = _one_edit_apart(points, begins[member], lengths[member], length, part[own], parts)
            near &= filled[:, :, None] & filled[:, None, :]
            near &= whole[own][:, None, None] | (chunk[member][:, :, None] != chunk[member][:, None, :])
            tile, a, b = np.nonzero(near)
            here, there = pa.array(member[tile, a]), pa.array(member[tile, b])
            yield pa.RecordBatch.from_arrays(
                [words.take(here), words.take(there), counts.take(there)], ["word", "other", "other_n"]
            )


def _one_edit_apart(
    points: np.ndarray, begin: np.ndarray, size: np.ndarray, length: int, part: np.ndarray, parts: int
) -> np.ndarray:
    """For each tile, which of its words (``begin`` and ``size`` in ``points``) are one edit apart,
    the shorter of ``length`` characters and the edit in the tile's ``part``."""
    width = length + 1
    column = np.arange(width)
    last = len(points) - 1
    left = np.where(column < size[..., None], points[np.minimum(begin[..., None] + column, last)], 0)
    inset = column - (width - size[..., None])
    right = np.where(inset >= 0, points[np.clip(begin[..., None] + inset, 0, last)], 0)

    def common(matrix: np.ndarray, columns: range) -> np.ndarray:
        still = np.ones((*size.shape, size.shape[1]), bool)
        reach = np.zeros(still.shape, np.int32)
        for k in columns:
            still &= matrix[:, :, None, k] == matrix[:, None, :, k]
            if not still.any():
                break
            reach += still
        return reach

    prefix, suffix = common(left, range(width)), common(right, range(width - 1, -1, -1))
    longer = np.maximum(size[:, :, None], size[:, None, :])
    near = (prefix + suffix >= longer - 1) & (np.minimum(size[:, :, None], size[:, None, :]) == length)
    near[:, np.arange(size.shape[1]), np.arange(size.shape[1])] = False
    edit = np.minimum(prefix, length - 1)
    part = part[:, None, None]
    return near & (edit >= length * part // parts) & (edit < length * (part + 1) // parts)


def _roots(forms: DataFrame) -> DataFrame:
    """``(_word, root)`` from ``(word, form)``: the last of each word's forms.

    A form is ``ratio`` times as frequent as its word, so a path has no more steps than the count has
    digits to that base. Paths double in length by each join.
    """
    current = stored(forms.select(F.col("word").alias("_word"), F.col("form").alias("root")), "spelling-forms")
    while True:
        ahead = current.select(F.col("_word").alias("_via"), F.col("root").alias("_further"))
        moved = current.join(ahead, F.col("root") == F.col("_via"), "left")
        following = stored(
            moved.select(
                "_word",
                F.coalesce("_further", "root").alias("root"),
                F.col("_further").isNotNull().alias("_moved"),
            ),
            "spelling-roots",
        )
        if not following.where("_moved").head(1):
            return following.drop("_moved")
        current = following.drop("_moved")


def variant_groups(
    docs: DataFrame, spelling: Spelling = Spelling(), text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for every frequent word of the texts.

    ``n_near`` counts the words one edit apart. ``form`` is the most frequent of them, of equals the
    first in code-point order, if it occurs at least ``ratio`` times as often as the word, else NULL;
    ``root`` follows the forms to the last and is the word itself where there is none. NULL and empty
    texts have no words, so a table of them gives no rows. Other columns are not read.
    """
    words = stored(frequent_words(docs, spelling, text, doc_id), "spelling-words")
    best = F.min(F.struct((-F.col("other_n")).alias("_minus"), F.col("other").alias("_best")))
    near = near_pairs(words, spelling).groupBy(F.col("word").alias("_w"))
    found = near.agg(F.count(F.lit(1)).alias("_near"), best.alias("_form"))
    usual = -F.col("_form._minus") >= spelling.ratio * F.col("n")
    judged = stored(
        words.join(found, F.col("word") == F.col("_w"), "left").select(
            "word",
            "n",
            F.coalesce("_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(usual, F.col("_form._best")).alias("form"),
            F.when(usual, -F.col("_form._minus")).alias("form_n"),
        ),
        "spelling-judged",
    )
    roots = _roots(judged.where("form IS NOT NULL").select("word", "form"))
    joined = judged.join(roots, F.col("word") == F.col("_word"), "left")
    return joined.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
