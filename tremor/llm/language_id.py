"""Language ID by prediction by partial matching (PPM).

Each language has a tree of byte contexts up to ``order`` bytes long, with the counts of the
bytes that follow. A byte is coded in the longest context that is in the tree; if it never
followed there, an escape is coded (method C: as probable as the context has different
followers) and the next shorter context codes it, without the bytes the longer one has ruled
out. The statistics are frozen after learning, so the code length of every (context, byte) is
worked out once, and a text costs two table look-ups a byte for all languages together. The
language in which the text has the shortest code is the prediction.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.llm.common import slices, trimmed, utf8

UNDETERMINED = "und"
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
#: Bytes of text that are looked up at once.
_PIECE = 1 << 18
#: Per language, for each length of a run: the runs in order, as numbers, and how often each occurs.
GramCounts = dict[str, list[tuple[np.ndarray, np.ndarray]]]
_GRAMS = "byte int, task int, lang string, half int, level int, codes binary, counts binary"
#: Groups of tasks whose counts are added up first.
_ROUND = 32
_RATES = ["lang", "digest", "bins"]
#: Bits per byte.
_RATE_STEP = 2.0**-10


@dataclass(frozen=True)
class Ppm:
    """All labelled documents are learned from, or with ``sample_docs`` about so many whole ones of each language,
    chosen by a hash of the id. Contexts seen less than ``least`` times are left out of the tree, and so are
    those that make up less than ``least_share`` of their language's bytes, so the tree stays bounded."""

    order: int = 3
    sample_docs: int | None = None
    least: int = 4
    least_share: float = 2.0**-17
    seed: int = 6


@dataclass(frozen=True)
class Trees:
    """Frozen trees of all languages, side by side."""

    languages: list[str]
    order: int
    classes: int
    byte_class: np.ndarray  # of each byte; bytes never seen share the last class
    state_of: np.ndarray  # longest context in the tree for each combination of the last classes
    bits: np.ndarray  # [state * classes + class, language]: code length


@dataclass(frozen=True)
class Limits:
    """How many bits per byte a text of a language may cost: the ``quantile`` of labelled documents plus
    ``margin``. ``lengths`` part the texts into classes; each document gives every class that it reaches the
    rate of what it begins with, up to the class' end. A text shorter than all of them has no limit. A language
    needs ``least`` different documents for limits of its own; otherwise it has those of all together."""

    quantile: float = 0.99
    margin: float = 1.0
    least: int = 20
    lengths: tuple[int, ...] = tuple(8 << k for k in range(12))


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


def _numbers(symbols: np.ndarray, length: int, base: int) -> np.ndarray:
    """The ``length`` symbols that end at each position, as one number; the first symbols lack some."""
    out = np.zeros(len(symbols) - length + 1, np.int64)
    for k in range(length):
        out = out * base + symbols[k : len(symbols) - length + 1 + k]
    return out


def _code_lengths(counts: list[np.ndarray], unused: int) -> np.ndarray:
    """Bits of each class in contexts whose follower counts are given from the longest to the shortest."""
    rows, classes = counts[0].shape
    open_ = np.ones((rows, classes), bool)  # not yet coded nor ruled out
    chance = np.ones(rows)
    result = np.zeros((rows, classes))
    for level in counts:
        own = np.where(open_, level, 0)
        total = own.sum(axis=1)
        kinds = (own > 0).sum(axis=1)
        whole = np.maximum(total + kinds, 1)
        result += own * (chance / whole)[:, None]
        chance = np.where(kinds > 0, chance * kinds / whole, chance)
        open_ &= own == 0
    # Any of the 256 bytes that is still open; the last class stands for the bytes never seen.
    left = open_[:, :-1].sum(axis=1) + unused
    result += np.where(open_, (chance / np.maximum(left, 1))[:, None], 0)
    return -np.log2(np.maximum(result, 1e-12))


def learn(samples: dict[str, list[bytes]], ppm: Ppm) -> Trees:
    languages = sorted(samples)
    if not languages:
        return Trees([], 0, 1, np.zeros(256, np.int64), np.zeros(1, np.int32), np.zeros((1, 0), np.float32))
    lowered = {lang: [t.lower() for t in samples[lang]] for lang in languages}
    seen = np.zeros(256, bool)
    seen[32] = True
    for texts in lowered.values():
        for text in texts:
            seen[np.unique(np.frombuffer(text, np.uint8))] = True
    classes = int(seen.sum()) + 1
    byte_class = np.where(seen, np.cumsum(seen) - 1, classes - 1).astype(np.int64)
    pad = b" " * ppm.order
    streams = {
        lang: byte_class[np.frombuffer(pad + pad.join(lowered[lang]), np.uint8)] for lang in languages
    }
    grams: list[dict[str, tuple[np.ndarray, np.ndarray]]] = []
    contexts: list[np.ndarray] = []
    for k in range(ppm.order + 1):
        level, often = {}, []
        for lang in languages:
            numbers, counts = np.unique(_numbers(streams[lang], k + 1, classes), return_counts=True)
            level[lang] = (numbers, counts)
            own, start = np.unique(numbers // classes, return_index=True)
            often.append(own[np.add.reduceat(counts, start) >= ppm.least])
        grams.append(level)
        contexts.append(np.array([0]) if k == 0 else np.unique(np.concatenate(often)))
    return _trees(languages, ppm, byte_class, classes, grams, contexts)


def learn_counts(grams: GramCounts, ppm: Ppm) -> Trees:
    """Trees from the counts of :func:`gram_counts` (any of its halves, or both added up)."""
    languages = sorted(grams)
    if not languages:
        return learn({}, ppm)
    seen = np.zeros(256, bool)
    seen[32] = True
    for levels in grams.values():
        seen[levels[0][0].astype(np.int64)] = True
    classes = int(seen.sum()) + 1
    byte_class = np.where(seen, np.cumsum(seen) - 1, classes - 1).astype(np.int64)
    by_level: list[dict[str, tuple[np.ndarray, np.ndarray]]] = []
    contexts: list[np.ndarray] = []
    for k in range(ppm.order + 1):
        level, often = {}, [np.zeros(0, np.int64)]
        for lang in languages:
            codes, counts = grams[lang][k]
            numbers = np.zeros(len(codes), np.int64)
            for byte in range(k, -1, -1):
                numbers = numbers * classes + byte_class[((codes >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)]
            level[lang] = (numbers, counts)
            if len(numbers):
                own, start = np.unique(numbers // classes, return_index=True)
                often.append(own[np.add.reduceat(counts, start) >= _least(int(grams[lang][0][1].sum()), ppm)])
        by_level.append(level)
        contexts.append(np.array([0]) if k == 0 else np.unique(np.concatenate(often)))
    return _trees(languages, ppm, byte_class, classes, by_level, contexts)


def _least(total: int, ppm: Ppm) -> int:
    return max(ppm.least, math.ceil(total * ppm.least_share))


def _trees(
    languages: list[str], ppm: Ppm, byte_class: np.ndarray, classes: int,
    grams: list[dict[str, tuple[np.ndarray, np.ndarray]]], contexts: list[np.ndarray],
) -> Trees:
    state_of = np.zeros(classes**ppm.order, np.int32)
    bits = []
    first = 0
    for k, own in enumerate(contexts):
        if k:
            state_of.reshape(-1, classes**k)[:, own] = np.arange(first, first + len(own), dtype=np.int32)
        first += len(own)
        by_language = []
        for lang in languages:
            chain = []
            for shorter in range(k, -1, -1):
                numbers, counts = grams[shorter][lang]
                dense = np.zeros((len(own), classes))
                ends = own % classes**shorter
                wanted = ends[:, None] * classes + np.arange(classes)
                if len(numbers):
                    at = np.minimum(np.searchsorted(numbers, wanted), len(numbers) - 1)
                    dense[...] = np.where(numbers[at] == wanted, counts[at], 0)
                chain.append(dense)
            by_language.append(_code_lengths(chain, 256 - (classes - 1)))
        bits.append(np.stack(by_language, axis=-1).reshape(-1, len(languages)))
    return Trees(languages, ppm.order, classes, byte_class, state_of, np.concatenate(bits).astype(np.float32))


def code_lengths(texts: list[bytes], trees: Trees) -> np.ndarray:
    """``[text, language]``: bits of each whole text."""
    result = np.zeros((len(texts), len(trees.languages)))
    pad = b" " * trees.order
    pieces: list[tuple[int, bytes]] = []
    held = 0
    for number, text in enumerate(texts):
        line = pad + text.lower()
        for at in range(0, max(len(text), 1), _PIECE):
            piece = line[at : at + trees.order + _PIECE]
            pieces.append((number, piece))
            held += len(piece)
            if held >= _PIECE:
                _add(result, pieces, trees)
                pieces, held = [], 0
    if pieces:
        _add(result, pieces, trees)
    return result


def _add(result: np.ndarray, pieces: list[tuple[int, bytes]], trees: Trees) -> None:
    order, classes = trees.order, trees.classes
    symbols = trees.byte_class[np.frombuffer(b"".join(p for _, p in pieces), np.uint8)]
    context = np.zeros(len(symbols) - order, np.int64)
    for k in range(order):
        context = context * classes + symbols[k : len(symbols) - order + k]
    bits = trees.bits[trees.state_of[context].astype(np.int64) * classes + symbols[order:]]
    ends = np.cumsum([len(p) for _, p in pieces]) - order
    starts = np.concatenate(([0], ends[:-1] + order))
    totals = np.concatenate((np.zeros((1, bits.shape[1])), np.cumsum(bits, axis=0, dtype=np.float64)))
    np.add.at(result, [number for number, _ in pieces], totals[ends] - totals[starts])


def held_out(doc_id: str, parts: int, part: int) -> Column:
    """Whether the CRC-32 of the id as text leaves remainder ``part``; false for a NULL id."""
    number = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(number % parts == part, F.lit(False))


def learned(labelled: DataFrame, ppm: Ppm, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Trees:
    """Trees from all rows, or with ``sample_docs`` from about so many whole ones of each language."""
    if ppm.sample_docs is None:
        return learn_counts(added_up(gram_counts(labelled, ppm, text, lang)), ppm)
    return learn(sampled(labelled, ppm, text, lang, doc_id), ppm)


def gram_counts(labelled: DataFrame, ppm: Ppm, text: str = "text", lang: str = "lang") -> list[GramCounts]:
    """How often each run of bytes occurs in all labelled texts of a language, for each half of the texts.

    The halves go by a hash of the text, so equal texts are in one. Tasks count the longest runs, of ``order`` + 1 bytes,
    which are added up by their first byte, in two rounds; shorter runs are their beginnings. Only followers of
    contexts that are frequent enough for a tree reach the driver.
    """
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).alias("lang"), (F.crc32(utf8(text)) % 2).cast("int").alias("half"), utf8(text).alias("text"))
    size, pad = ppm.order + 1, b" " * ppm.order

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for first, last in slices(batch.column(2)):
                groups: dict[tuple[str, int], list[bytes]] = {}
                for lang, half, value in zip(*(c.to_pylist() for c in batch.slice(first, last - first).columns), strict=True):
                    groups.setdefault((lang, half), []).append(value.lower())
                for key, texts in groups.items():
                    line = np.frombuffer(pad + pad.join(texts) + pad, np.uint8).astype(np.uint64)
                    own = held.setdefault(key, [])
                    own.append(np.unique(_numbers(line, size, 256).astype(np.uint64), return_counts=True))
                    if len(own) > 8:
                        held[key] = [_summed(own)]
        task = TaskContext.get().partitionId() % _ROUND
        for (lang, half), own in held.items():
            codes, counts = _summed(own)
            cuts = np.searchsorted(codes, np.arange(257, dtype=np.uint64) << np.uint64(8 * (size - 1)))
            for byte in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[byte], cuts[byte + 1])
                yield _gram_rows([(int(byte), task, lang, half, 0, codes[part], counts[part])])

    def merge(table: pa.Table) -> pa.Table:
        byte, task = table.column("byte")[0].as_py(), table.column("task")[0].as_py()
        return pa.Table.from_batches([_gram_rows([(byte, task, *key, 0, *own) for key, own in _merged(table).items()])])

    def cut(table: pa.Table) -> pa.Table:
        own, found = _merged(table), []
        langs = {lang for lang, _ in own}
        levels = {key: [_begun(*of, size - 1 - k) for k in range(size)] for key, of in own.items()}
        for k in range(size):
            # Contexts that are frequent enough in any language, in either half or all; the first level has none.
            kept = []
            for lang in langs if k else ():
                halves = [levels[key][k] for key in own if key[0] == lang]
                for number, (codes, counts) in zip([*[key[1] for key in own if key[0] == lang], 2], [*halves, _summed(halves)], strict=True):
                    heads, start = np.unique(codes >> np.uint64(8), return_index=True)
                    kept.append(heads[np.add.reduceat(counts, start) >= _least(totals[lang, number], ppm)])
            heads = np.unique(np.concatenate(kept)) if kept else None
            for (lang, half), of in levels.items():
                codes, counts = of[k]
                if k:
                    chosen = np.isin(codes >> np.uint64(8), heads)
                    codes, counts = codes[chosen], counts[chosen]
                found.append((0, 0, lang, half, k, codes, counts))
        return pa.Table.from_batches([_gram_rows(found)])

    # Bytes that are counted, a row per language and half.
    totals: dict[tuple[str, int], int] = {}
    for row in rows.groupBy("lang", "half").agg(F.sum(F.octet_length("text") + ppm.order).alias("n")).collect():
        totals[row.lang, row.half] = row.n
        totals[row.lang, 2] = totals.get((row.lang, 2), 0) + row.n
    counted = rows.mapInArrow(trimmed(count), _GRAMS).groupBy("byte", "task").applyInArrow(merge, _GRAMS)
    result: list[dict[str, list[list[tuple[np.ndarray, np.ndarray]]]]] = [{}, {}]
    for row in counted.groupBy("byte").applyInArrow(cut, _GRAMS).toLocalIterator():
        levels = result[row.half].setdefault(row.lang, [[] for _ in range(size)])
        levels[row.level].append((np.frombuffer(row.codes, np.uint64), np.frombuffer(row.counts, np.int64)))
    return [{lang: [_summed(parts) for parts in levels] for lang, levels in half.items()} for half in result]


def added_up(halves: list[GramCounts]) -> GramCounts:
    langs = {lang for half in halves for lang in half}
    return {
        lang: [_summed([*parts]) for parts in zip(*(half[lang] for half in halves if lang in half), strict=True)] for lang in langs
    }


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    counts = np.zeros(len(codes), np.int64)
    np.add.at(counts, at, np.concatenate([n for _, n in parts]))
    return codes, counts


def _begun(codes: np.ndarray, counts: np.ndarray, dropped: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the runs without their last ``dropped`` bytes."""
    heads, start = np.unique(codes >> np.uint64(8 * dropped), return_index=True)
    return heads, np.add.reduceat(counts, start)


def _merged(table: pa.Table) -> dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]:
    parts: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
    for row in table.to_pylist():
        own = np.frombuffer(row["codes"], np.uint64), np.frombuffer(row["counts"], np.int64)
        parts.setdefault((row["lang"], row["half"]), []).append(own)
    return {key: _summed(own) for key, own in parts.items()}


def _gram_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*[(*r[:5], r[5].tobytes(), r[6].astype(np.int64).tobytes()) for r in rows], strict=True)]
    types = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    names = ["byte", "task", "lang", "half", "level", "codes", "counts"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def sampled(
    labelled: DataFrame, ppm: Ppm, text: str = "text", lang: str = "lang", doc_id: str = "doc_id"
) -> dict[str, list[bytes]]:
    """About ``sample_docs`` whole texts of each language."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    # A row per language, as the trees have; with the counts at hand no text needs a shuffle.
    counts = rows.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()
    draw = F.pmod(F.xxhash64(F.lit(ppm.seed), F.col(doc_id)), F.lit(1 << 30))
    chosen = F.lit(False)
    for row in counts:
        chosen = chosen | ((F.col(lang) == row.lang) & (draw < F.lit((ppm.sample_docs << 30) // row.n)))
    sample = rows.where(chosen)
    samples: dict[str, list[bytes]] = {}
    for row in sample.select(F.col(lang).alias("lang"), utf8(text).alias("text")).collect():
        samples.setdefault(row.lang, []).append(bytes(row.text))
    return {lang: sorted(texts) for lang, texts in samples.items()}


def rate_limits(samples: dict[str, list[bytes]], ppm: Ppm, limits: Limits) -> dict[str, list[float]]:
    """For each language the most bits per byte at each of ``limits.lengths``; infinite if too little is known.

    The texts' rates come from trees that were learned from the other half of the different texts, as
    those of new texts do. No limit is below one of a greater length.
    """
    halves: list[dict[str, list[bytes]]] = [{}, {}]
    for lang, texts in samples.items():
        different = sorted({t for t in texts if has_letter(t)}, key=lambda t: (zlib.crc32(t), t))
        for half in (0, 1):
            if different[half::2]:
                halves[half][lang] = different[half::2]
    rates: dict[str, list[list[float]]] = {lang: [[] for _ in limits.lengths] for lang in samples}
    for own, other in (halves, halves[::-1]):
        trees = learn(other, ppm)
        for lang in own.keys() & set(trees.languages):
            column = trees.languages.index(lang)
            for k, length in enumerate(limits.lengths):
                longest = limits.lengths[k + 1] - 1 if k + 1 < len(limits.lengths) else None
                texts = [t[:longest] for t in own[lang] if len(t) >= length]
                sizes = np.array([len(t) for t in texts])
                rates[lang][k] += (code_lengths(texts, trees)[:, column] / sizes).tolist()
    together = [[r for own in rates.values() for r in own[k]] for k in range(len(limits.lengths))]
    enough = {lang: sum(len(half.get(lang, ())) for half in halves) >= limits.least for lang in samples}
    return {lang: _limits_of(rates[lang] if enough[lang] else together, limits) for lang in samples}


def limits_of_all(
    labelled: DataFrame, halves: list[GramCounts], ppm: Ppm, limits: Limits, text: str = "text", lang: str = "lang"
) -> dict[str, list[float]]:
    """``rate_limits`` over all labelled texts: each text is coded by the trees of the half it is not in, different texts
    count once, and quantiles are exact to ``_RATE_STEP``."""
    trees = [learn_counts(half, ppm) for half in halves]
    shared = labelled.sparkSession.sparkContext.broadcast(trees)
    value = utf8(text)
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), (F.crc32(value) % 2).cast("int").alias("half"), F.md5(value).alias("digest"), value.alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(3)):
                own = batch.slice(first, last - first)
                own = own.filter(pa.array([has_letter(t) for t in own.column(3).to_pylist()], pa.bool_()))
                bins = _rate_bins(*(own.column(k).to_pylist() for k in (0, 1, 3)), shared.value, limits)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(2), pa.array(bins, pa.list_(pa.int32()))], _RATES)

    coded = rows.mapInArrow(trimmed(run), "lang string, digest string, bins array<int>")
    different = coded.groupBy("lang", "digest").agg(F.first("bins").alias("bins"))
    # A row per language, length and step; the first place counts the texts.
    steps = F.posexplode(F.concat(F.array(F.lit(0)), "bins")).alias("k", "bin")
    counted = different.select("lang", steps).where("bin >= 0").groupBy("lang", "k", "bin").agg(F.count(F.lit(1)).alias("n"))
    found: dict[str, list[dict[int, int]]] = {name: [{} for _ in range(len(limits.lengths) + 1)] for half in halves for name in half}
    for row in counted.toLocalIterator():
        found[row.lang][row.k][row.bin] = row.n
    together = [sum((Counter(own[k]) for own in found.values()), Counter()) for k in range(len(limits.lengths) + 1)]
    return {
        name: _filled([_binned(h, limits) for h in (own if sum(own[0].values()) >= limits.least else together)[1:]])
        for name, own in found.items()
    }


def _rate_bins(langs: list[str], halves: list[int], texts: list[bytes], trees: list[Trees], limits: Limits) -> list[list[int]]:
    """Of each text the rate in steps of what it begins with, up to each class' end; -1 if it is shorter or unknown."""
    result = [[-1] * len(limits.lengths) for _ in texts]
    for half in (0, 1):
        other = trees[1 - half]
        column = {lang: at for at, lang in enumerate(other.languages)}
        for k, length in enumerate(limits.lengths):
            longest = limits.lengths[k + 1] - 1 if k + 1 < len(limits.lengths) else None
            own = [n for n, t in enumerate(texts) if halves[n] == half and len(t) >= length and langs[n] in column]
            if own:
                cut = [texts[n][:longest] for n in own]
                for n, t, bits in zip(own, cut, code_lengths(cut, other), strict=True):
                    result[n][k] = int(bits[column[langs[n]]] / len(t) / _RATE_STEP)
    return result


def _binned(steps: dict[int, int], limits: Limits) -> float | None:
    number = sum(steps.values())
    if number < limits.least:
        return None
    order = sorted(steps)
    at = np.searchsorted(np.cumsum([steps[b] for b in order]), limits.quantile * number)
    return (order[min(int(at), len(order) - 1)] + 1) * _RATE_STEP + limits.margin


def _limits_of(rates: list[list[float]], limits: Limits) -> list[float]:
    return _filled([
        float(np.quantile(own, limits.quantile)) + limits.margin if len(own) >= limits.least else None for own in rates
    ])


def _filled(found: list[float | None]) -> list[float]:
    result, most = [], 0.0
    for limit in reversed(found):
        most = most if limit is None else max(most, limit)
        result.append(most)
    # Lengths that too few documents reach have the limit of the longest that enough do.
    known = [limit for limit in result if limit]
    return [limit or (known[0] if known else float("inf")) for limit in reversed(result)]


def plausible(limits: dict[str, list[float]], lengths: tuple[int, ...], text: str = "text") -> Column:
    """Whether an identified row's ``bits_per_byte`` is within the limit of its language and length."""
    size = F.octet_length(text)
    known = [(lang, own) for lang, own in limits.items() if np.isfinite(own).all()]
    result = F.lit(True)
    for lang, own in known:
        limit = F.lit(float("inf"))
        for length, most in zip(lengths, own, strict=True):
            limit = F.when(size >= length, F.lit(most)).otherwise(limit)
        result = result & ((F.col("lang_pred") != lang) | (F.col("bits_per_byte") <= limit))
    return result


def identified(docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``bits_per_byte``.

    ``score`` is the prediction's probability if all languages are as likely beforehand. A text
    that is NULL or has no letter, or any text if nothing was learned, is ``und`` with score 0.
    Ties go to the first language in order. Repeated rows and an empty table need no special
    care, and columns of those three names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    added = ("lang_pred", "score", "bits_per_byte")
    rows = docs.select(*[c for c in docs.columns if c not in added])
    names = [*rows.columns, *added]
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(at)):
                own = batch.slice(first, last - first)
                texts = own.column(at).cast(pa.binary()).to_pylist()
                found = [pa.array(values) for values in _predicted(texts, shared.value)]
                yield pa.RecordBatch.from_arrays([*own.columns, *found], names)

    kinds = (T.StringType(), T.DoubleType(), T.DoubleType())
    schema = T.StructType([*rows.schema.fields, *map(T.StructField, added, kinds)])
    return rows.mapInArrow(trimmed(run), schema)


def _predicted(texts: list[bytes | None], trees: Trees) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Prediction, score and bits per byte of each text."""
    values = [t or b"" for t in texts]
    langs, scores, rates = [UNDETERMINED] * len(values), np.zeros(len(values)), np.zeros(len(values))
    known = [k for k, t in enumerate(values) if trees.languages and has_letter(t)]
    if known:
        bits = code_lengths([values[k] for k in known], trees)
        least = bits.min(axis=1)
        scores[known] = 1 / np.exp2(-np.minimum(bits - least[:, None], 1000)).sum(axis=1)
        rates[known] = least / [len(values[k]) for k in known]
        for k, best in zip(known, bits.argmin(axis=1), strict=True):
            langs[k] = trees.languages[best]
    return langs, scores, rates
