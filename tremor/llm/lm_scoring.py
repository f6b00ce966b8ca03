"""Log-probabilities of whole texts: by word frequencies, and by a context-mixing model.

Word counts of a large corpus fit on no single machine, and the documents' words joined to them
one by one would be shuffled many times over. So documents are gathered into chunks of a few
megabytes; each chunk's distinct words are counted, summed over the corpus, and what is known of them sent
back to the chunks, which then score their documents. A frequent word is one row per chunk. Chunks and what goes back
to them travel packed, a row for each chunk and for each lot of ranges of the vocabulary that it has words of; a lot is
what a task holds at a time, so that small ranges make no rows of their own.

What the context-mixing model (:mod:`tremor.llm.context_mixing`) knows of a word's letters is a function of the word, so
it is worked out once for every distinct word and travels with its count: the whole vocabulary is sorted into ranges,
each task finds the counts of all beginnings in its range, and beginnings that reach across a border are added up over
the ranges that share them. These counts grow with the corpus. Only what is bounded by nature is broadcast: a Huffman
code of bytes, counts after pairs of bytes, the gates' weights, and the beginnings of each range's first and last word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.llm import context_mixing as cm
from tremor.llm.common import slices, stored, strings_over, trim, trimmed, utf8


@dataclass(frozen=True)
class Scoring:
    """``smoothing`` is added to every word's count. ``chunk_bytes``: from how much text a chunk is
    closed. ``range_words``: about how many distinct words a range of the vocabulary has. ``known_bytes``: how much of
    what is known of its ranges' words a task holds before it sends a row to each chunk concerned."""

    smoothing: float = 0.1
    chunk_bytes: int = 14 << 20
    range_words: int = 150_000
    known_bytes: int = 16 << 20


_ZSTD = pa.Codec("zstd", 3)


def _packed(raw: bytes) -> bytes:
    """Compressed, with its size in front."""
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def _unpacked(packed: bytes) -> bytes:
    return _ZSTD.decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)


_CHUNK = "chunk int, doc_ids array<bigint>, trains array<boolean>, sizes array<bigint>, texts binary"
_CHUNK_TYPES = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary()]


def _chunked(docs: DataFrame, scoring: Scoring, text: str, doc_id: str, trains: Column) -> DataFrame:
    """A row per chunk, which is a stretch of one task's rows: ids, whether they train, and the packed texts."""
    most = scoring.chunk_bytes
    names = ["chunk", "doc_ids", "trains", "sizes", "texts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 14
        ids: list = []
        flags: list = []
        texts: list[bytes] = []
        held = 0

        def closed() -> pa.RecordBatch:
            values = number, ids, flags, [len(t) for t in texts], _packed(b"".join(texts))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _CHUNK_TYPES, strict=True)], names)

        for batch in batches:
            for first, last in slices(batch.column(2), 1 << 20):
                if held >= most:
                    yield closed()
                    number, ids, flags, texts, held = number + 1, [], [], [], 0
                ids += batch.column(0)[first:last].to_pylist()
                flags += batch.column(1)[first:last].to_pylist()
                texts += batch.column(2)[first:last].to_pylist()
                held = sum(map(len, texts))
        if ids:
            yield closed()

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), trains.alias("trains"), utf8(text).alias("text"))
    return stored(rows.mapInArrow(trimmed(run), _CHUNK), "lm-chunks")


def _pieces(sizes: list[int], packed: bytes) -> tuple[pa.StringArray, np.ndarray]:
    """The texts' words, ASCII letters in lower case, one text after another, and each one's text. A blank at a text's
    edge gives an empty string besides."""
    raw = _unpacked(packed).lower()
    texts = strings_over(np.cumsum([0, *sizes]), raw)
    cut = pc.ascii_split_whitespace(texts)
    return cut.flatten(), np.repeat(np.arange(len(sizes)), np.diff(cut.offsets.to_numpy()))


def _chunk_words(chunks: DataFrame) -> DataFrame:
    """``(chunk, word, n)``: every word of a chunk, the end included, with its count in training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                trains = np.array(row["trains"], bool)
                pieces, text = _pieces(row["sizes"], row["texts"])
                coded = pieces.dictionary_encode()
                counts = np.bincount(coded.indices.to_numpy()[trains[text]], minlength=len(coded.dictionary))
                used = pc.greater(pc.binary_length(coded.dictionary), 0)
                words = pa.concat_arrays([coded.dictionary.filter(used), pa.array([cm.END.decode()])])
                counts = np.append(counts[used.to_numpy(zero_copy_only=False)], trains.sum()).astype(np.int64)
                for at in range(0, len(words), 1 << 16):
                    some = words[at : at + (1 << 16)]
                    number = pa.array(np.full(len(some), row["chunk"], np.int32))
                    columns = [number, some, pa.array(counts[at : at + (1 << 16)])]
                    yield pa.RecordBatch.from_arrays(columns, ["chunk", "word", "n"])

    rows = chunks.select("chunk", "trains", "sizes", "texts").mapInArrow(trimmed(run), "chunk int, word string, n bigint")
    return stored(rows, "lm-chunk-words", "zstd")


def _documents(sizes: list[int], packed: bytes, words: list[bytes]) -> list[np.ndarray]:
    """Each text's words, given by their places in ``words``, and the end."""
    pieces, text = _pieces(sizes, packed)
    known = strings_over(np.cumsum([0, *map(len, words)]), b"".join(words))
    places = pc.fill_null(pc.index_in(pieces, value_set=known), -1).to_numpy()
    used = places >= 0
    if pc.any(pc.greater(pc.binary_length(pieces.filter(pa.array(~used))), 0)).as_py():
        raise ValueError("a word that the vocabulary lacks")
    ends = np.cumsum(np.bincount(text[used], minlength=len(sizes)) + 1)
    whole = np.full(ends[-1], words.index(cm.END), np.int32)
    inner = np.ones(len(whole), bool)
    inner[ends - 1] = False
    whole[inner] = places[used]
    return np.split(whole, ends[:-1])


_RANGE = "part bigint, words array<binary>, counts array<bigint>, held array<int>, chunks array<int>"
_RANGE_TYPES = [pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]


def _ranges(words: DataFrame, scoring: Scoring) -> DataFrame:
    """A row per range of the vocabulary, sorted as the words are coded: the words, their training counts, and the
    chunks that hold them (``held`` chunks of the first word, then those of the second, and so on)."""
    coded = F.when(F.col("word") == cm.END.decode(), F.col("word")).otherwise(F.concat("word", F.lit(" ")))
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = words.withColumn("_coded", coded).repartitionByRange(tasks, "_coded").sortWithinPartitions("_coded")
    most = scoring.range_words
    names = ["part", "words", "counts", "held", "chunks"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        own: list[bytes] = []
        counts: list[int] = []
        held: list[int] = []
        chunks: list[np.ndarray] = []

        def closed(number: int) -> pa.RecordBatch:
            values = part, own[:number], counts[:number], held[:number], np.concatenate(chunks)[: sum(held[:number])]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _RANGE_TYPES, strict=True)], names)

        for batch in batches:
            words = batch.column(1).cast(pa.binary())
            fresh = pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.flatnonzero(fresh) + 1])
            new = words.take(pa.array(starts)).to_pylist()
            sums = np.add.reduceat(batch.column(2).to_numpy(), starts).tolist()
            sizes = np.diff(starts, append=len(words)).tolist()
            if own and own[-1] == new[0]:
                counts[-1] += sums[0]
                held[-1] += sizes[0]
                new, sums, sizes = new[1:], sums[1:], sizes[1:]
            own += new
            counts += sums
            held += sizes
            chunks.append(batch.column(0).to_numpy())
            # The last word may go on in the next batch.
            while len(own) > most:
                yield closed(most)
                rest = np.concatenate(chunks)[sum(held[:most]) :]
                part, own, counts, held, chunks = part + 1, own[most:], counts[most:], held[most:], [rest]
        if own:
            yield closed(len(own))

    return stored(ranged.select("chunk", "word", "n").mapInArrow(trimmed(run), _RANGE), "lm-vocabulary", "zstd")


def _of_ranges(
    vocabulary: DataFrame, make: Callable[[Iterator[dict]], Iterator[list]], schema: str, names: list[str], types: list
) -> DataFrame:
    """What ``make`` gives for the ranges of each task, as columns of the given names and types."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (batch.slice(k, 1).to_pylist()[0] for batch in batches for k in range(batch.num_rows))
        for made in make(rows):
            columns = [pa.array(c, t) for c, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return vocabulary.mapInArrow(trimmed(run), schema)


def _pair_counts(vocabulary: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """``context_mixing.pair_counts`` of all training words. At most a row for each three bytes, far fewer in text."""

    def make(rows: Iterator[dict]) -> Iterator[list]:
        keys = sums = np.zeros(0, np.int64)
        for row in rows:
            counts = np.array(row["counts"], np.int64)
            used = np.flatnonzero(counts)
            more, n = cm.pair_counts([row["words"][k] for k in used.tolist()], counts[used])
            keys, index = np.unique(np.concatenate([keys, more]), return_inverse=True)
            sums = np.bincount(index, np.concatenate([sums, n]), len(keys)).astype(np.int64)
        yield [keys, sums]

    ranges = vocabulary.select("words", "counts")
    found = _of_ranges(ranges, make, "key bigint, n bigint", ["key", "n"], [pa.int64(), pa.int64()])
    found = found.groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    return found.column("key").to_numpy(), found.column("n").to_numpy()


def _shared_beginnings(vocabulary: DataFrame) -> cm.Shared:
    """The counts of beginnings that several ranges have: of each range's first and last word, so a few hundred rows
    for each range."""

    def make(rows: Iterator[dict]) -> Iterator[list]:
        for row in rows:
            found = list(cm.border_counts(row["words"], np.array(row["counts"], np.int64)))
            yield [[row["part"]] * len(found), *([r[k] for r in found] for k in range(3))]

    schema, names = "part bigint, beginning binary, byte bigint, n bigint", ["part", "beginning", "byte", "n"]
    ranges = vocabulary.select("part", "words", "counts")
    borders = stored(_of_ranges(ranges, make, schema, names, [pa.int64(), pa.binary(), pa.int64(), pa.int64()]), "lm-borders")
    several = borders.groupBy(F.col("beginning").alias("_b")).agg(F.count_distinct("part").alias("_parts")).where("_parts > 1")
    both = borders.join(several, F.col("beginning") == F.col("_b")).groupBy("beginning", "byte").agg(F.sum("n").alias("n"))
    shared: cm.Shared = {}
    for row in both.collect():
        shared.setdefault(bytes(row.beginning), {})[row.byte] = row.n
    return shared


def _dealt(
    words: list[bytes], counts: np.ndarray, levels: np.ndarray, ends: np.ndarray, row: dict
) -> Iterator[tuple[int, bytes]]:
    """The chunks of a range and, for each, what is known of its words: their counts, levels and spellings."""
    chunks = np.array(row["chunks"], np.int64)
    word = np.repeat(np.arange(len(words)), row["held"])
    order = np.argsort(chunks, kind="stable")
    numbers, begins = np.unique(chunks[order], return_index=True)
    starts = np.concatenate([[0], ends[:-1]])
    for number, first, last in zip(numbers.tolist(), begins.tolist(), [*begins[1:].tolist(), len(order)], strict=True):
        own = word[order[first:last]]
        cut = levels[cm.ranges(starts[own], (ends - starts)[own])]
        heads = np.stack([counts[own], (ends - starts)[own]]).astype("<i8")
        spelled = b" ".join([words[k] for k in own.tolist()])
        sizes = np.array([len(own), len(spelled)], "<i8")
        yield number, b"".join([sizes.tobytes(), heads.tobytes(), cut.tobytes(), spelled])


def _known(packed: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, counts and levels of a chunk, from what was packed for it: ``_dealt`` pieces one after another."""
    words: list[bytes] = []
    counts, levels = [], []
    for pieces in packed:
        raw, at = _unpacked(pieces), 0
        while at < len(raw):
            n, spelled = np.frombuffer(raw, "<i8", 2, at).tolist()
            heads = np.frombuffer(raw, "<i8", 2 * n, at + 16).reshape(2, n)
            at += 16 + 16 * n
            size = int(heads[1].sum())
            counts.append(heads[0])
            levels.append(np.frombuffer(raw, np.uint8, size, at))
            at += size + spelled
            words += raw[at - spelled : at].split(b" ")
    return words, np.concatenate(counts), np.concatenate(levels)


def learned(vocabulary: DataFrame, scoring: Scoring = Scoring()) -> tuple[cm.Model, DataFrame]:
    """The model of the ranges of words, and ``(chunk, known)``: for every chunk and lot of ranges, what ``_known``
    unpacks."""
    spark = vocabulary.sparkSession
    keys, sums = _pair_counts(vocabulary)
    alphabet = cm.Alphabet.of(np.bincount(keys & 255, sums, 256).astype(np.int64))
    pairs = cm.Pairs.of(keys, sums, alphabet)
    known = spark.sparkContext.broadcast((alphabet, pairs, _shared_beginnings(vocabulary)))
    most = scoring.known_bytes

    def make(rows: Iterator[dict]) -> Iterator[list]:
        alphabet, pairs, shared = known.value
        tally = np.zeros(cm.CODES)
        pieces: dict[int, list[bytes]] = {}
        held = 0

        def sent() -> list:
            none = [None] * len(pieces)
            return [list(pieces), [_packed(b"".join(own)) for own in pieces.values()], none, none]

        def dealt(row: dict) -> Iterator[tuple[int, bytes]]:
            words, counts = row["words"], np.array(row["counts"], np.int64)
            levels, without = cm.word_bytes(words, counts, alphabet, shared)
            spelled = cm.Spelled.of(words)
            for first, last, codes, ends in cm.codes_in_slices(spelled, without, alphabet, pairs):
                tally[:] += np.bincount(codes, np.repeat(counts[first:last], np.diff(ends, prepend=0)), cm.CODES)
            yield from _dealt(words, counts, levels, cm.level_ends(spelled, alphabet), row)

        # A range is let go of before the next one is unpacked.
        for chunk, piece in chain.from_iterable(map(dealt, rows)):
            pieces.setdefault(chunk, []).append(piece)
            held += len(piece)
            if held >= most:
                yield sent()
                pieces, held = {}, 0
        yield sent()
        # The tally of all the task's words goes along as rows without a chunk.
        used = np.flatnonzero(tally)
        none = [None] * len(used)
        yield [none, none, used, tally[used].astype(np.int64)]

    names = ["chunk", "known", "code", "n"]
    types = [pa.int32(), pa.binary(), pa.int32(), pa.int64()]
    made = _of_ranges(vocabulary, make, "chunk int, known binary, code int, n bigint", names, types)
    made = stored(made, "lm-known")
    tally = np.zeros(cm.CODES, np.int64)
    for row in made.where("code IS NOT NULL").groupBy("code").agg(F.sum("n").alias("n")).collect():
        tally[row.code] = row.n
    known.unpersist()
    return cm.Model(alphabet, pairs, cm.fitted(tally)), made.where("code IS NULL").select("chunk", "known")


def scored(
    docs: DataFrame, trains: Column, scoring: Scoring, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``(doc_id, trains, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    Tokens are the words, ASCII letters in lower case, and one end. ``base_score`` sums their
    smoothed log10 frequencies in the rows where ``trains`` holds; ``score`` is the log10
    probability of the same tokens under the context-mixing model. A NULL text counts as empty:
    one end. NULL ids and repeated rows are scored like any other, other columns are not read,
    and an empty table gives an empty result. Without training rows no word is known.
    """
    chunks = _chunked(docs, scoring, text, doc_id, trains)
    words = _chunk_words(chunks)
    vocabulary = _ranges(words, scoring)
    counted = vocabulary.select(F.explode("counts").alias("c")).where("c > 0")
    sums = counted.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, whole = sums.n, sums.n + scoring.smoothing * (sums.v + 1)
    model, known = learned(vocabulary, scoring)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    smoothing = scoring.smoothing
    names = ["doc_id", "trains", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(chunk: pa.Table, known: pa.Table) -> pa.Table:
        words, counts, levels = _known(known.column("known").to_pylist())
        logs = np.log10((counts + smoothing) / whole) if tokens else np.zeros(len(words))
        row = chunk.to_pylist()[0]
        documents = _documents(row["sizes"], row.pop("texts"), words)
        # The texts are let go of before the words' codes are made, and what those are made of before they are used.
        trim()
        scorer = cm.Scorer(words, levels, shared.value)
        del words, levels
        trim()
        score = -scorer.bits(documents) * log10(2)
        del scorer
        trim()
        columns = [
            pa.array(row["doc_ids"], pa.int64()),
            pa.array(row["trains"], pa.bool_()),
            pa.array([len(d) for d in documents], pa.int64()),
            pa.array([int((counts[d] > 0).sum()) for d in documents], pa.int64()),
            pa.array([tokens] * len(documents), pa.int64()),
            pa.array([float(logs[d].sum()) for d in documents], pa.float64()),
            pa.array(score, pa.float64()),
        ]
        return pa.Table.from_arrays(columns, names)

    schema = (
        "doc_id bigint, trains boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    return chunks.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, schema)
