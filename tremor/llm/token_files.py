"""Token ids in files of independently decodable rANS blocks.

A folder holds three Parquet tables, so any store that Spark writes to will do:
``frequencies`` (token, frequency), shared by all blocks; ``blocks`` (part, block, start, doc_ids,
lengths, payload), where ``payload`` is a block as :mod:`tremor.llm.rans` lays it out, ``start`` the
number of ids before it in the whole corpus, and ``doc_ids`` and ``lengths`` cut it into documents.
Documents come in ascending id order from part to part and block to block.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import CharDelimiterSplit

from tremor.llm import rans
from tremor.llm.bpe import PLAIN, byte_characters, plain_splitter
from tremor.llm.common import slices, stored, strings_over, utf8
from tremor.llm.context_mixing import ranges
from tremor.llm.ranges import range_bounds, range_part

#: Ids from which a block is closed; it ends with the document that reaches them.
BLOCK_TOKENS = 1 << 16
#: Words that the model is given at a time.
_ASKED = 512
_FREQUENCIES = "token int, frequency bigint"
_BLOCKS = "part int, block int, start bigint, doc_ids array<bigint>, lengths array<int>, payload binary"


#: Texts that the file's pattern, in ``re``'s classes, cuts as the library does.
_PLAIN_TEXT = re.compile("[ \\t\\n\\v\\f\\r!-~\u00a1-\u024f]*").fullmatch


def _character_class(kind: str) -> str:
    """The characters of a Unicode kind that plain texts hold in lower case, for use within brackets."""
    plain = map(chr, [*range(33, 127), *range(0xA1, 0x250)])
    own = sorted({ord(c) for char in plain for c in char + char.lower() if regex.fullmatch(kind, c)})
    return "".join(f"\\u{c:04x}" for c in own)


def plain_text_splitter(spec: dict) -> Callable[[str], list[str]] | None:
    """``plain_splitter`` by the standard library's faster ``re``, for plain texts only."""
    if plain_splitter(spec) is None:
        return None
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    for kind in (r"\p{L}", r"\p{N}"):
        pattern = pattern.replace(kind, _character_class(kind))
    # A word is cut alike wherever it stands if nothing looks beyond it.
    return None if re.search(r"\\p|\(\?|\\[bB]|\$|(?<!\[)\^", pattern) else re.compile(pattern).findall


class LibraryEncoder:
    """The tokenizers library, asked once per distinct word or run of characters.

    White space never enters a token of such a vocabulary, so the ids of a text's runs joined are the
    text's. Texts are cut at ASCII white space and equal runs counted once; the distinct ones that are plain (no letters
    whose case or normal form is disputed, no first character of an added token) are cut into words, and words not met
    before go to the library's model, thousands at a time. Runs that are not plain pass through the whole library.

    ``memo_bytes`` bounds what is remembered: when half of it is filled, what was not used since the
    last time goes.
    """

    def __init__(self, path: str, memo_bytes: int = 128 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is the only one it has
        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._words = plain_text_splitter(spec)
        # The model alone, to which words are given by lines.
        self._model = Tokenizer(self._library.model)
        self._model.pre_tokenizer = CharDelimiterSplit("\n")
        suffix = spec["model"].get("end_of_word_suffix")
        vocab = self._library.get_vocab(with_added_tokens=False)
        self._ends = np.zeros(max(vocab.values()) + 1, bool)
        self._ends[[number for token, number in vocab.items() if suffix and token.endswith(suffix)]] = True
        # An added token may only be found by the whole library.
        self._marks = sorted({t["content"][0] for t in spec["added_tokens"]})
        self._shown = byte_characters()
        self._memo_bytes = memo_bytes
        self._recent: dict[str | bytes, bytes] = {}
        self._earlier: dict[str | bytes, bytes] = {}
        self._held = 0

    def _marked(self, text: str) -> bool:
        return any(mark in text for mark in self._marks)

    def _ask(self, words: list[str]) -> Iterator[bytes]:
        """The model's ids of each word."""
        shown = [w if w.isascii() else w.encode().decode("latin-1").translate(self._shown) for w in words]
        for at in range(0, len(shown), _ASKED):
            some = shown[at : at + _ASKED]
            (found,) = self._model.encode_batch_fast(["\n".join(some)], add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            # A word's last token says that it is one.
            ends = np.flatnonzero(self._ends[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                raw = ids.tobytes()
                yield from (raw[a:b] for a, b in pairwise([0, *(4 * ends).tolist()]))
            else:
                yield from (array("I", [t.id for t in self._library.model.tokenize(word)]).tobytes() for word in some)

    def _remember(self, units: list[str | bytes]) -> None:
        """From here on ``_recent`` has the ids of all units."""
        words, ids = [], []
        for unit in set(units).difference(self._recent):
            known = self._earlier.get(unit)
            if known is None and isinstance(unit, str):
                words.append(unit)
                continue
            if known is None:
                known = array("I", self._library.encode(unit.decode(), add_special_tokens=False).ids).tobytes()
            self._recent[unit] = known
            ids.append(known)
        own = list(self._ask(words))
        self._recent.update(zip(words, own, strict=True))
        self._held += 200 * (len(ids) + len(own)) + sum(map(len, ids)) + sum(map(len, own))

    def _cut(self, lines: str) -> tuple[list[str | bytes], np.ndarray]:
        """The words of plain runs as strings, any other run as bytes, and how many there are up to each run's end.
        The runs are given a line each."""
        runs = lines.split("\n")
        if self._words and _PLAIN_TEXT(lines) and not self._marked(lines):
            lines = lines.lower()
            words = self._words(lines)
            ends = np.cumsum([0, *map(len, words)])
            until = np.cumsum(np.fromiter(map(len, lines.split("\n")), np.int64, len(runs)))
            last = np.searchsorted(ends, until, "right") - 1
            # Else the pattern leaves out characters besides white space.
            if (ends[last] == until).all():
                return words, last
        units: list[str | bytes] = []
        last = []
        for run in runs:
            if self._words and PLAIN.fullmatch(run) and not self._marked(run):
                units += self._words(run.lower())
            elif run:
                units.append(run.encode())
            last.append(len(units))
        return units, np.array(last, np.int64)

    def _lower(self, raw: bytes) -> bytes:
        """A plain text in lower case, any other as it is."""
        text = raw.decode()
        return raw.lower() if self._words and _PLAIN_TEXT(text) and not self._marked(text) else raw

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        lower = list(map(self._lower, texts))
        split = pc.ascii_split_whitespace(strings_over(np.cumsum([0, *map(len, lower)]), b"".join(lower)))
        coded = split.flatten().dictionary_encode()
        runs = coded.dictionary
        units, last = self._cut(pc.binary_join(pa.ListArray.from_arrays([0, len(runs)], runs), "\n")[0].as_py())
        self._remember(units)
        known = list(map(self._recent.__getitem__, units))
        ends = np.cumsum([0, *map(len, known)])[last] // 4
        sizes = np.diff(ends, prepend=0)
        index = coded.indices.to_numpy()
        ids = np.frombuffer(b"".join(known), "<u4")[ranges((ends - sizes)[index], sizes[index])].tobytes()
        bounds = 4 * np.cumsum(np.append(0, sizes[index]))[split.offsets.to_numpy()]
        if self._held > self._memo_bytes // 2:
            self._recent, self._earlier, self._held = {}, self._recent, 0
        return [ids[a:b] for a, b in pairwise(bounds.tolist())]


_encoders: dict[str, LibraryEncoder] = {}


def _staged(docs: DataFrame, path: str, end_id: int, text: str, doc_id: str) -> DataFrame:
    """Blocks of plain ids: ``(part, block, first, doc_ids, lengths, ids)``, ``first`` within the part."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("text"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(rows.select("doc_id"), 4 * tasks)
    placed = rows.withColumn("_part", range_part(F.col("doc_id"), bounds))
    dealt = placed.select("_part.part", "doc_id", "text").repartition(tasks, "part")
    ordered = dealt.sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "text")
    end = end_id.to_bytes(4, "little")
    names = ["part", "block", "first", "doc_ids", "lengths", "ids"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(path) or _encoders.setdefault(path, LibraryEncoder(path))
        part, block, first = -1, 0, 0
        numbers: list[int | None] = []
        ids: list[bytes] = []
        size = 0

        def closed() -> pa.RecordBatch:
            values = part, block, first, numbers, [len(i) // 4 for i in ids], b"".join(ids)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

        for batch in batches:
            texts = batch.column(2)
            for low, high in slices(texts):
                encoded = encoder.encode(texts[low:high].to_pylist())
                heads = zip(batch.column(0)[low:high].to_pylist(), batch.column(1)[low:high].to_pylist(), strict=True)
                for (own_part, number), own in zip(heads, encoded, strict=True):
                    if numbers and (own_part != part or size >= BLOCK_TOKENS):
                        yield closed()
                        block, first = block + 1, first + size
                        numbers, ids, size = [], [], 0
                    if own_part != part:
                        part, block, first = own_part, 0, 0
                    numbers.append(number)
                    ids.append(own + end)
                    size += len(own) // 4 + 1
        if numbers:
            yield closed()

    schema = "part int, block int, first bigint, doc_ids array<bigint>, lengths array<int>, ids binary"
    return ordered.mapInArrow(run, schema)


def _token_counts(staged: DataFrame) -> list:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for value in batch.column(0):
                own = np.bincount(np.frombuffer(value.as_py(), "<u4"))
                if len(own) > len(counts):
                    own[: len(counts)] += counts
                    counts = own
                else:
                    counts[: len(own)] += own
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["token", "n"])

    counted = staged.select("ids").mapInArrow(run, "token bigint, n bigint")
    # A row per id of the vocabulary at most.
    return counted.groupBy("token").agg(F.sum("n").alias("n")).collect()


def write_token_files(
    docs: DataFrame, folder: str, path: str, end_id: int, text: str = "text", doc_id: str = "doc_id"
) -> None:
    """Encodes every whole text with the library, appends ``end_id``, and writes the folder.

    A NULL text counts as empty: the end id alone. Rows without an id come first, repeated ids
    follow each other in the order of their texts. Other columns are not read. An empty table
    gives tables without rows.
    """
    spark = docs.sparkSession
    staged = stored(_staged(docs, path, end_id, text, doc_id), "token-blocks", "zstd")
    counts = _token_counts(staged)
    frequency = np.zeros(max([r.token for r in counts], default=0) + 1, np.int64)
    for row in counts:
        frequency[row.token] = row.n
    frequency = rans.scaled(frequency) if counts else np.zeros(0, np.int64)
    pairs = [(int(t), int(frequency[t])) for t in np.flatnonzero(frequency)]
    spark.createDataFrame(pairs, _FREQUENCIES).coalesce(1).write.parquet(f"{folder}/frequencies")
    shared = spark.sparkContext.broadcast(frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            table = table or rans.Table.of(shared.value)
            ids = batch.column(5)
            for low, high in slices(ids, 16 << 20):
                blocks = [np.frombuffer(v, "<u4") for v in ids[low:high].to_pylist()]
                payload = pa.array(rans.encode(blocks, table), pa.binary())
                columns = [batch.column(k)[low:high] for k in range(5)]
                yield pa.RecordBatch.from_arrays([*columns, payload], ["part", "block", "first", "doc_ids", "lengths", "payload"])

    # One row per range of ids: as many as there are tasks, times four.
    totals = staged.select("part", F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, n: a + n).alias("n"))
    rows = totals.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    before = np.cumsum([0] + [r.n for r in rows])
    starts = spark.createDataFrame(
        [(r.part, int(b)) for r, b in zip(rows, before[:-1], strict=True)], "_part int, before bigint"
    )
    coded = staged.mapInArrow(
        run, "part int, block int, first bigint, doc_ids array<bigint>, lengths array<int>, payload binary"
    )
    placed = coded.join(starts, F.col("part") == F.col("_part")).withColumn("start", F.col("before") + F.col("first"))
    placed.select("part", "block", "start", "doc_ids", "lengths", "payload").write.parquet(f"{folder}/blocks")


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files, and ``ids`` on request.

    Each block is decoded by itself and its checksums are verified.
    """
    pairs = spark.read.schema(_FREQUENCIES).parquet(f"{folder}/frequencies").collect()
    frequency = np.zeros(max([r.token for r in pairs], default=-1) + 1, np.int64)
    for row in pairs:
        frequency[row.token] = row.frequency
    shared = spark.sparkContext.broadcast(frequency)
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            table = table or rans.Table.of(shared.value)
            payload = batch.column(3)
            for low, high in slices(payload, 8 << 20):
                blocks = rans.decode(payload[low:high].to_pylist(), table)
                numbers, starts, sizes, sums, ids = [], [], [], [], []
                for k, tokens in enumerate(blocks, low):
                    lengths = batch.column(2)[k].as_py()
                    ends = np.cumsum(lengths)
                    raw = tokens.astype("<u4").tobytes()
                    numbers += batch.column(1)[k].as_py()
                    starts += (batch.column(0)[k].as_py() + ends - lengths).tolist()
                    sizes += lengths
                    own = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths, strict=True)]
                    sums += map(zlib.crc32, own)
                    ids += own if with_ids else []
                columns = [pa.array(v, pa.int64()) for v in (numbers, starts, sizes, sums)]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names)

    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks").select("start", "doc_ids", "lengths", "payload")
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return blocks.mapInArrow(run, schema + (", ids binary" if with_ids else ""))
