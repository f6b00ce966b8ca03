"""SentencePiece BPE by vectorised merge rounds, and decoding.

The symbols of many words lie in one flat array. A round finds the best (lowest) rank among the
neighbouring pairs of each word, joins every occurrence of it from left to right at once, and closes
the array up; a word whose pairs have no rank left is done. The library instead joins one pair at a
time, the best of the whole text and of equals the leftmost. Both give the same pieces unless a join
makes a pair that is no worse than the one just joined, as in runs of blanks, whose pieces share one
rank. Such words are noticed and joined one pair at a time.

Words end where no piece reaches across: a piece holds word marks at its front only, and the
characters that no longer piece holds stand alone.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tremor.llm.common import slices, trimmed, utf8

_MARK = "▁"
_NONE = np.int32(2**31 - 1)
#: Texts that tell a plain normalizer (a mark in front, blanks to marks) from any other.
_PROBES = ("", " ", "  a  b ", "é é Ａ ﬁ Ω", "a\r\n\tb c　​", f"{_MARK}x {_MARK}")


def normalized(text: str) -> str:
    """A mark in front and marks for blanks; the empty text stays empty."""
    return (" " + text).replace(" ", _MARK) if text else ""


class PieceBpe:
    """Encodes and decodes as a SentencePiece BPE model with byte fallback and plain normalization.

    The library only reads the model file. ``memo_bytes`` bounds what is remembered of words met
    before. A model of another kind is refused.
    """

    def __init__(self, path: str, memo_bytes: int = 48 << 20):
        model = SentencePieceProcessor(model_file=path)
        numbers = range(model.get_piece_size())
        if any(model.is_unused(i) for i in numbers) or any(model.normalize(t) != normalized(t) for t in _PROBES):
            raise ValueError("a model without unused pieces and with a plain normalizer is expected")
        self._ends = model.bos_id(), model.eos_id()
        bare = [i for i in numbers if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)]
        apart = set(bare)
        pieces = {model.id_to_piece(i): i for i in numbers if i not in apart}
        by_byte = {int(model.id_to_piece(i)[1:-1], 16): i for i in bare if model.is_byte(i)}
        if len(by_byte) != 256 or any(_MARK in piece.lstrip(_MARK) for piece in pieces):
            raise ValueError("byte pieces, and marks only in front of others, are expected")
        self._byte_ids = np.array([by_byte[b] for b in range(256)], np.uint32)
        self._surfaces = [b""] * len(numbers)
        for piece, i in pieces.items():
            self._surfaces[i] = piece.replace(_MARK, " ").encode()
        for byte, i in by_byte.items():
            self._surfaces[i] = bytes([byte])
        self._marked = {i for piece, i in pieces.items() if piece.startswith(_MARK)}
        for i in numbers:
            if model.is_unknown(i):
                self._surfaces[i] = model.decode([i]).encode()
        self._learn(pieces, {i: model.get_score(i) for i in pieces.values()}, len(numbers))
        lone = [c for c in map(chr, range(128)) if c != " " and not any(c in p for p in pieces if len(p) > 1)]
        alone = re.escape("".join(lone)).encode()
        self._words = re.compile(rb" *[^ %b]+| +|[%b]" % (alone, alone) if lone else rb" *[^ ]+| +").findall
        self._memo_bytes = memo_bytes
        self.forget()

    def _learn(self, pieces: dict[str, int], scores: dict[int, float], first_free: int) -> None:
        """The symbol of each character, and for each pair of symbols the piece they join to."""
        order = sorted(set(scores.values()), reverse=True)
        rank_of = {score: rank for rank, score in enumerate(order)}
        symbols = dict(pieces)
        for piece in pieces:
            for char in piece:
                symbols.setdefault(char, first_free + len(symbols) - len(pieces))
        #: Numbers from here on are no pieces: characters of longer pieces, then ``_strange``.
        self._first_free = first_free
        self._strange = first_free + len(symbols) - len(pieces)
        self._wide = self._strange + 1
        self._symbol_of = np.full(0x110000, self._strange, np.int32)
        for char, number in symbols.items():
            if len(char) == 1:
                self._symbol_of[ord(char)] = number
        self._symbol_of[ord(" ")] = symbols[_MARK]
        pairs = {}
        for piece, number in pieces.items():
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    pairs[left * self._wide + right] = number
        self._pair_keys = np.array(sorted(pairs), np.int64)
        self._pair_piece = np.array([pairs[k] for k in self._pair_keys.tolist()], np.int32)
        ranks = np.full(first_free, _NONE, np.int32)
        for number, score in scores.items():
            ranks[number] = rank_of[score]
        self._pair_rank = ranks[self._pair_piece]
        self._single = {k: (rank_of[scores[number]], number) for k, number in pairs.items()}
        side_by_side = {symbols[a] * self._wide + symbols[b] for p in pieces for a, b in pairwise(p)}
        self._neighbours = np.array(sorted(side_by_side), np.int64)

    def forget(self) -> None:
        """Drops the memo; an idle worker need not keep it."""
        self._memo: dict[bytes, bytes] = {}
        self._held = 0

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For neighbouring symbols the rank of joining them (``_NONE``: never) and the piece."""
        keys = left.astype(np.int64) * self._wide + right
        at = np.minimum(np.searchsorted(self._pair_keys, keys), len(self._pair_keys) - 1)
        found = self._pair_keys[at] == keys
        return np.where(found, self._pair_rank[at], _NONE), self._pair_piece[at]

    def _joined(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Merge rounds over words of ``sizes`` symbols: each word's pieces where they begin, else -1."""
        out = np.full(len(symbols), -1, np.int32)
        again = np.zeros(len(sizes), bool)
        word = np.repeat(np.arange(len(sizes)), sizes)
        sym, at = symbols.copy(), np.arange(len(symbols))
        rank, piece = self._ranked(sym, word, at)
        while len(sym):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, starts)
            lengths = np.diff(starts, append=len(sym))
            open_ = best != _NONE
            if not open_.all():
                busy = np.repeat(open_, lengths)
                out[at[~busy]] = sym[~busy]
                sym, at, word, rank, piece = (a[busy] for a in (sym, at, word, rank, piece))
                lengths, best = lengths[open_], best[open_]
                if not len(sym):
                    break
            hits = np.flatnonzero(rank == np.repeat(best, lengths))
            # Of hits that overlap, every other one from the left.
            run = np.maximum.accumulate(np.where(np.diff(hits, prepend=-2) != 1, hits, 0))
            hits = hits[(hits - run) % 2 == 0]
            was, own = rank[hits], word[hits]
            several = np.diff(own, prepend=-1) == 0
            several[:-1] |= several[1:]
            # The pair of a joined hit and what the next hit then joins counts as made, too.
            close = np.flatnonzero((np.diff(hits) == 2) & (np.diff(own) == 0))
            following = sym[hits[close] + 2]
            sym[hits] = piece[hits]
            passing, _ = self._pairs(sym[hits[close]], following)
            again[own[close][passing <= was[close]]] = True
            kept = np.ones(len(sym), bool)
            kept[hits + 1] = False
            sym, at, word, rank, piece = (a[kept] for a in (sym, at, word, rank, piece))
            hits -= np.arange(len(hits))
            before = np.maximum(hits - 1, 0)
            rank[hits], piece[hits] = self._ranked(sym, word, hits)
            rank[before], piece[before] = self._ranked(sym, word, before)
            made = np.minimum(rank[hits], np.where(word[before] == own, rank[before], _NONE))
            again[own[several & (made <= was)]] = True
        for number, start in zip(np.flatnonzero(again).tolist(), (np.cumsum(sizes) - sizes)[again].tolist(), strict=True):
            out[start : start + sizes[number]] = self._one_by_one(symbols[start : start + sizes[number]].tolist())
        return out

    def _ranked(self, sym: np.ndarray, word: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of the pairs that begin at ``left``."""
        right = np.minimum(left + 1, len(sym) - 1)
        rank, piece = self._pairs(sym[left], sym[right])
        rank[(right == left) | (word[left] != word[right])] = _NONE
        return rank, piece

    def _one_by_one(self, sym: list[int]) -> list[int]:
        """The best pair of one word at a time, the leftmost of equals."""
        following = [*range(1, len(sym)), -1]
        preceding = list(range(-1, len(sym) - 1))
        waiting: list[tuple[int, int, int, int, int]] = []

        def offer(at: int) -> None:
            b = following[at] if at >= 0 else -1
            if b >= 0 and (found := self._single.get(sym[at] * self._wide + sym[b])):
                heappush(waiting, (found[0], at, sym[at], sym[b], found[1]))

        for at in range(len(sym)):
            offer(at)
        while waiting:
            _, a, left, right, whole = heappop(waiting)
            b = following[a]
            if sym[a] != left or b < 0 or sym[b] != right:
                continue
            sym[a], sym[b] = whole, -1
            following[a] = following[b]
            if following[b] >= 0:
                preceding[following[b]] = a
            offer(preceding[a])
            offer(a)
        return sym

    def _encode_words(self, words: list[bytes]) -> None:
        """Adds the words' ids to the memo. Their blanks are marks."""
        joined = b"".join(words)
        raw = np.frombuffer(joined, np.uint8)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        begins_char = (raw & 0xC0) != 0x80
        points = np.frombuffer(joined.decode().encode("utf-32-le"), "<u4")
        word_ends = np.cumsum(begins_char)[ends - 1]
        symbols = self._symbol_of[points]
        # Words are cut further where no piece holds both neighbours.
        cuts = ~self._meet(symbols[:-1], symbols[1:])
        cuts[word_ends[:-1] - 1] = True
        bounds = np.concatenate([[0], np.flatnonzero(cuts) + 1, [len(symbols)]])
        pieces = self._joined(symbols, np.diff(bounds))
        heads = np.flatnonzero(pieces >= 0)
        ids = pieces[heads]
        bare = ids >= self._first_free
        counts = np.ones(len(ids), np.int64)
        strange = points[heads[bare]]
        counts[bare] = 1 + (strange > 0x7F) + (strange > 0x7FF) + (strange > 0xFFFF)
        spread = np.repeat(ids, counts).astype("<u4")
        spread[np.repeat(bare, counts)] = self._byte_ids[np.frombuffer(strange.tobytes().decode("utf-32-le").encode(), np.uint8)]
        stops = 4 * np.cumsum(counts)[np.searchsorted(heads, word_ends) - 1]
        coded, start = spread.tobytes(), 0
        for word, stop in zip(words, stops.tolist(), strict=True):
            self._memo[word] = coded[start:stop]
            start = stop
        self._held += 130 * len(words) + len(joined) + len(coded)

    def _meet(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether any piece holds the two characters side by side."""
        keys = left.astype(np.int64) * self._wide + right
        at = np.minimum(np.searchsorted(self._neighbours, keys), len(self._neighbours) - 1)
        return self._neighbours[at] == keys

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text, begin and end ids included, as little-endian unsigned 32-bit numbers."""
        if self._held > self._memo_bytes:
            self.forget()
        begin, end = (i.to_bytes(4, "little") for i in self._ends)
        split = [self._words(b" " + t.replace(_MARK.encode(), b" ")) if t else [] for t in texts]
        fresh = [word for word in set().union(*split) if word not in self._memo]
        if fresh:
            self._encode_words(fresh)
        known = self._memo.__getitem__
        return [b"".join([begin, *map(known, own), end]) for own in split]

    def decode(self, ids: bytes) -> bytes:
        """The text of the ids in UTF-8. Byte pieces that are no UTF-8 become U+FFFD each, begin and
        end ids give nothing, and the blank of a mark in front goes."""
        values = np.frombuffer(ids, "<u4")
        numbers = values.tolist()
        edges = [-1, *np.flatnonzero(np.isin(values, self._ends)).tolist(), len(numbers)]
        runs = [numbers[a + 1 : b] for a, b in pairwise(edges) if b - a > 1]
        found = [_readable(b"".join(map(self._surfaces.__getitem__, run))) for run in runs]
        if runs and runs[0][0] in self._marked:
            found[0] = found[0][1:]
        return b"".join(found)


def _readable(raw: bytes) -> bytes:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return raw.decode("utf-8", "each_byte").encode()
    return raw


codecs.register_error("each_byte", lambda error: ("\ufffd", error.start + 1))

_loaded: dict[tuple[str, int], PieceBpe] = {}


def piece_bpe(path: str, memo_bytes: int = 48 << 20) -> PieceBpe:
    """One encoder per process and file."""
    key = (path, memo_bytes)
    if key not in _loaded:
        _loaded[key] = PieceBpe(path, memo_bytes)
    return _loaded[key]


def piece_coded(
    docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for every row, and ``ids``, ``decoded`` on request.

    Texts are encoded whole, begin and end ids included, and the ids decoded again, within the
    task that reads them: no shuffle. ``path`` must exist on every executor. A NULL text counts as
    empty, which has the begin and end ids alone and decodes to the empty text; NULL ids, repeated
    rows and an empty table are kept as they are, and other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = piece_bpe(path)
        for batch in batches:
            texts = batch.column(1)
            for first, last in slices(texts, 2 << 20):
                ids = bpe.encode(texts[first:last].to_pylist())
                decoded = [bpe.decode(own) for own in ids]
                columns = [
                    batch.column(0)[first:last],
                    pa.array([len(own) // 4 for own in ids], pa.int64()),
                    pa.array([hashlib.sha256(own).hexdigest() for own in ids]),
                    pa.array([hashlib.sha256(own).hexdigest() for own in decoded]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns += [pa.array(ids, pa.binary()), pa.array([d.decode() for d in decoded])]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)
        bpe.forget()

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(text).alias("text"))
    return rows.mapInArrow(trimmed(run), schema + (", ids binary, decoded string" if with_ids else ""))
