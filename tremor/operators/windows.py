"""Substrings of texts that may be one of many names, found by hashes of their windows.

A window is a run of 2, 4, 8, ... bytes (or one). Its hash is made of those of its halves, so all windows
of a size cost a few passes over a text. A name of ``length`` bytes is covered by the largest
window it begins with and the one it ends with: a bitmap knows the hashes of the first windows and those of whole
names (first window, last window, length). What passes both may be a name; the caller compares it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_OF_BYTE = np.random.Generator(np.random.PCG64(1)).integers(0, 1 << 64, 256, np.uint64)
#: Bytes of text that are looked up at once.
_PIECE = 1 << 18
#: Candidates in an Arrow batch.
_ROWS = 1 << 16


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = left * _FIRST
    out ^= out >> np.uint64(29)
    out += right
    out *= _SECOND
    out ^= out >> np.uint64(32)
    return out


def _levels(data: np.ndarray, last: int) -> Iterator[np.ndarray]:
    """Hashes of the windows of 1, 2, 4, ... bytes at each position."""
    hashes = _OF_BYTE[data]
    yield hashes
    for level in range(last):
        half = 1 << level
        if len(hashes) <= half:
            return
        hashes = _joined(hashes[:-half], hashes[half:])
        yield hashes


def _whole(first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    return _joined(_joined(first, last), np.full(1, length, np.uint64))


def name_bits(name: bytes, bits: int) -> tuple[int, int]:
    """The two bits of a name in a bitmap of ``2 << bits``."""
    level = len(name).bit_length() - 1
    hashes = list(_levels(np.frombuffer(name, np.uint8), level))[-1]
    shift = 64 - bits
    whole = _whole(hashes[:1], hashes[-1:], len(name))
    return int(hashes[0]) >> shift, (1 << bits) + (int(whole[0]) >> shift)


@dataclass(frozen=True)
class NameFilter:
    lengths: list[int]  # the names' different lengths in bytes
    bits: int
    bitmap: np.ndarray  # 2 << bits, eight in a byte

    def _set(self, at: np.ndarray) -> np.ndarray:
        return (self.bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def places(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """Positions where a name of a length may begin."""
        if not self.lengths:
            return
        shift, second = np.uint64(64 - self.bits), np.uint64(1 << self.bits)
        for level, hashes in enumerate(_levels(data, max(self.lengths).bit_length() - 1)):
            own = [n for n in self.lengths if n.bit_length() - 1 == level]
            if not own:
                continue
            begun = np.flatnonzero(self._set(hashes >> shift))
            for length in own:
                end = begun + (length - (1 << level))
                at = begun[: np.searchsorted(end, len(hashes))]
                whole = _whole(hashes[at], hashes[at + (length - (1 << level))], length)
                yield at[self._set((whole >> shift) + second)], length

    def candidates(self, texts: pa.Array) -> Iterator[tuple[list[int], list[bytes]]]:
        """Rows and different substrings of each row that may be names; a row's lie in one list or more."""
        texts = texts.cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        piece = max(_PIECE, 2 * max(self.lengths, default=1))
        row = 0
        while row < len(texts):
            after = max(row + 1, int(np.searchsorted(offsets, offsets[row] + piece, "right")) - 1)
            ends, found = offsets[row + 1 : after + 1], {}
            # Only a single row can be longer than a piece; its pieces overlap by a name.
            step = piece - max(self.lengths, default=1) + 1
            for begin in range(offsets[row], max(offsets[after], offsets[row] + 1), step if after == row + 1 else piece):
                own = data[begin : min(begin + piece, offsets[after])]
                raw = own.tobytes()
                for at, length in self.places(own):
                    rows = np.searchsorted(ends, at + begin, "right")
                    inside = at + (begin + length) <= ends[np.minimum(rows, len(ends) - 1)]
                    at, rows = at[inside], rows[inside] + row
                    found.update(dict.fromkeys(zip(rows.tolist(), [raw[p : p + length] for p in at.tolist()], strict=True)))
            yield [r for r, _ in found], [s for _, s in found]
            row = after


def candidate_batches(batches: Iterator[pa.RecordBatch], names: NameFilter) -> Iterator[pa.RecordBatch]:
    """``(key, _found)`` of batches ``(key, text)`` without NULL texts."""
    for batch in batches:
        keys, held_rows, held = batch.column(0), [], []
        for rows, found in names.candidates(batch.column(1)):
            held_rows += rows
            held += found
            for first in range(0, len(held) - _ROWS + 1, _ROWS):
                yield _batch(keys, held_rows[first : first + _ROWS], held[first : first + _ROWS])
            done = len(held) // _ROWS * _ROWS
            held_rows, held = held_rows[done:], held[done:]
        yield _batch(keys, held_rows, held)


def _batch(keys: pa.Array, rows: list[int], found: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([keys.take(pa.array(rows, pa.int64())), pa.array(found, pa.binary())], ["key", "_found"])
