"""Static range asymmetric numeral system (rANS) over token ids, vectorised over lanes and blocks.

A block's tokens are dealt over ``LANES`` states in turn; all states share one frequency table
and one stream of 32-bit words, whose order the decoder can follow: at each step the lanes that
run low take the next words, from the first lane to the last. Blocks are independent, so many
are coded side by side as one array. Every ``CHECKPOINT`` steps a block notes its states and the
place in the stream, from where decoding can begin as well.

Block layout, little-endian: magic ``TRN1``; tokens, words and checkpoints (u32 each); CRC-32 of the
tokens as u32, and of everything after the header (u32 each); the first states (u64 per lane); for each
checkpoint the place in the stream (u32) and the states (u64 per lane); the words (u32).
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

LANES = 64
SCALE = 20  # frequencies sum to 2 ** SCALE
CHECKPOINT = 256
#: Blocks that are coded side by side.
SIDE_BY_SIDE = 64
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_MASK = np.uint64(0xFFFFFFFF)
_HEADER = struct.Struct("<4s5I")
_MAGIC = b"TRN1"


@dataclass(frozen=True)
class Table:
    """Frequencies of all ids from 0 on; an id with frequency 0 cannot be coded."""

    frequency: np.ndarray
    first: np.ndarray
    token_of: np.ndarray

    @staticmethod
    def of(frequency: np.ndarray) -> Table:
        frequency = np.asarray(frequency, np.uint64)
        first = np.cumsum(frequency) - frequency
        token_of = np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency.astype(np.int64))
        if len(token_of) != 1 << SCALE:
            raise ValueError("the frequencies must sum to the scale")
        return Table(frequency, first, token_of)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies in proportion to the counts, at least 1 where the count is, summing to the scale."""
    counts = np.asarray(counts, object)
    used = np.flatnonzero(counts > 0)
    if not len(used) or len(used) > 1 << SCALE:
        raise ValueError("between 1 and 2 ** SCALE ids must occur")
    room, total = (1 << SCALE) - len(used), int(counts.sum())
    result = np.zeros(len(counts), np.int64)
    result[used] = [1 + int(c) * room // total for c in counts[used]]
    result[int(np.argmax(result))] += (1 << SCALE) - int(result.sum())
    return result


def encode(blocks: list[np.ndarray], table: Table) -> list[bytes]:
    """Each block's bytes. Blocks of like size are coded side by side."""
    order = sorted(range(len(blocks)), key=lambda k: len(blocks[k]))
    result: list[bytes] = [b""] * len(blocks)
    for at in range(0, len(order), SIDE_BY_SIDE):
        some = order[at : at + SIDE_BY_SIDE]
        for k, coded in zip(some, _encode([blocks[k] for k in some], table), strict=True):
            result[k] = coded
    return result


def _encode(blocks: list[np.ndarray], table: Table) -> list[bytes]:
    sizes = np.array([len(b) for b in blocks])
    steps = int(-(-sizes.max() // LANES))
    tokens = np.zeros((len(blocks), steps * LANES), np.uint32)
    for row, block in zip(tokens, blocks, strict=True):
        row[: len(block)] = block
    tokens = np.ascontiguousarray(tokens.reshape(len(blocks), steps, LANES).swapaxes(0, 1))
    lanes = np.arange(LANES)
    states = np.full((len(blocks), LANES), _LOW, np.uint64)
    words = np.zeros(tokens.shape, np.uint32)
    given = np.zeros(tokens.shape, bool)
    notes: dict[int, np.ndarray] = {}
    shift = np.uint64(63 - SCALE)
    for step in reversed(range(steps)):
        if (step + 1) % CHECKPOINT == 0:
            notes[step + 1] = states.copy()
        frequency, first = table.frequency[tokens[step]], table.first[tokens[step]]
        active = step * LANES + lanes < sizes[:, None]
        if not frequency[active].all():
            raise ValueError("an id that the table lacks")
        frequency = np.maximum(frequency, np.uint64(1))
        full = active & (states >= frequency << shift)
        words[step], given[step] = states & _MASK, full
        lowered = np.where(full, states >> _WORD, states)
        quotient, rest = np.divmod(lowered, frequency)
        states = np.where(active, (quotient << np.uint64(SCALE)) + first + rest, states)
    taken = np.cumsum(given.sum(axis=2), axis=0)
    out = []
    for k, block in enumerate(blocks):
        marks = [s for s in sorted(notes) if s * LANES < len(block)]
        body = [states[k].astype("<u8").tobytes()]
        for s in marks:
            body += [struct.pack("<I", taken[s - 1, k]), notes[s][k].astype("<u8").tobytes()]
        stream = words[:, k][given[:, k]]
        body.append(stream.astype("<u4").tobytes())
        rest = b"".join(body)
        checks = zlib.crc32(np.asarray(block, "<u4").tobytes()), zlib.crc32(rest)
        out.append(_HEADER.pack(_MAGIC, len(block), len(stream), len(marks), *checks) + rest)
    return out


@dataclass(frozen=True)
class _Block:
    tokens: int
    crc: int
    states: list[np.ndarray]  # at step 0 and at each checkpoint
    places: list[int]
    words: np.ndarray


def _parse(coded: bytes) -> _Block:
    magic, tokens, words, marks, crc, rest_crc = _HEADER.unpack_from(coded)
    if magic != _MAGIC or zlib.crc32(memoryview(coded)[_HEADER.size :]) != rest_crc:
        raise ValueError("a damaged block")
    at = _HEADER.size
    states, places = [np.frombuffer(coded, "<u8", LANES, at)], [0]
    at += 8 * LANES
    for _ in range(marks):
        places.append(struct.unpack_from("<I", coded, at)[0])
        states.append(np.frombuffer(coded, "<u8", LANES, at + 4))
        at += 4 + 8 * LANES
    return _Block(tokens, crc, states, places, np.frombuffer(coded, "<u4", words, at))


def decode(coded: list[bytes], table: Table) -> list[np.ndarray]:
    """The tokens of each block; fails where a checksum does."""
    parsed = [_parse(c) for c in coded]
    order = sorted(range(len(parsed)), key=lambda k: parsed[k].tokens)
    result: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(parsed)
    for at in range(0, len(order), SIDE_BY_SIDE):
        some = order[at : at + SIDE_BY_SIDE]
        own = [parsed[k] for k in some]
        runs = _decode([(b.states[0], b.words, b.tokens) for b in own], table)
        for k, block, tokens in zip(some, own, runs, strict=True):
            if zlib.crc32(tokens.astype("<u4").tobytes()) != block.crc:
                raise ValueError("a block whose tokens fail their checksum")
            result[k] = tokens
    return result


def decode_from_checkpoints(coded: bytes, table: Table) -> np.ndarray:
    """One block's tokens, all its checkpointed runs decoded side by side."""
    block = _parse(coded)
    span = CHECKPOINT * LANES
    runs = []
    for k, (states, place) in enumerate(zip(block.states, block.places, strict=True)):
        runs.append((states, block.words[place:], min(span, block.tokens - k * span)))
    return np.concatenate(_decode(runs, table))


def _decode(runs: list[tuple[np.ndarray, np.ndarray, int]], table: Table) -> list[np.ndarray]:
    sizes = np.array([n for _, _, n in runs])
    steps = int(-(-sizes.max() // LANES))
    states = np.stack([s for s, _, _ in runs]).astype(np.uint64)
    words = np.concatenate([w for _, w, _ in runs] + [np.zeros(1, np.uint32)]).astype(np.uint64)
    place = np.cumsum([0] + [len(w) for _, w, _ in runs[:-1]])
    tokens = np.zeros((steps, len(runs), LANES), np.uint32)
    lanes = np.arange(LANES)
    low_bits = np.uint64((1 << SCALE) - 1)
    for step in range(steps):
        active = step * LANES + lanes < sizes[:, None]
        slot = states & low_bits
        token = table.token_of[slot]
        tokens[step] = token
        moved = table.frequency[token] * (states >> np.uint64(SCALE)) + slot - table.first[token]
        needs = active & (moved < _LOW)
        order = np.cumsum(needs, axis=1)
        # A wrong table may ask for more words than there are; the checksum tells.
        at = np.where(needs, np.minimum(place[:, None] + order - 1, len(words) - 1), 0)
        refilled = np.where(needs, moved << _WORD | words[at], moved)
        states = np.where(active, refilled, states)
        place = place + order[:, -1]
    return [tokens[:, k].reshape(-1)[:n] for k, n in enumerate(sizes)]
