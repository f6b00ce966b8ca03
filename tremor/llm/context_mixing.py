"""Bits of a text under an online logistic mix of context bit predictors.

The text's words, ASCII letters in lower case, each closed by a blank, and a line end after the last. Every
byte is coded as a walk down a Huffman tree of the training bytes, so it takes about four binary
decisions. Three predictors give the log-odds of a decision:

* the *word* so far: how often training words with this beginning went on either way;
* the *pair* of the last two bytes of the word: how often the training bytes after them did;
* the *match* within the document: where the two words before (else the one) were last, the word that followed
  there is expected again, with certainty until the first decision in which it is wrong.

The first two look up counts of all training text by their whole context, which no other shares. A mixer adds
the three with weights; the gate that picks the weights says how often the word's context was met, whether the
decision is a byte's first, and what kind of match there is. The first two weights begin where they fit the training
words best, each counted as if one of its occurrences had been left out. While a document is scored, the weights
in use move along the gradient of its cost after every ``BLOCK`` decisions, from its beginning to its end. Documents
are independent, so many are scored side by side as lanes of arrays.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

END = b"\n"
#: Bytes of a word beyond which no counts are kept of what follows; the pair and the match go on.
DEPTH = 48
#: Steps of the predictors' log-odds, and how many there are to either side.
WORD_STEP, WORD_LEVELS = 0.25, 31
PAIR_STEP, PAIR_LEVELS = 0.5, 15
SMOOTHING = 0.04
#: Upper ends of the first classes of how often a context was met.
SURE = (0, 4, 64)
#: Log-odds of a match, by whether one or two words before agree, in units of its weight.
MATCHES = (0, 1, 3)
GATES = 4 * 2 * len(MATCHES)
#: Weights of the predictors before fitting; the match keeps its own until a document moves it.
FLAT = (0.5, 0.5, 0.7)
HOLD = 4.0
BLOCK, RATE, MOST_STEP, MOST_WEIGHT = 256, 0.02, 0.25, 8.0
MOST_ODDS = 20.0
#: Documents scored side by side have about this many decisions together, and there are so many of them at most.
BATCH, LANES = 1 << 24, 256
#: Numbers that ``decision_codes`` gives.
CODES = 1 << 14
_PREFIX = 16
#: The code, as bytes, of a decision of which neither the word nor the pair knows anything.
_NOTHING = (WORD_LEVELS | PAIR_LEVELS << 8).to_bytes(2, "little")
#: Words whose decisions are worked out at a time.
SLICE = 1 << 14


@dataclass(frozen=True)
class Alphabet:
    """Huffman codes of all 256 bytes; those never seen in training have long ones."""

    place_of: np.ndarray  # of each byte among the leaves from left to right
    spans: np.ndarray  # [node]: first leaf, first leaf of the right half, leaf after the last
    starts: np.ndarray  # of each byte's decisions in the two arrays below
    nodes: np.ndarray
    signs: np.ndarray  # 1 for the right half, -1 for the left
    agreement: np.ndarray  # [a, b]: decisions that two bytes' codes share from the start

    @staticmethod
    def of(byte_counts: np.ndarray) -> Alphabet:
        weights = (byte_counts + 1).tolist()
        heap: list = [(w, k, k) for k, w in enumerate(weights)]
        heapq.heapify(heap)
        serial = len(heap)
        while len(heap) > 1:
            (a, _, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (a + b, serial, (left, right)))
            serial += 1
        place = np.zeros(256, np.int64)
        spans: list[tuple[int, int, int]] = []
        codes: list[list[tuple[int, int]]] = [[] for _ in weights]
        leaf = 0

        def walk(tree, path: list[tuple[int, int]]) -> None:
            nonlocal leaf
            if isinstance(tree, int):
                codes[tree], place[tree], leaf = path, leaf, leaf + 1
                return
            node, first = len(spans), leaf
            spans.append((0, 0, 0))
            walk(tree[0], [*path, (node, 0)])
            middle = leaf
            walk(tree[1], [*path, (node, 1)])
            spans[node] = (first, middle, leaf)

        walk(heap[0][2], [])
        flat = [step for code in codes for step in code]
        longest = max(map(len, codes))
        steps = np.array([[2 * n + b for n, b in c] + [-1] * (longest - len(c)) for c in codes])
        # No two codes are the same, and none begins another.
        agreement = np.stack([(own != steps).argmax(axis=1) for own in steps])
        return Alphabet(
            place,
            np.array(spans, np.int64),
            np.cumsum([0] + [len(c) for c in codes]),
            np.array([n for n, _ in flat], np.int64),
            np.array([2 * b - 1 for _, b in flat], np.int64),
            agreement,
        )


@dataclass(frozen=True)
class Spelled:
    """Words as coded: their bytes one after another, each closed by a blank (the end stands alone)."""

    raw: np.ndarray
    begins: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def of(words: list[bytes]) -> Spelled:
        closed = [word if word == END else word + b" " for word in words]
        sizes = np.fromiter(map(len, closed), np.int64, len(closed))
        return Spelled(np.frombuffer(b"".join(closed), np.uint8), np.cumsum(sizes) - sizes, sizes)

    def some(self, first: int, last: int) -> Spelled:
        """The words from one to before another."""
        begins, sizes = self.begins[first:last], self.sizes[first:last]
        return Spelled(self.raw[begins[0] : begins[-1] + sizes[-1]], begins - begins[0], sizes)

    def pairs(self) -> np.ndarray:
        """The two bytes before each, blanks before a word's beginning, as one number."""
        wide = np.concatenate([np.full(2, 32, np.int64), self.raw])
        last, before = wide[1:-1].copy(), wide[:-2].copy()
        last[self.begins] = before[self.begins] = 32
        before[(self.begins + 1)[self.sizes > 1]] = 32
        return before << 8 | last


def ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``begins[0], begins[0] + 1, ...``, ``sizes[0]`` of them, then those of the next, and so on."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - sizes), sizes)


def pair_counts(words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``pair << 8 | byte`` and how often the byte follows the pair in the words, each as often as counted."""
    spelled = Spelled.of(words)
    keys, index = np.unique(spelled.pairs() << 8 | spelled.raw, return_inverse=True)
    return keys, np.bincount(index, np.repeat(counts, spelled.sizes), len(keys)).astype(np.int64)


def _odds(right: np.ndarray, wrong: np.ndarray, step: float, most: int) -> np.ndarray:
    levels = np.rint(np.log((right + SMOOTHING) / (wrong + SMOOTHING)) / step)
    return np.clip(levels, -most, most).astype(np.int64)


@dataclass(frozen=True)
class Pairs:
    """Levels of the pair predictor: ``levels[row_of[pair], node]``. At most a row for each of 65,536 pairs."""

    row_of: np.ndarray
    levels: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, counts: np.ndarray, alphabet: Alphabet) -> Pairs:
        met = np.unique(keys >> 8)
        row_of = np.zeros(1 << 16, np.int32)
        row_of[met] = np.arange(1, len(met) + 1)
        by_leaf = np.zeros((len(met) + 1, 257), np.int64)
        np.add.at(by_leaf, (row_of[keys >> 8], alphabet.place_of[keys & 255] + 1), counts)
        np.cumsum(by_leaf, axis=1, out=by_leaf)
        first, middle, end = alphabet.spans.T
        ones, zeros = by_leaf[:, end] - by_leaf[:, middle], by_leaf[:, middle] - by_leaf[:, first]
        return Pairs(row_of, _odds(ones, zeros, PAIR_STEP, PAIR_LEVELS).astype(np.int8))


#: For a word's beginning that several tasks hold words of: how often each byte follows it in all of them.
Shared = dict[bytes, dict[int, int]]


def _matrix(spelled: Spelled, width: int) -> np.ndarray:
    """The words' first bytes as rows, zeros after their ends."""
    column = np.arange(width)
    inside = column < spelled.sizes[:, None]
    return np.where(inside, spelled.raw[np.where(inside, spelled.begins[:, None] + column, 0)], 0).astype(np.uint8)


def border_counts(words: list[bytes], counts: np.ndarray) -> Iterator[tuple[bytes, int, int]]:
    """``(beginning, byte, n)`` for all beginnings of the first and the last of some sorted words."""
    closed = [word if word == END else word + b" " for word in words]
    done = set()
    for edge in (closed[0], closed[-1]):
        for depth in range(min(DEPTH, len(edge))):
            beginning = edge[:depth]
            if beginning in done:
                continue
            done.add(beginning)
            # The words that begin so stand together.
            low = bisect_left(closed, beginning)
            high = bisect_left(closed, beginning + b"\xff") if depth else len(closed)
            sums: dict[int, int] = {}
            for word, n in zip(closed[low:high], counts[low:high].tolist(), strict=True):
                sums[word[depth]] = sums.get(word[depth], 0) + n
            yield from ((beginning, byte, n) for byte, n in sums.items())


def word_bytes(words: list[bytes], counts: np.ndarray, alphabet: Alphabet, shared: Shared) -> tuple[np.ndarray, np.ndarray]:
    """The word predictor along each of some sorted words: a byte for every decision, with its level in the lower six
    bits (above 31: right) and the class of its context's count in the upper two. The second array is
    the same with one occurrence of the word left out."""
    spelled = Spelled.of(words)
    matrix = _matrix(spelled, DEPTH)
    lengths = np.minimum(spelled.sizes, DEPTH)
    differs = matrix[1:] != matrix[:-1]
    common = np.concatenate([[-1], np.where(differs.any(axis=1), differs.argmax(axis=1), DEPTH)])
    steps = np.diff(alphabet.starts)
    total = np.cumsum(steps[spelled.raw])
    cursor = total[spelled.begins] - steps[spelled.raw[spelled.begins]]
    whole = np.full(total[-1], WORD_LEVELS, np.uint8)
    without = whole.copy()
    width = 257
    for depth in range(DEPTH):
        rows = np.flatnonzero(lengths > depth)
        if not len(rows):
            break
        fresh = common[rows] <= depth
        edge = np.cumsum(fresh) - 1
        heads = rows[fresh]
        met = np.add.reduceat(counts[rows], np.flatnonzero(fresh))
        group = (np.cumsum(common[rows] < depth) - 1)[fresh]
        symbol = matrix[heads, depth]
        branching = np.bincount(group) > 1
        keys, sums = group * width + alphabet.place_of[symbol], met
        for place in {0, len(heads) - 1}:
            known = shared.get(matrix[heads[place], :depth].tobytes())
            if known is not None:
                branching[group[place]] = True
                bytes_ = np.array(list(known), np.int64)
                there = group[place] * width + alphabet.place_of[bytes_]
                mine = keys // width == group[place]
                keys, sums = np.concatenate([keys[~mine], there]), np.concatenate([sums[~mine], list(known.values())])
        order = np.argsort(keys, kind="stable")
        keys, sums = keys[order], np.concatenate([[0], np.cumsum(sums[order])])
        size = steps[symbol]
        begin = np.cumsum(size) - size
        # Where all words of a group go on alike, and no other range has any, nothing speaks against their byte.
        some = np.flatnonzero(branching[group])
        level, less = (np.repeat(_packed(n, np.zeros_like(n)), size) for n in (met, np.maximum(met - 1, 0)))
        decision = ranges(alphabet.starts[symbol[some]], size[some])
        spread = np.repeat(group[some] * width, size[some])
        first, middle, end = (sums[np.searchsorted(keys, spread + span)] for span in alphabet.spans[alphabet.nodes[decision]].T)
        ones, zeros = end - middle, middle - first
        hit = alphabet.signs[decision] > 0
        right, wrong = np.where(hit, ones, zeros), np.where(hit, zeros, ones)
        place = ranges(begin[some], size[some])
        level[place], less[place] = _packed(right, wrong), _packed(np.maximum(right - 1, 0), wrong)
        own = size[edge]
        source = ranges(begin[edge], own)
        target = ranges(cursor[rows], own)
        whole[target], without[target] = level[source], less[source]
        cursor[rows] += own
    return whole, without


def _packed(right: np.ndarray, wrong: np.ndarray) -> np.ndarray:
    level = _odds(right, wrong, WORD_STEP, WORD_LEVELS) + WORD_LEVELS
    return (level | np.searchsorted(SURE, right + wrong) << 6).astype(np.uint8)


def decision_codes(spelled: Spelled, word_levels: np.ndarray, alphabet: Alphabet, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """A number for every decision of the words that tells its two levels and its gate but for the match, and
    where each word's decisions end."""
    size = np.diff(alphabet.starts)[spelled.raw]
    decision = ranges(alphabet.starts[spelled.raw], size)
    row = np.repeat(pairs.row_of[spelled.pairs()] * np.int32(pairs.levels.shape[1]), size)
    level = pairs.levels.ravel()[row + alphabet.nodes.astype(np.int32)[decision]]
    level = level * alphabet.signs.astype(np.int8)[decision] + np.int8(PAIR_LEVELS)
    ends = np.cumsum(size)
    codes = level.astype(np.uint16)
    codes <<= 8
    codes |= word_levels
    codes[ends - size] |= np.uint16(1 << 13)
    return codes, ends[spelled.begins + spelled.sizes - 1]


def level_ends(spelled: Spelled, alphabet: Alphabet) -> np.ndarray:
    """Where each word's decisions end if they lie one word after another."""
    return np.cumsum(np.diff(alphabet.starts)[spelled.raw])[spelled.begins + spelled.sizes - 1]


def codes_in_slices(
    spelled: Spelled, word_levels: np.ndarray, alphabet: Alphabet, pairs: Pairs
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``decision_codes`` of some thousand words at a time, with the first of them and the one after the last."""
    words = len(spelled.sizes)
    ends = np.concatenate([[0], level_ends(spelled, alphabet)])
    for first in range(0, words, SLICE):
        last = min(first + SLICE, words)
        yield first, last, *decision_codes(spelled.some(first, last), word_levels[ends[first] : ends[last]], alphabet, pairs)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each code: log-odds of word and pair, and the gate without a match."""
    code = np.arange(CODES)
    word = ((code & 63) - WORD_LEVELS) * WORD_STEP
    pair = ((code >> 8 & 31) - PAIR_LEVELS) * PAIR_STEP
    return word.astype(np.float32), pair.astype(np.float32), ((code >> 6 & 3) * 2 + (code >> 13)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    alphabet: Alphabet
    pairs: Pairs
    weights: np.ndarray  # [gate, predictor]


def fitted(code_counts: np.ndarray) -> np.ndarray:
    """The weights ``[gate, predictor]`` at the least cost of the decisions counted by their codes.

    Newton steps of all gates at once, held to the beginning a little; a gate's step is halved until its cost
    falls, and where it does not fall, the gate is done.
    """
    word, pair, gate = _tables()
    used = np.flatnonzero(code_counts)
    x = np.stack([word[used], pair[used]], axis=1).astype(float)
    n, gate = code_counts[used].astype(float), gate[used]
    gates = GATES // len(MATCHES)
    flat = np.tile(FLAT[:2], (gates, 1))
    weights = flat.copy()

    def cost(trial: np.ndarray) -> np.ndarray:
        z = np.clip((x * trial[gate]).sum(axis=1), -MOST_ODDS, MOST_ODDS)
        held = HOLD * ((trial - flat) ** 2).sum(axis=1) / 2
        return np.bincount(gate, n * np.logaddexp(0, -z), gates) + held

    now = cost(weights)
    for _ in range(50):
        z = np.clip((x * weights[gate]).sum(axis=1), -MOST_ODDS, MOST_ODDS)
        miss = 1 / (1 + np.exp(z))
        bend = n * miss * (1 - miss)
        slope = np.stack([np.bincount(gate, n * miss * x[:, k], gates) for k in (0, 1)], axis=1) - HOLD * (weights - flat)
        curve = np.stack(
            [np.stack([np.bincount(gate, bend * x[:, a] * x[:, b], gates) for b in (0, 1)], axis=1) for a in (0, 1)], axis=1
        )
        move = np.linalg.solve(curve + HOLD * np.eye(2), slope[:, :, None])[:, :, 0]
        share = np.ones(gates)
        for _ in range(30):
            trial = np.clip(weights + share[:, None] * move, -MOST_WEIGHT, MOST_WEIGHT)
            after = cost(trial)
            worse = after > now
            if not worse.any():
                break
            share[worse] /= 2
        better = after < now
        gained = (now - after)[better].sum()
        weights[better], now[better] = trial[better], after[better]
        if gained <= 1e-9 * max(now.sum(), 1):
            break
    whole = np.concatenate([weights, np.full((gates, 1), FLAT[2])], axis=1)
    return np.tile(whole, (len(MATCHES), 1)).astype(np.float32)


def _expected(words: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word of the documents (words as numbers from 1, one document after another) the word expected
    there, and by how many of the words before (0: none is expected)."""
    n = len(words)
    last = np.concatenate([[0], words[:-1]])
    last[1:][document[1:] != document[:-1]] = 0
    before = np.concatenate([[0], last[:-1]])
    before[1:][document[1:] != document[:-1]] = 0
    found, kind = np.zeros(n, np.int64), np.zeros(n, np.int64)
    group, values = document, int(words.max(initial=0)) + 1
    for number, context in ((1, last), (2, before)):
        key = group * values + context
        order = _order(key)
        again = key[order][1:] == key[order][:-1]
        at, source = order[1:][again], order[:-1][again]
        found[at], kind[at] = words[source], number
        # Words of a document after the same word are a group of the next round.
        group = np.zeros(n, np.int64)
        group[order[1:]] = np.cumsum(~again)
    return found, kind


def _order(key: np.ndarray) -> np.ndarray:
    """The stable order of numbers from 0 on. Sorting them with their places is several times as fast, if there is room."""
    bits = len(key).bit_length()
    if int(key.max(initial=0)).bit_length() + bits > 63:
        return np.argsort(key, kind="stable")
    return np.sort(key << bits | np.arange(len(key))) & ((1 << bits) - 1)


class Scorer:
    """Scores documents made of known words: ``words`` with their ``word_bytes``."""

    def __init__(self, words: list[bytes], word_levels: np.ndarray, model: Model):
        alphabet = model.alphabet
        self._weights = model.weights
        self._pieces: list[bytes] = []
        sizes = []
        spelled = Spelled.of(words)
        for _, _, codes, ends in codes_in_slices(spelled, word_levels, alphabet, model.pairs):
            raw, bounds = codes.tobytes(), [0, *ends.tolist()]
            self._pieces += [raw[2 * a : 2 * b] for a, b in zip(bounds, bounds[1:], strict=False)]
            sizes.append(np.diff(ends, prepend=0))
        self._sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        self._spelled, self._steps = spelled, np.diff(alphabet.starts)
        self._matrix = _matrix(spelled, _PREFIX)
        self._through = np.zeros((len(words), _PREFIX + 1), np.int16)
        np.cumsum(self._steps.astype(np.int16)[self._matrix], axis=1, out=self._through[:, 1:])
        self._agreement = alphabet.agreement

    def bits(self, documents: list[np.ndarray]) -> np.ndarray:
        """Bits of each document, given as its words' numbers, the end's last."""
        result = np.zeros(len(documents))
        lengths = np.array([self._sizes[d].sum() for d in documents], np.int64)
        order = np.argsort(-lengths, kind="stable")
        at = 0
        while at < len(order):
            # Documents of like length, so that few lanes idle.
            last = at + max(1, int(np.searchsorted(np.cumsum(lengths[order[at : at + LANES]]), BATCH, "right")))
            own = order[at:last]
            result[own] = self._batch([documents[k] for k in own], lengths[own])
            at = last
        return result

    def _batch(self, documents: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
        words = np.concatenate(documents)
        counts = np.array([len(d) for d in documents])
        lane = np.repeat(np.arange(len(documents)), counts)
        # Lanes are filled up to whole blocks by decisions of which nothing is known.
        spare = -lengths % BLOCK
        pieces, parts = self._pieces, []
        for document, more in zip(documents, spare.tolist(), strict=True):
            parts += map(pieces.__getitem__, document.tolist())
            parts.append(_NOTHING * more)
        codes = np.frombuffer(b"".join(parts), np.uint16)
        sizes = self._sizes[words]
        ends = np.cumsum(counts) - 1
        padded = sizes.copy()
        padded[ends] += spare
        match = self._matched(words, lane, sizes, np.cumsum(padded) - padded, len(codes))
        return _cost(codes, match, lengths, self._weights) / np.log(2)

    def _matched(self, words: np.ndarray, lane: np.ndarray, size: np.ndarray, begin: np.ndarray, total: int) -> np.ndarray:
        """What the match says of each decision (a word's ``size`` from ``begin`` on): 0, or its strength, negative
        where it is wrong."""
        expected, kind = _expected(words + 1, lane)
        at = np.flatnonzero(kind)
        mine, other, strength = words[at], expected[at] - 1, np.array(MATCHES, np.int8)[kind[at]]
        begin, size = begin[at], size[at]
        shared = self._shared(mine, other, size)
        wrong = shared < size
        delta = np.zeros(total + 1, np.int8)
        delta[begin] += strength  # each word begins at a place of its own
        np.subtract.at(delta, begin + shared, strength)
        match = np.cumsum(delta[:-1], dtype=np.int8)
        match[(begin + shared)[wrong]] = -strength[wrong]
        return match

    def _shared(self, mine: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
        """How many decisions of the one words' codes, ``size`` in all, the other words' codes begin with, too."""
        shared = size.copy()
        unlike = np.flatnonzero(mine != other)
        a, b = mine[unlike], other[unlike]
        differs = self._matrix[a] != self._matrix[b]
        place = differs.argmax(axis=1)
        agree = self._agreement[self._matrix[a, place], self._matrix[b, place]]
        shared[unlike] = self._through[a, place] + agree
        for k in np.flatnonzero(~differs.any(axis=1)).tolist():
            shared[unlike[k]] = self._shared_by_long(int(a[k]), int(b[k]))
        return shared

    def _shared_by_long(self, a: int, b: int) -> int:
        begins, sizes = self._spelled.begins, self._spelled.sizes
        one, two = (self._spelled.raw[begins[w] : begins[w] + sizes[w]] for w in (a, b))
        n = min(len(one), len(two))
        at = np.flatnonzero(one[:n] != two[:n])[0]
        return int(self._steps[one[:at]].sum() + self._agreement[one[at], two[at]])


def _cost(codes: np.ndarray, match: np.ndarray, lengths: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Nats of each lane; the lanes lie one after another, each filled up to whole blocks, the longest first."""
    lanes = len(lengths)
    counts = -(-lengths // BLOCK)
    # First the first blocks of all lanes, then the second ones of those that have any, and so on.
    order = np.argsort(ranges(np.zeros(lanes, np.int64), counts), kind="stable")
    codes, match = (v.reshape(-1, BLOCK)[order] for v in (codes, match))
    word_of, pair_of, gate_of = _tables()
    gate_of = gate_of.astype(np.uint8)
    of_lane = GATES * np.arange(lanes)[:, None]
    moving = [np.tile(w, lanes) for w in weights.T.astype(np.float32)]
    # Every step works in the same few arrays, which stay in the processor's cache.
    places = [np.empty((lanes, BLOCK), np.intp) for _ in range(2)]
    gates = np.empty((lanes, BLOCK), np.uint8)
    levels = [np.empty((lanes, BLOCK), np.float32) for _ in range(6)]
    # The spare decisions are even odds, which is taken off again.
    cost = -(counts * BLOCK - lengths) * np.log(2)
    active, first = -np.sort(-counts), 0
    for step in range(int(active[0]) if lanes else 0):
        n = int(np.searchsorted(-active, -step, "left"))
        own = slice(first, first + n)
        first += n
        at, code = (v[:n] for v in places)
        gate = gates[:n]
        *inputs, z, one, miss = (v[:n] for v in levels)
        code[:] = codes[own]
        # All places lie within their tables; "wrap" is the fastest mode.
        word_of.take(code, out=inputs[0], mode="wrap")
        pair_of.take(code, out=inputs[1], mode="wrap")
        inputs[2][:] = match[own]
        gate_of.take(code, out=gate, mode="wrap")
        strength = np.abs(match[own])
        for kind in MATCHES[1:]:
            gate += (strength >= kind).view(np.uint8) * np.uint8(GATES // len(MATCHES))
        np.add(gate, of_lane[:n], out=at)
        np.multiply(inputs[0], moving[0].take(at, out=one, mode="wrap"), out=z)
        for x, w in zip(inputs[1:], moving[1:], strict=True):
            z += np.multiply(x, w.take(at, out=one, mode="wrap"), out=one)
        odds = np.exp(z.clip(-MOST_ODDS, MOST_ODDS, out=z), out=z)
        np.divide(1, np.add(odds, 1, out=miss), out=miss)
        # Logarithms are taken of the products of eight.
        chance = np.multiply(odds, miss, out=one)
        product = chance[:, : BLOCK // 2].astype(np.float64)
        product *= chance[:, BLOCK // 2 :]
        for half in (BLOCK // 4, BLOCK // 8):
            product = product[:, :half] * product[:, half:]
        cost[:n] -= np.log(product).sum(axis=1)
        flat = at.ravel()
        for x, w in zip(inputs, moving, strict=True):
            pull = np.bincount(flat, np.multiply(miss, x, out=z).ravel(), n * GATES)
            pull *= RATE
            w = w[: n * GATES]
            w += pull.clip(-MOST_STEP, MOST_STEP, out=pull)
            w.clip(-MOST_WEIGHT, MOST_WEIGHT, out=w)
    return cost
