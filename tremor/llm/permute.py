"""A pseudorandom permutation of 0 .. n - 1 that is computed, not stored.

A Feistel network over pairs ``(left, right)`` permutes the smallest rectangle ``a * b >= n`` with
``a = ceil(sqrt(n))``; a value that falls outside 0 .. n - 1 is permuted again until it is inside
(cycle walking), which keeps the whole a permutation of 0 .. n - 1. The rectangle exceeds n by
less than ``2 * sqrt(n)``, so almost no value needs a second walk. All is vectorised over arrays.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

ROUNDS = 6
# The multipliers and shifts of the SplitMix64 finalizer.
_MIX = ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB))
_GOLDEN = 0x9E3779B97F4A7C15


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit mix of each unsigned value."""
    for shift, factor in _MIX:
        values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
    return values ^ (values >> np.uint64(31))


def _sides(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a = np.array([isqrt(int(k) - 1) + 1 for k in n], np.uint64)
    return a, (n + a - np.uint64(1)) // a


def _key(seed: np.ndarray, turn: int) -> np.ndarray:
    return mixed(seed + np.uint64((_GOLDEN * (turn + 1)) % 2**64))


def _walk(at: np.ndarray, n: np.ndarray, seed: np.ndarray, step) -> np.ndarray:
    sizes, which = np.unique(n, return_inverse=True)
    a, b = (side[which] for side in _sides(sizes))
    out = step(at, a, b, seed)
    while (outside := np.flatnonzero(out >= n)).size:
        out[outside] = step(out[outside], a[outside], b[outside], seed[outside])
    return out


def _forward(at, a, b, seed):
    left, right = at // b, at % b
    for turn in range(ROUNDS):
        if turn % 2 == 0:
            left = (left + mixed(right ^ _key(seed, turn)) % a) % a
        else:
            right = (right + mixed(left ^ _key(seed, turn)) % b) % b
    return left * b + right


def _backward(at, a, b, seed):
    left, right = at // b, at % b
    for turn in reversed(range(ROUNDS)):
        if turn % 2 == 0:
            left = (left + a - mixed(right ^ _key(seed, turn)) % a) % a
        else:
            right = (right + b - mixed(left ^ _key(seed, turn)) % b) % b
    return left * b + right


def _arrays(at, n, seed) -> list[np.ndarray]:
    at = np.asarray(at).astype(np.uint64)
    return [at, *(np.broadcast_to(np.asarray(x).astype(np.uint64), at.shape) for x in (n, seed))]


def permuted(at, n, seed) -> np.ndarray:
    """Where each ``at`` in 0 .. n - 1 goes. ``n`` and ``seed`` may differ by element."""
    at, n, seed = _arrays(at, n, seed)
    return _walk(at, n, seed, _forward).astype(np.int64) if at.size else at.astype(np.int64)


def restored(to, n, seed) -> np.ndarray:
    """The inverse of :func:`permuted`."""
    to, n, seed = _arrays(to, n, seed)
    return _walk(to, n, seed, _backward).astype(np.int64) if to.size else to.astype(np.int64)
