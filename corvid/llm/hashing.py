"""Vectorised hashes of words and n-grams over UTF-8 buffers (numpy, inside tasks).

Words are hashed block by block and runs of a fixed number of words by doubling,
with a mixing step between any two parts.  :class:`Stretches` hashes stretches of
any length by polynomials modulo 2^64 from prefix sums: it serves as a filter (where
to look, what to merge), never as the last word on whether two words are equal.
The constants are fixed: every task, executor and run hashes alike.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np

_U = np.uint64
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240501)
BYTE_VALUE = _rng.integers(1, 2**63, size=(2, 256), dtype=np.int64).astype(_U) * _U(2) + _U(1)
BASE = (_U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93))
INVERSE = tuple(_U(pow(int(b), -1, 2**64)) for b in BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (in place on a fresh array)."""
    x = x ^ (x >> _U(32))
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


@lru_cache(maxsize=4)
def _powers(which: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    out = []
    for base in (BASE[which], INVERSE[which]):
        p = np.full(n, base, _U)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i in 0..n (at least)."""
    return _powers(which, max(16, int(n).bit_length()))


class Stretches:
    """Hashes of stretches of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, which: int = 0):
        up, self.down = powers(which, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, _U)
        np.cumsum(values * up[:len(values)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = self.sums[end] - self.sums[start]
        out *= self.down[start]
        return mix(out)


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word of the texts in a buffer, and the first word number per text (n + 1)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    solid = ~BLANK[data]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | cut[1:n]
    last[:-1] &= ~solid[1:] | cut[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, off, "left")


_SEEDS = (_U(0x243F6A8885A308D3), _U(0x13198A2E03707344))
LONG_WORD = 64
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)      # masks of the first k bytes of a block


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hash of every word: its length and its 8-byte blocks, mixed one after the other.

    No polynomial: mixing between the blocks leaves no family of words that collide
    for every base.  Words over ``LONG_WORD`` bytes take blake2b, keyed by ``which``.
    """
    size = end - start
    out = mix(size.astype(_U) * BASE[which] + _SEEDS[which])
    if not len(out):
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    block = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))      # the 8 bytes from every place on
    short = np.flatnonzero(size <= LONG_WORD)
    at = 0
    while len(short):
        left = size[short] - at
        value = block[start[short] + at]
        value &= _FIRST[np.minimum(left, 8)]
        out[short] = mix((out[short] ^ value) * BASE[which] + _SEEDS[which])
        at += 8
        short = short[left > 8]
    for i in np.flatnonzero(size > LONG_WORD):
        word = data[start[i]:end[i]].tobytes()
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, person=b"words%d" % which).digest(), "little")
    return out


def gram_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive values, by doubling: two halves (overlapping at the end) mixed in order."""
    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix(mix(a * BASE[0] + _SEEDS[0]) + b * BASE[1])

    span, out = 1, values
    while 2 * span <= size:
        out = pair(out[:max(0, len(out) - span)], out[span:])
        span *= 2
    if span < size:
        out = pair(out[:max(0, len(out) - (size - span))], out[size - span:])
    return out
