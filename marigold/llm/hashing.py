"""Hashes of words and of runs of words, for a whole text at once with numpy.

Polynomial (Rabin-Karp) hashes modulo 2**64: with prefix sums of ``value * base**place``, the hash of any run is a
difference times an inverse power, whatever its length. A final mix spreads what is left in the low bits.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(20240229).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
LETTER_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95


@lru_cache(maxsize=4)
def _powers(base: int, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        row = np.full(room, b, dtype=np.uint64)
        row[0] = 1
        out.append(np.cumprod(row, dtype=np.uint64))
    return out[0], out[1]


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(base, 1 << max(16, (n + 1).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that lets every bit of the input reach every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: bytes, lower: bool = False) -> np.ndarray:
    """One hash per word of an UTF-8 text, in order; ``lower`` takes A-Z for a-z."""
    letters = np.frombuffer(raw, dtype=np.uint8)
    if not len(letters):
        return np.zeros(0, np.uint64)
    white = WHITE[letters]
    edges = np.flatnonzero(white[1:] != white[:-1]) + 1
    if not white[0]:
        edges = np.concatenate([[0], edges])
    if not white[-1]:
        edges = np.concatenate([edges, [len(letters)]])
    starts, ends = edges[0::2], edges[1::2]
    up, down = powers(LETTER_BASE, len(letters))
    sums = np.zeros(len(letters) + 1, dtype=np.uint64)
    np.cumsum((_LOWER if lower else _BYTES)[letters] * up[: len(letters)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """The hash of every run of ``length`` words; none if there are fewer."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(WORD_BASE, len(words))
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[length:] - sums[:n]) * down[:n] + np.uint64(length))
