"""Simple-8b: unsigned integers in 64-bit words, as many in a word as its widest member allows.

The upper 4 bits of a word select how many values share the other 60 bits. The last selector is the escape: one
value of any width up to 60 bits. Values are packed in blocks of a fixed number; where each block's words begin is
stored beside them, so that blocks can be read alone and are packed and unpacked side by side with numpy.
"""

from __future__ import annotations

import numpy as np

BLOCK = 512
# How many values share a word, from the escape upwards; each gets 60 // count bits.
COUNTS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
BITS = 60 // COUNTS


def _choices(values: np.ndarray) -> np.ndarray:
    """For each place the highest selector whose count of values, from there on, fits its bits."""
    n = len(values)
    width = np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.uint8)
    choice = np.zeros(n, dtype=np.uint8)
    widest, reach = width, 1
    for selector, (count, bits) in enumerate(zip(COUNTS, BITS)):
        for step in range(reach, count):
            widest = np.maximum(widest[:-1] if len(widest) > 1 else widest[:0], width[step : step + len(widest) - 1])
        reach = count
        if not len(widest):
            break
        choice[: len(widest)][widest <= bits] = selector
    return choice


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words, and the first word of each block (with the number of words at the end)."""
    values = values.astype(np.uint64)
    n, choice = len(values), _choices(values)
    starts = np.arange(0, n, BLOCK)
    ends = np.minimum(starts + BLOCK, n)
    most = np.searchsorted(COUNTS, np.arange(BLOCK + 1), side="right") - 1  # highest selector for so many values left
    at, places, owners = starts.copy(), [], []
    blocks = np.arange(len(starts))
    while len(blocks):
        places.append(at)
        owners.append(blocks)
        at = at + COUNTS[np.minimum(choice[at], most[ends[blocks] - at])]
        more = at < ends[blocks]
        at, blocks = at[more], blocks[more]
    if not places:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32)
    owner, place = np.concatenate(owners), np.concatenate(places)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    selectors = np.minimum(choice[place], most[ends[owner] - place])
    words = selectors.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(selectors):
        rows = np.flatnonzero(selectors == selector)
        for k in range(COUNTS[selector]):
            words[rows] |= values[place[rows] + k] << np.uint64(k * BITS[selector])
    offsets = np.searchsorted(owner, np.arange(len(starts) + 1)).astype(np.uint32)
    return words, offsets


def unpack(words: np.ndarray) -> np.ndarray:
    """The values of some words in a row, which may be one block's or all."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    ends = np.cumsum(counts)
    out = np.empty(ends[-1] if len(ends) else 0, dtype=np.uint64)
    for selector in np.unique(selectors):
        rows = np.flatnonzero(selectors == selector)
        first, mask = ends[rows] - counts[rows], np.uint64((1 << int(BITS[selector])) - 1)
        for k in range(COUNTS[selector]):
            out[first + k] = (words[rows] >> np.uint64(k * BITS[selector])) & mask
    return out
