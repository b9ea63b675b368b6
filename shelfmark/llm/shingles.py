"""Hashes of words and of word shingles, for many texts at once."""

from __future__ import annotations

import numpy as np

from shelfmark.llm.common import BASE, U64, mix

BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
STEP = U64(0xD6E8FEB86659FD93)
BACK = U64(pow(int(STEP), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, with A-Z in lower case, and n + 1 offsets into them.

    A word's hash is a polynomial in its bytes, cut out of running sums over all of them.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    solid = ~IS_SPACE[data]
    starts = solid.copy()
    starts[1:] &= ~solid[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[firsts] |= solid[firsts]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    lasts = firsts[1:] - 1
    ends[lasts] |= solid[lasts]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[LOWER[data]] * powers(STEP, len(data)), dtype=np.uint64)))
    hashes = mix((sums[end] - sums[begin]) * powers(BACK, len(data))[begin] + (end - begin).astype(np.uint64))
    return hashes, np.searchsorted(begin, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: runs of `size` words, or all words where there are fewer."""
    words, at = word_hashes(data, offsets)
    runs = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        runs = (runs ^ words[k : len(words) - size + 1 + k]) * BASE + U64(k + 1)
    runs = mix(runs)
    out = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
        if hi - lo >= size:
            out.append(np.unique(runs[lo : hi - size + 1]))
        elif hi > lo:
            h = np.array([hi - lo], np.uint64)
            for k in range(lo, hi):
                h = (h ^ words[k]) * BASE + U64(77)
            out.append(mix(h))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
