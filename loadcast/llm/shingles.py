"""Sets of word shingles as sorted 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

from .common import mixed

WORDS = 5
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
# A random number per byte, of A-Z that of a-z.
_VALUE = mixed(_LOWER.astype(np.uint64) + np.uint64(0x51ED2701))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(256)
_PLACES = _powers(16)


def word_hashes(text: str) -> np.ndarray:
    """A hash per word, A-Z lower-cased, of the whole text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    solid = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    firsts = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(firsts, sizes)
    powers = _POWERS if sizes.max() <= len(_POWERS) else _powers(int(sizes.max()))
    return mixed(np.add.reduceat(_VALUE[raw[solid]] * powers[place], firsts))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes; with fewer words than a shingle, one for the whole sequence; none without words."""
    w = word_hashes(text or "")
    if not len(w):
        return w
    k = min(words, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for j in range(k):
        h += w[j : len(w) - k + 1 + j] * _PLACES[j + 1]
    return np.unique(mixed(h))
