"""Hashes of word shingles and one-permutation MinHash signatures, over many texts at once.

Words are what lies between ASCII white space, with A-Z in lower case; a shingle is a run of words with one blank between
two. Its 64-bit hash comes from prefix sums of a polynomial over a table of random byte values, so no shingle is ever
built as a string.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(0x5EED)
BYTE_VALUES = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FACTOR = 0x9E3779B97F4A7C15 | 5  # odd, so that it can be inverted modulo 2^64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def powers(factor: int, n: int) -> np.ndarray:
    """``factor ** 0 .. factor ** n`` modulo 2^64."""
    out = np.full(n + 1, factor, np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(text: bytes, words: int, power: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Distinct hashes, sorted, of the ``words``-word shingles; of the whole sequence where there are fewer words.

    ``power`` and ``inverse`` are the powers of ``FACTOR`` and of its inverse, as long as the text at least.
    """
    raw = _LOWER[np.frombuffer(text, np.uint8)]
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if raw.size and not space[0]:
        edge = np.concatenate([[0], edge])
    if raw.size and not space[-1]:
        edge = np.concatenate([edge, [raw.size]])
    starts, ends = edge[0::2], edge[1::2]
    count = len(starts)
    if not count:
        return np.empty(0, np.uint64)
    if ((starts[1:] - ends[:-1]) != 1).any() or space.any() and (raw[space] != 32).any():
        raw = raw.copy()
        raw[space] = 32
        keep = ~space
        keep[ends[:-1]] = True
        raw = raw[keep]
        lengths = ends - starts
        starts = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
        ends = starts + lengths
    sums = np.empty(raw.size + 1, np.uint64)
    sums[0] = 0
    np.cumsum(BYTE_VALUES[raw] * power[: raw.size], out=sums[1:])
    span = min(words, count)
    first, last = starts[: count - span + 1], ends[span - 1 :]
    found = mixed((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
    return np.unique(found)


class Shingler:
    """``shingle_hashes`` with the powers kept for the longest text so far."""

    def __init__(self, words: int):
        self.words = words
        self.power = self.inverse = np.empty(0, np.uint64)

    def __call__(self, text: bytes) -> np.ndarray:
        if len(text) >= len(self.power):
            size = max(1 << 16, 2 * len(text))
            self.power, self.inverse = powers(FACTOR, size), powers(pow(FACTOR, -1, 1 << 64), size)
        return shingle_hashes(text, self.words, self.power, self.inverse)


class OnePermutation:
    """One-permutation MinHash with optimal densification.

    The hash range is cut into ``bins``; each keeps its smallest value. An empty bin borrows from the first full bin in
    a random sequence of its own, which is the same for all sets, so that bins agree with the probability of the
    Jaccard similarity.
    """

    def __init__(self, bins: int, tries: int = 64):
        self.bins = bins
        self.shift = np.uint64(64 - (bins - 1).bit_length())
        if bins & (bins - 1):
            raise ValueError("bins must be a power of two")
        self.lenders = np.random.default_rng(bins).integers(0, bins, (tries, bins))
        self.order = np.random.default_rng(bins + 1).permutation(bins)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """``bins`` 64-bit values of a set that is not empty; ``hashes`` is sorted."""
        bin_of = (hashes >> self.shift).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bin_of[1:] != bin_of[:-1]]))
        out = np.zeros(self.bins, np.uint64)
        full = np.zeros(self.bins, bool)
        out[bin_of[first]], full[bin_of[first]] = hashes[first], True
        empty = np.flatnonzero(~full)
        waiting = empty
        lent = out.copy()
        for row in self.lenders:
            if not waiting.size:
                break
            lender = row[waiting]
            got = full[lender]
            lent[waiting[got]] = out[lender[got]]
            waiting = waiting[~got]
        if waiting.size:  # none of its sequence is full: the full bin that comes first in a fixed order
            best = bin_of[first][np.argmin(self.order[bin_of[first]])]
            lent[waiting] = out[best]
        # a borrowed value must differ from the lender's own, or two bins of a band would always agree together
        return mixed(lent + np.arange(self.bins, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
