"""Words of whole texts, found and hashed with numpy.

A word is a longest run of bytes other than space and U+0009 to U+000D. In UTF-8 those
bytes never occur inside another character, so bytes give the same words as code points.
"""

import numpy as np

_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_VALUE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits (the finalizer of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_spans(
    data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _GAP
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and per text the number of words before it.

    ``offsets`` says where each text begins, its last entry where the last one ends; a word
    ends with its text. ``gap`` says of each byte whether it is between words.
    """
    inside = ~gap[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    begins, ends = offsets[:-1][filled], offsets[1:][filled] - 1
    first[begins], last[ends] = inside[begins], inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, base, np.uint64)
    if count:
        powers[0] = 1
    return np.multiply.accumulate(powers)


def span_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False
) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, from prefix sums modulo 2**64."""
    values = _VALUE[_LOWER[data] if lower else data]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, len(data)), out=sums[1:])
    own = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(data) + 1)[starts]
    return mixed(own + (ends - starts).astype(np.uint64))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` word hashes; there are ``size - 1`` fewer than words."""
    count = max(0, len(hashes) - size + 1)
    grams = np.full(count, size, np.uint64)
    for k in range(size):
        grams = mixed(grams * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + count])
    return grams
