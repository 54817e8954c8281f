"""Hashes of the words of many texts at once, in numpy.

The texts' bytes lie in one array. The hash of a word is the difference of two prefix
sums of a polynomial, scaled back to the word's start, and mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

BLOCK_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] = _LOWER[97:123]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers one to one (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                factors = np.full(n, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins and the last ends. NULL is an empty text."""
    raw = pa.compute.fill_null(texts, "").cast(pa.large_binary())
    if not len(raw):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64, count=len(raw) + 1 + raw.offset)[raw.offset :]
    return np.frombuffer(raw.buffers()[2] or b"", dtype=np.uint8), offsets


def text_blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``BLOCK_BYTES`` together; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, side="right")) - 1)
        yield first, min(last, n)
        first = last


def word_hashes(content: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the texts ``offsets`` mark out, A-Z as lower case, and the number of words of each."""
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    begin, end = int(offsets[0]), int(offsets[-1])
    while begin < end:
        stop = min(begin + 2 * BLOCK_BYTES, end)
        # A longer stretch is cut between words.
        while stop < end and _IS_WORD[content[stop]]:
            stop += 1
        part = content[begin:stop]
        inside = _IS_WORD[part]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        borders = offsets[(offsets > begin) & (offsets < stop)] - begin
        opens[borders] = inside[borders]
        closes = np.zeros(len(part) + 1, dtype=bool)
        closes[1:-1] = inside[:-1] & ~inside[1:]
        closes[-1] = inside[-1]
        closes[borders] |= inside[borders - 1]
        starts, ends = np.flatnonzero(opens), np.flatnonzero(closes)
        up, down = _POWERS.upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_LOWER[part] * up[: len(part)], out=sums[1:])
        hashes.append(mixed((sums[ends] - sums[starts]) * down[starts]))
        places.append(starts + begin)
        begin = stop
    all_places = np.concatenate(places)
    return np.concatenate(hashes), np.diff(np.searchsorted(all_places, offsets))
