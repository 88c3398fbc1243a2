"""Elias-Fano sequences in flat arrays, for memory-mapped files and whole-array queries."""

from __future__ import annotations

import numpy as np

_BYTE_SELECT = np.full((256, 9), 8, np.uint8)  # place of the k-th one of a byte
for _b in range(256):
    for _k, _at in enumerate(i for i in range(8) if _b >> i & 1):
        _BYTE_SELECT[_b, _k] = _at
#: Words in a block of the upper bits that has one entry in the directory.
BLOCK = 8


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays of a non-decreasing sequence of integers below ``universe``."""
    n = len(values)
    low_bits = max(0, int(np.log2(max(universe, 1) / max(n, 1)))) if n else 0
    values = values.astype(np.uint64)
    upper = (values >> np.uint64(low_bits)).astype(np.int64)
    buckets = (int(universe) >> low_bits) + 1
    size = -(-(n + buckets + 1) // (64 * BLOCK)) * BLOCK
    high = np.zeros(size, np.uint64)
    at = upper + np.arange(n)
    np.bitwise_or.at(high, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    lows = np.zeros((n * low_bits + 63) // 64 + 1, np.uint64)
    if low_bits:
        low = values & np.uint64((1 << low_bits) - 1)
        bit = np.arange(n, dtype=np.int64) * low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        np.bitwise_or.at(lows, word, low << shift)
        over = shift + np.uint64(low_bits) > 64
        np.bitwise_or.at(lows, word[over] + 1, low[over] >> (np.uint64(64) - shift[over]))
    zeros = 64 * BLOCK - np.bitwise_count(high.reshape(-1, BLOCK)).sum(axis=1, dtype=np.int64)
    return {"meta": np.array([n, low_bits, buckets], np.int64), "high": high, "lows": lows, "zeros": np.concatenate([[0], np.cumsum(zeros)]).astype(np.int64)}


class Sequence:
    """Queries on encoded arrays (which may be memory maps)."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.low_bits, self.buckets = (int(x) for x in arrays["meta"])
        self.high, self.lows, self.zeros = arrays["high"], arrays["lows"], arrays["zeros"]

    def _select(self, k: np.ndarray, directory: np.ndarray, flip: bool) -> np.ndarray:
        """Place of the k-th (from 0) zero (flip) or one of the upper bits."""
        block = np.searchsorted(directory, k, "right") - 1
        rest = k - directory[block]
        words = self.high[block[:, None] * BLOCK + np.arange(BLOCK)]
        if flip:
            words = ~words
        counts = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int64)
        word = (counts <= rest[:, None]).sum(axis=1)
        row = np.arange(len(k))
        rest = rest - np.where(word > 0, counts[row, word - 1], 0)
        octets = words[row, word].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts = np.cumsum(np.bitwise_count(octets), axis=1, dtype=np.int64)
        octet = (counts <= rest[:, None]).sum(axis=1)
        rest = rest - np.where(octet > 0, counts[row, octet - 1], 0)
        return (block * BLOCK + word) * 64 + octet * 8 + _BYTE_SELECT[octets[row, octet], rest]

    def low(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), np.int64)
        bit = index * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        value = self.lows[word] >> shift
        value |= np.where(shift > 0, self.lows[np.minimum(word + 1, len(self.lows) - 1)] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (value & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        """Values at the given indices."""
        ones = 64 * BLOCK * np.arange(len(self.zeros)) - self.zeros
        upper = self._select(index, ones, False) - index
        return (upper << self.low_bits) | self.low(index)

    def find(self, values: np.ndarray, first: np.ndarray | int = 0, last: np.ndarray | None = None) -> np.ndarray:
        """Index of each value in its range from ``first`` to before ``last``, -1 where it is absent there."""
        if not self.n or not len(values):
            return np.full(len(values), -1, np.int64)
        upper = values >> self.low_bits
        begin = np.where(upper > 0, self._select(np.maximum(upper - 1, 0), self.zeros, True) - upper + 1, 0)
        end = self._select(upper, self.zeros, True) - upper
        begin, end = np.maximum(begin, first), np.minimum(end, self.n if last is None else last)
        wanted = values & ((1 << self.low_bits) - 1)
        low, high = begin.copy(), end.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            less = self.low(middle) < wanted[open_]
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)
        inside = low < end
        found = np.full(len(values), -1, np.int64)
        at = np.flatnonzero(inside)
        hit = at[self.low(low[at]) == wanted[at]]
        found[hit] = low[hit]
        return found
