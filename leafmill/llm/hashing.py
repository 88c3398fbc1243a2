"""Vectorised hashing of byte strings: prefix sums give the hash of any substring."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_values = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 64, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64, for exponents 0 to n."""
    if len(_powers["up"]) <= n:
        size = max(n + 1, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][: n + 1], _powers["down"][: n + 1]


class Prefixes:
    """Hashes of substrings of ``raw`` (bytes as uint8)."""

    def __init__(self, raw: np.ndarray):
        up, self.down = powers(len(raw))
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_values[raw] * up[: len(raw)], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of each raw[start:stop]; equal strings have equal hashes wherever they stand."""
        return mix((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(np.uint64))
