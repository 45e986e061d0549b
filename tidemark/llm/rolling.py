"""Polynomial hashes of pieces of many texts at once, for Python workers (numpy, no Spark)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

# Odd multipliers and the seed of the byte table; any others would do.
BASE = 0x9E3779B97F4A7C15 | 1
MIX = 0xBF58476D1CE4E5B9
SEED = 20240229


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow column as one byte array, and the n + 1 offsets of the texts; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=8)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    done, step = 1, np.uint64(base % 2**64)
    while done < n:  # doubling
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step
        done += more
        step = np.uint64(pow(base, done, 2**64))
    return out


def powers(n: int, base: int) -> np.ndarray:
    """base ** i mod 2 ** 64 for i < n."""
    return _powers(1 << max(16, (n - 1).bit_length()), base)[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads what a product leaves uneven in the low bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(MIX)
    return h ^ (h >> np.uint64(29))


class Rolling:
    """Hashes of any pieces [a, b) of ``data`` in constant time each. Equal bytes have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray, seed: int = SEED, base: int = BASE):
        n = len(data)
        self.inverse = powers(n + 1, pow(base, -1, 2**64))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_table(seed)[data] * powers(n, base), out=self.sums[1:])

    def pieces(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mixed((self.sums[b] - self.sums[a]) * self.inverse[a] + (b - a).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """Hash of every window of ``size`` bytes, by its start."""
        if len(self.sums) <= size:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[size:] - self.sums[:-size]) * self.inverse[: len(self.sums) - size])


def leftmost_minimum(values: np.ndarray, span: int) -> np.ndarray:
    """For every i with i + span <= len(values): the first place of the least of the top 40 bits in values[i : i + span]. At most 2**24 values."""
    n = len(values)
    if n < span:
        return np.zeros(0, np.int64)
    low = (values & ~np.uint64(0xFFFFFF)) | np.arange(n, dtype=np.uint64)
    reach = 1
    while reach < span:
        step = min(reach, span - reach)
        low = np.minimum(low[:-step], low[step:])
        reach += step
    return (low & np.uint64(0xFFFFFF)).astype(np.int64)
