"""Rolling hashes over Arrow text columns.

The bytes of many texts are handled as one NumPy array, piece by piece, so that
neither many short texts nor one very long text needs more than a bounded
amount of memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from stayline.llm.common import per_process

#: Bytes hashed at a time.
PIECE = 1 << 18


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each text starts, with the end as last entry."""
    if column.null_count:
        raise ValueError("texts must not be null")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at.astype(np.int64) - at[0]


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64; a worker keeps the tables, of a few sizes, between tasks."""

    def make() -> tuple[np.ndarray, np.ndarray]:
        with np.errstate(over="ignore"):
            up = np.full(n, base, np.uint64)
            up[0] = 1
            down = np.full(n, pow(base, -1, 2**64), np.uint64)
            down[0] = 1
            return np.multiply.accumulate(up), np.multiply.accumulate(down)

    return per_process(("powers", base, n), make)


def byte_slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Rows lo .. hi - 1 that together have at most ``most`` bytes, or a single row."""
    ends, lo = np.cumsum(sizes, dtype=np.int64), 0
    while lo < len(sizes):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield lo, hi
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
#: A random word for each byte value, one table per hash.
TABLES = [np.random.default_rng(n).integers(0, 2**64, 256, np.uint64) for n in (11, 12)]


class Rolled:
    """Hashes of any substring of ``raw``, in constant time each."""

    def __init__(self, raw: np.ndarray, which: int = 0):
        n = len(raw)
        # a few sizes only, so that the power tables are reused
        size = max(1 << 16, 1 << (n + 1).bit_length())
        up, self.down = _powers(BASES[which], size)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(TABLES[which][raw] * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.down[start])


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values, from two running minima over blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    onward = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], onward[width - 1 : width - 1 + n])
