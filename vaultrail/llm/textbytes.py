"""Vectorised work on the UTF-8 bytes of text columns inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; a longer text forms a slice of its own.
SLICE = 1 << 20

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, last row + 1, bytes, bounds) of a text column; a null text is an empty one.

    Row ``first + i`` has the bytes from ``bounds[i]`` to ``bounds[i + 1]``.
    """
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def lower(data: np.ndarray) -> np.ndarray:
    """Only A to Z become a to z."""
    return _LOWER[data]


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the runs of bytes other than space and 0x09 to 0x0D."""
    inside = ~((data == 32) | ((data - np.uint8(9)) < 5))
    if not len(inside):
        return (np.empty(0, np.int64),) * 3
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Fingerprints:
    """64-bit fingerprints of any byte ranges of one slice, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray):
        global _powers, _inverses
        n = len(data) + 1
        if len(_powers) < n:
            size = max(n, SLICE * 2)
            for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                globals()[name] = np.multiply.accumulate(table)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[: n - 1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * _inverses[starts] + np.uint64(0x632BE59BD9B4E019) * (ends - starts).astype(np.uint64))

    def all_of(self, size: int) -> np.ndarray:
        """Of the range of ``size`` bytes at every place where one fits."""
        return mix((self.sums[size:] - self.sums[:-size]) * _inverses[: len(self.sums) - size])

