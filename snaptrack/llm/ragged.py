"""Numpy helpers for Arrow text columns: one flat byte buffer and offsets, no Python strings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
TAB, CASE = np.uint8(9), np.uint8(32)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else None
    if at is None or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def runs(offsets: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer row is a range of its own."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


def pieces(batches, most: int = 1 << 21, column: str = "text"):
    """``(batch slice, bytes, offsets)`` of at most ``most`` text bytes, for any batch size."""
    for batch in batches:
        data, offsets = flat(batch.column(column))
        for low, high in runs(offsets, most):
            part = offsets[low : high + 1]
            yield batch.slice(low, high - low), data[part[0] : part[-1]], part - part[0]


def characters(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """One number per UTF-8 character, its bytes folded together, and the spans in characters.
    ASCII is its own; a byte that begins no character belongs to the one before in its span."""
    if not len(data) or data.max() < 128:
        return data, starts, ends
    begins = (data & 0xC0) != 0x80
    begins[starts[starts < len(data)]] = True
    at = np.flatnonzero(begins)
    sizes = np.diff(np.append(at, len(data)))
    points = data[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(sizes > k)
        points[more] = points[more] << np.uint32(6) | (data[at[more] + k] & 0x3F)
    places = bounds(begins)
    return points, places[starts], places[ends]


class SpanHasher:
    """64-bit hashes of byte spans from one running sum; equal bytes give equal hashes."""

    def __init__(self, seed: int = 1):
        self.seed = seed
        self.base = np.uint64((BASE + 2 * seed) | 1)
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.codes = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE) + np.uint64(seed))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def grow(self, size: int) -> None:
        if len(self.powers) < size:
            first = np.ones(1, np.uint64)
            many = np.full(size, self.base, np.uint64)
            self.powers = np.concatenate([first, np.multiply.accumulate(many)])
            many = np.full(size, self.inverse, np.uint64)
            self.inverses = np.concatenate([first, np.multiply.accumulate(many)])

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self.grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes.take(data) * self.powers[: len(data)], out=sums[1:])
        spans = (sums[ends] - sums[starts]) * self.inverses[starts]
        return mixed(spans ^ ((ends - starts).astype(np.uint64) * MIX[1]))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of each row, and the row's word offsets."""
    solid = (data != 32) & (data - TAB > 4)  # as SPACE has it; numbers below 9 wrap around
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    return data + ((data >= 65) & (data <= 90)) * CASE


def take(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The spans ``values[start : start + length]`` one after another."""
    total = np.cumsum(lengths)
    count = int(total[-1]) if len(total) else 0
    return values[np.repeat(starts - (total - lengths), lengths) + np.arange(count)]


def bounds(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out
