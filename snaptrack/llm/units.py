"""Encoding texts through their distinct units, each encoded once per task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from snaptrack.llm.ragged import SpanHasher, bounds, take

MOST_UNITS = 1 << 18


class UnitCache:
    """Ids of units by hash. ``encode`` gets distinct units as bytes and returns flat ids and
    lengths. The cache is emptied when full, which costs time and changes no result."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.encode, self.hasher = encode, SpanHasher()
        self.clear()

    def clear(self) -> None:
        self.places: dict[int, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0
        self.starts, self.lengths = np.zeros(MOST_UNITS, np.int64), np.zeros(MOST_UNITS, np.int64)

    def add(self, units: list[bytes], hashes: list[int]) -> None:
        ids, lengths = self.encode(units)
        need = self.used + len(ids)
        if need > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(2 * need - len(self.ids), np.int32)])
        low, high = len(self.places), len(self.places) + len(units)
        if high > len(self.starts):
            more = np.zeros(high, np.int64)
            self.starts, self.lengths = (
                np.concatenate([old, more]) for old in (self.starts, self.lengths)
            )
        self.starts[low:high] = self.used + bounds(lengths)[:-1]
        self.lengths[low:high] = lengths
        self.ids[self.used : need] = ids
        self.used = need
        self.places.update(zip(hashes, range(low, high)))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Flat ids of the units in order, and the number of ids of each unit."""
        if len(self.places) > MOST_UNITS:
            self.clear()
        hashes = self.hasher(data, starts, ends)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        listed = distinct.tolist()
        missing = [i for i, h in enumerate(listed) if h not in self.places]
        if missing:
            spans = zip(starts[first[missing]].tolist(), ends[first[missing]].tolist())
            raw = data.tobytes()
            self.add([raw[a:b] for a, b in spans], [listed[i] for i in missing])
        found = np.fromiter((self.places[h] for h in listed), np.int64, len(listed))
        at = found[back]
        lengths = self.lengths[at]
        return take(self.ids, self.starts[at], lengths), lengths
