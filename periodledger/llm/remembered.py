"""Results a worker remembers: lists of ids by 64-bit keys, looked up for whole arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

REMEMBERED = 200_000


class Remembered:
    """Lists of ids by a 64-bit key, in one arena; forgotten all at once when there are too many."""

    def __init__(self, limit: int = REMEMBERED):
        self.limit = limit
        self._forget()

    def _forget(self) -> None:
        self.places: dict[int, int] = {}
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)
        self.arena = np.empty(0, np.int32)

    def look_up(self, keys: np.ndarray, make: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all keys one after another, and how many each has. ``make`` gives those of the keys at some places."""
        if len(self.places) >= self.limit:
            self._forget()
        distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
        get = self.places.get
        at = np.fromiter((get(k, -1) for k in distinct.tolist()), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        if len(new):
            ids, sizes = make(first[new])
            at[new] = np.arange(len(self.sizes), len(self.sizes) + len(new))
            self.places.update(zip(distinct[new].tolist(), at[new].tolist()))
            self.starts = np.concatenate([self.starts, len(self.arena) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.arena = np.concatenate([self.arena, ids.astype(np.int32)])
        at = at[back]
        begin, size = self.starts[at], self.sizes[at]
        ends = np.cumsum(size)
        where = np.repeat(begin - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        return self.arena[where], size
