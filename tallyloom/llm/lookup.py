"""Hash table of numpy arrays, filled and read a whole array at a time."""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


class Table:
    """Distinct non-negative int64 keys to values; open addressing, at most half full."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, default):
        bits = max(4, int(np.ceil(np.log2(2 * keys.size + 1))))
        self.shift, self.mask, self.default = np.uint64(64 - bits), np.int64((1 << bits) - 1), default
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, default, values.dtype)
        keys, at = keys.astype(np.int64), self._slot(keys)
        while keys.size:
            first = np.unique(at, return_index=True)[1]
            free = first[self.keys[at[first]] < 0]
            self.keys[at[free]], self.values[at[free]] = keys[free], values[free]
            rest = np.ones(keys.size, bool)
            rest[free] = False
            keys, values, at = keys[rest], values[rest], (at[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], self.default)
        todo = np.flatnonzero((found != keys) & (found >= 0))
        while todo.size:
            step = (at[todo] + 1) & self.mask
            at[todo], found = step, self.keys[step]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[step[hit]]
            todo = todo[~hit & (found >= 0)]
        return out
