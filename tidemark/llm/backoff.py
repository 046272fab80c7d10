"""Tables that score the longest known context of every byte of a text at once.

For each order there is a table of grams with their final costs, and one of contexts with the cost
of leaving them. A byte takes the cost of its gram at the highest order; where that gram is unknown,
it pays for leaving the context, if that is known, and tries one order below. Order 0 knows every
byte. Costs are vectors, so one pass can score several models.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm import ngrams

_EMPTY = np.uint64(2**64 - 1)


class KeyIndex:
    """Positions of 64-bit keys: slots of hash levels, each level holding what collided before it."""

    def __init__(self, keys: np.ndarray):
        self.levels = []
        left, at = np.asarray(keys, np.uint64), np.arange(len(keys), dtype=np.int32)
        while len(left):
            bits = max(4, int(len(left) * 3).bit_length())
            factor = np.uint64((0x9E3779B97F4A7C15 * (2 * len(self.levels) + 1)) % 2**64 | 1)
            slot = ((left * factor) >> np.uint64(64 - bits)).astype(np.int64)
            stored, place = np.full(1 << bits, _EMPTY), np.zeros(1 << bits, np.int32)
            used, first = np.unique(slot, return_index=True)
            stored[used], place[used] = left[first], at[first]
            self.levels.append((bits, factor, stored, place))
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, at = left[rest], at[rest]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key, or -1."""
        out = np.full(len(keys), -1, np.int32)
        todo = None
        for bits, factor, stored, place in self.levels:
            asked = keys if todo is None else keys[todo]
            slot = ((asked * factor) >> np.uint64(64 - bits)).astype(np.int64)
            there = stored[slot]
            same = there == asked
            hit = np.flatnonzero(same)
            out[hit if todo is None else todo[hit]] = place[slot[hit]]
            # an empty slot proves absence: the key would have been put there
            open_ = np.flatnonzero(~same & (there != _EMPTY))
            todo = open_ if todo is None else todo[open_]
            if not len(todo):
                break
        return out


class Backoff:
    """grams[k] and contexts[k]: (keys, costs of shape (n, models)); symbols: (256, models), the costs at order 0."""

    def __init__(self, order: int, grams: dict, contexts: dict, symbols: np.ndarray):
        self.order, self.symbols = order, symbols.astype(np.float32)
        self.grams = {k: (g[0], g[1].astype(np.float32)) for k, g in grams.items()}
        self.contexts = {k: (c[0], c[1].astype(np.float32)) for k, c in contexts.items()}
        self._index = None

    def __getstate__(self):
        return self.__dict__ | {"_index": None}  # built again where it is used

    def costs(self, key: np.ndarray) -> np.ndarray:
        """Cost of every byte, from keys of this order; shape (n, models)."""
        if self._index is None:
            self._index = {k: (KeyIndex(self.grams[k][0]), KeyIndex(self.contexts[k][0])) for k in range(1, self.order + 1)}
        out = np.zeros((len(key), self.symbols.shape[1]), np.float32)
        todo = np.arange(len(key))
        for k in range(self.order, 0, -1):
            grams, contexts = self._index[k]
            at = grams.find(key)
            hit = at >= 0
            found = todo[hit]
            out[found] += self.grams[k][1][at[hit]]
            todo, key = todo[~hit], key[~hit]
            if not len(todo):
                return out
            at = contexts.find(ngrams.context(key, k))
            known = at >= 0
            out[todo[known]] += self.contexts[k][1][at[known]]
            key = key >> np.uint64(8)
        out[todo] += self.symbols[key.astype(np.int64)]
        return out


def row_costs(model: Backoff, data: np.ndarray, bounds: np.ndarray, piece: int = 1 << 20) -> np.ndarray:
    """Sum of costs per row, shape (rows, models); long rows are taken in pieces."""
    out = np.zeros((len(bounds) - 1, model.symbols.shape[1]))
    key = ngrams.keys(data, bounds, model.order)
    for low in range(0, len(key), piece):
        high = min(low + piece, len(key))
        cost = model.costs(key[low:high])
        first = int(np.searchsorted(bounds, low, side="right")) - 1
        last = int(np.searchsorted(bounds, high, side="left"))
        edges = np.maximum(bounds[first:last], low) - low
        rows = np.flatnonzero(np.diff(np.append(edges, high - low)))
        out[first + rows] += np.add.reduceat(cost, edges[rows], axis=0, dtype=np.float64)
    return out


def lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Positions in sorted ``keys`` of the wanted ones, -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


