"""A worker's cache from 64-bit hashes of words to their ids, looked up for whole arrays."""

from __future__ import annotations

from itertools import chain

import numpy as np

from basalt.llm.arrowtext import ragged_take

TABLE_BITS = 22
CACHE_WORDS = 2_000_000


class IdCache:
    """Open addressing over odd hashes (0 marks an empty place); words are never removed singly."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.table = np.zeros(1 << TABLE_BITS, np.uint64)
        self.slot = np.zeros(1 << TABLE_BITS, np.int32)
        self.count = 0
        self.at = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def full_with(self, more: int) -> bool:
        return self.count > 0 and self.count + more > CACHE_WORDS

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Cache slot of each hash, -1 where it has none."""
        out = np.full(len(hashes), -1, np.int64)
        place = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        seen = self.table[place]
        hit = seen == hashes
        out[hit] = self.slot[place[hit]]
        rest = np.flatnonzero(~hit & (seen != 0))
        while len(rest):
            place[rest] = (place[rest] + 1) & ((1 << TABLE_BITS) - 1)
            seen = self.table[place[rest]]
            hit = seen == hashes[rest]
            out[rest[hit]] = self.slot[place[rest[hit]]]
            rest = rest[~hit & (seen != 0)]
        return out

    def add(self, hashes: np.ndarray, found: list[list[int]]):
        """Enter new distinct hashes with their ids; their slots follow the present count."""
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        n, total = self.count, int(lengths.sum())
        while n + len(found) > len(self.at):
            self.at, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.length))
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.at[n : n + len(found)] = self.used + np.cumsum(lengths) - lengths
        self.length[n : n + len(found)] = lengths
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        self.used += total
        self.count += len(found)
        place = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        todo = np.arange(len(hashes))
        while len(todo):
            free = todo[self.table[place[todo]] == 0]
            _, one = np.unique(place[free], return_index=True)  # one entry for each free place
            put = free[one]
            self.table[place[put]] = hashes[put]
            self.slot[place[put]] = n + put
            todo = np.setdiff1d(todo, put, assume_unique=True)
            place[todo] = (place[todo] + 1) & ((1 << TABLE_BITS) - 1)

    def take(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all slots, one after another, and how many each has."""
        lengths = self.length[slots]
        return ragged_take(self.ids, self.at[slots], lengths), lengths
