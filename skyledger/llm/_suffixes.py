"""Suffix order of windows in a block of bytes, by ranks of a difference cover.

A difference cover modulo V is a set of residues whose differences give every residue, so for any two places there is a
shift of less than V that brings both to sample places.  The suffixes at sample places are ranked once, by doubling.
Windows are then sorted one bucket of leading bytes at a time: to V bytes by their bytes, and what is still tied by the
ranks at the shift of the two.  Memory beyond the bytes is some eight bytes for each sample and for each window of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np

V = 16
BUCKET = 1 << 20  # windows that are sorted at once, about


def difference_cover(v: int) -> tuple[int, ...]:
    """The first of the smallest sets of residues whose differences modulo v are all residues."""
    for k in range(1, v + 1):
        for rest in combinations(range(1, v), k - 1):
            if len({(a - b) % v for a in (0, *rest) for b in (0, *rest)}) == v:
                return (0, *rest)
    raise AssertionError


COVER = np.array(difference_cover(V), np.int64)
SLOT = np.full(V, -1, np.int64)
SLOT[COVER] = np.arange(len(COVER))
# The least shift that brings places of two residues to sample places.
SHIFT = np.array([[next(d for d in range(V) if SLOT[(a + d) % V] >= 0 and SLOT[(b + d) % V] >= 0) for b in range(V)] for a in range(V)], np.int64)


def _dense(key: np.ndarray) -> np.ndarray:
    """Ranks from 0 of the keys, equal keys alike."""
    order = np.argsort(key)
    s = key[order]
    out = np.empty(len(key), np.uint64)
    out[order] = np.concatenate((np.zeros(1, np.uint64), np.cumsum(s[1:] != s[:-1], dtype=np.uint64)))[: len(key)]
    return out


class Suffixes:
    """Windows of ``window`` bytes of ``data``, and their order."""

    def __init__(self, data: np.ndarray, window: int):
        self.window, n = window, len(data)
        self._bytes = np.concatenate((data, np.zeros(2 * window + 4 * V, np.uint8)))
        m = len(self._bytes)
        self._eight = np.ndarray((m - 7,), ">u8", self._bytes, 0, (1,))
        self._four = np.ndarray((m - 3,), ">u4", self._bytes, 0, (1,))
        self._rank: np.ndarray | None = None
        if window > V:
            self._rank = self._sample_ranks(n + window + V)

    def _sample_ranks(self, end: int) -> np.ndarray:
        """Ranks of the suffixes at sample places by their first ``window`` bytes at least."""
        places = (np.arange(-(-end // V), dtype=np.int64)[:, None] * V + COVER).ravel()
        last = len(self._eight) - V
        places = np.minimum(places, last)
        rank = _dense(self._eight[places].astype(np.uint64))
        for k in range(8, V, 4):
            rank = _dense((rank << np.uint64(32)) | self._four[places + k])
        deep = V
        while deep < self.window:
            step = deep // V * len(COVER)
            then = np.zeros(len(rank), np.uint64)
            then[: max(len(rank) - step, 0)] = rank[step:] + np.uint64(1)
            rank = _dense((rank << np.uint64(32)) | then)
            deep *= 2
        return rank.astype(np.int64)

    def _rank_at(self, p: np.ndarray) -> np.ndarray:
        return self._rank[(p >> 4) * len(COVER) + SLOT[p & (V - 1)]]

    def _first(self, places: np.ndarray) -> np.ndarray:
        key = self._eight[places].astype(np.uint64)
        return key >> np.uint64(8 * (8 - self.window)) if self.window < 8 else key

    def buckets(self, places: np.ndarray) -> Iterator[np.ndarray]:
        """The windows at places (as indices into it) by ranges of their leading bytes; equal windows share a bucket."""
        if len(places) <= BUCKET:
            yield np.arange(len(places))
            return
        key = self._first(places)
        some = np.sort(key[:: max(len(key) // 4096, 1)])
        edges = np.unique(some[:: max(len(some) * BUCKET // len(key), 1)])
        which = np.searchsorted(edges, key, "right")
        for b in range(len(edges) + 1):
            if len(mine := np.flatnonzero(which == b)):
                yield mine

    def order(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows at places in suffix order, and for each whether its bytes are those of the one before."""
        key = self._first(places)
        order = np.argsort(key)
        s = key[order]
        new = np.ones(len(s), bool)
        new[1:] = s[1:] != s[:-1]
        for k in range(8, min(V, self.window), 4):
            at = np.flatnonzero(self._tied(new))
            part = self._four[places[order[at]] + k].astype(np.uint64)
            if self.window < k + 4:
                part >>= np.uint64(8 * (k + 4 - self.window))
            self._part(order, new, at, part, 32)
        if self._rank is None:
            return order, ~new
        done = np.zeros(len(s), bool)
        while len(at := np.flatnonzero(self._tied(new) & ~done)):
            p = places[order[at]]
            heads = np.flatnonzero(new[at])
            size = np.diff(np.concatenate((heads, [len(at)])))
            pivot = np.repeat(p[heads + size // 2], size)
            d = SHIFT[p & (V - 1), pivot & (V - 1)]
            side = np.sign(self._rank_at(p + d) - self._rank_at(pivot + d)) + 1
            done[at] = self._part(order, new, at, side.astype(np.uint64), 2) == 1
        return order, self._same(places, order, new)

    @staticmethod
    def _tied(new: np.ndarray) -> np.ndarray:
        """Members of groups of two and more."""
        return ~(new & np.concatenate((new[1:], [True])))

    @staticmethod
    def _part(order: np.ndarray, new: np.ndarray, at: np.ndarray, by: np.ndarray, bits: int) -> np.ndarray:
        """Sorts each group of the members ``at`` by a value of so many bits, and parts it; returns the sorted values."""
        group = np.cumsum(new[at], dtype=np.uint64)
        key = (group << np.uint64(bits)) | by
        o = np.argsort(key)
        order[at] = order[at][o]
        key = key[o]
        new[at[1:]] |= key[1:] != key[:-1]
        return (key & np.uint64((1 << bits) - 1)).astype(np.int64)

    def _same(self, places: np.ndarray, order: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Ties by rank are equal; neighbours that differ by rank may still share the window's bytes."""
        same = ~new
        at = np.flatnonzero(new[1:]) + 1
        for k in [*range(self.window - 8, 0, -8), 0]:
            a, b = places[order[at]] + k, places[order[at - 1]] + k
            at = at[self._eight[a] == self._eight[b]]
            if not len(at):
                break
        same[at] = True
        return same
