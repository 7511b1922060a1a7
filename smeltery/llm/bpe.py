"""Byte-pair merging of many short words at once.

A word is a row of symbols; in each round every row applies its best merge, the one of lowest rank
and, among equals, the leftmost. That is the order in which an agenda of candidate merges is worked
off, so the result is that of merging word by word; rounds only let numpy do all rows together.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

NONE = np.int32(2**31 - 1)
_EMPTY = np.uint64(2**64 - 1)
# A candidate merge is kept if this says so of (row, start, middle, end) of its two symbols.
Keep = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


class PairTable:
    """(left, right) to (rank, merged), looked up for arrays of pairs."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray) -> None:
        self._bits = max(4, int(len(left) * 4).bit_length())
        size = 1 << self._bits
        self._key = np.full(size, _EMPTY, np.uint64)
        self._rank = np.full(size, NONE, np.int32)
        self._merged = np.zeros(size, np.int32)
        key = self._keys(left, right)
        slot, waiting = self._slots(key), np.arange(len(key))
        while len(waiting):
            free = self._key[slot[waiting]] == _EMPTY
            _, first = np.unique(slot[waiting[free]], return_index=True)
            placed = waiting[free][first]
            self._key[slot[placed]] = key[placed]
            self._rank[slot[placed]] = rank[placed]
            self._merged[slot[placed]] = merged[placed]
            waiting = np.setdiff1d(waiting, placed, assume_unique=True)
            slot[waiting] = (slot[waiting] + 1) & (size - 1)

    @staticmethod
    def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slots(self, key: np.ndarray) -> np.ndarray:
        spread = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self._bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE`` if the pair does not merge) and merged symbol."""
        key = self._keys(left, right)
        slot = self._slots(key)
        held = self._key[slot]
        open_ = np.flatnonzero((held != key) & (held != _EMPTY))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self._key) - 1)
            held = self._key[slot[open_]]
            open_ = open_[(held != key[open_]) & (held != _EMPTY)]
        hit = self._key[slot] == key
        return np.where(hit, self._rank[slot], NONE), self._merged[slot]


def merge_rows(symbols: np.ndarray, table: PairTable, keep: Keep | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Merge rows of equally many symbols; returns the symbols and which of them are left."""
    count, width = symbols.shape
    symbols = symbols.copy()
    alive = np.ones((count, width), bool)
    if width < 2 or not count:
        return symbols, alive
    following = np.broadcast_to(np.arange(1, width + 1), (count, width)).copy()
    before = np.broadcast_to(np.arange(-1, width - 1), (count, width)).copy()
    rank = np.full((count, width), NONE, np.int32)
    merged = np.zeros((count, width), np.int32)

    def weigh(rows: np.ndarray, at: np.ndarray, mid: np.ndarray) -> None:
        """Set the candidate of the symbols that start at ``at`` and ``mid``."""
        ranks, into = table.find(symbols[rows, at], symbols[rows, mid])
        if keep is not None:
            found = np.flatnonzero(ranks != NONE)
            kept = keep(rows[found], at[found], mid[found], following[rows[found], mid[found]])
            ranks[found[~kept]] = NONE
        rank[rows, at], merged[rows, at] = ranks, into

    rows, at = np.divmod(np.arange(count * (width - 1)), width - 1)
    weigh(rows, at, at + 1)
    rows = np.arange(count)
    while True:
        own = rank[rows]
        at = own.argmin(1)
        good = own[np.arange(len(rows)), at] != NONE
        rows, at = rows[good], at[good]
        if not len(rows):
            return symbols, alive
        gone = following[rows, at]
        symbols[rows, at] = merged[rows, at]
        alive[rows, gone] = False
        rank[rows, gone] = NONE
        rank[rows, at] = NONE
        after = following[rows, gone]
        following[rows, at] = after
        has = after < width
        before[rows[has], after[has]] = at[has]
        weigh(rows[has], at[has], after[has])
        back = before[rows, at]
        has = back >= 0
        weigh(rows[has], back[has], at[has])


def by_width(lengths: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The indexes of the words of each length."""
    order = np.argsort(lengths, kind="stable")
    sizes, starts = np.unique(lengths[order], return_index=True)
    return [(int(n), part) for n, part in zip(sizes, np.split(order, starts[1:]), strict=True)]
