"""A vectorised lookup from a pair of symbols to its merge: open addressing over numpy arrays."""

from __future__ import annotations

import numpy as np


def apart(joined: np.ndarray) -> np.ndarray:
    """Which of the rows of runs to take from the left so that none touches another; joined: touches the row before."""
    at = np.arange(len(joined))
    return (at - np.maximum.accumulate(np.where(joined, 0, at))) % 2 == 0


#: No such pair.
NONE = np.int32(2**31 - 1)
#: Pairs that are looked up at once; the arrays on the way are several times as large as the answer.
AT_ONCE = 1 << 16
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Maps (left, right) to (rank, merged symbol); built once, then read by whole arrays.

    alone tells of each merged symbol whether there is a pair with it of a lower rank than the pair that made it. Unless
    a merge opens such a pair, all occurrences of a sequence's lowest pair that don't overlap may be merged together, from
    the left: nothing comes before the rest of them.
    """

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray) -> None:
        bits = max(4, int(2 * len(left)).bit_length() + 1)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, NONE, np.int32)
        self.merged = np.zeros(1 << bits, np.int32)
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        todo = np.arange(len(key))
        slot = self._slot(key)
        while len(todo):
            free = self.keys[slot[todo]] < 0
            placed = todo[free]
            _, first = np.unique(slot[placed], return_index=True)
            placed = placed[first]
            self.keys[slot[placed]] = key[placed]
            self.rank[slot[placed]], self.merged[slot[placed]] = rank[placed], merged[placed]
            done = np.zeros(len(key), bool)
            done[placed] = True
            todo = todo[~done[todo]]
            slot[todo] = slot[todo] + 1 & self.mask
        # symbols that a merge of a lower rank than their own may follow: none in most vocabularies
        made, opened = np.full(int(merged.max(initial=0)) + 1, -1, np.int64), np.full(int(max(merged.max(initial=0), left.max(initial=0), right.max(initial=0))) + 1, NONE, np.int64)
        np.maximum.at(made, merged, rank)
        np.minimum.at(opened, left, rank)
        np.minimum.at(opened, right, rank)
        self.alone = opened[: len(made)] < made

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _MULTIPLIER) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair, or -1."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot = self._slot(key)
        out = np.full(len(key), -1, np.int64)
        at = np.arange(len(key))
        while len(at):
            have = self.keys[slot]
            hit = have == key[at]
            out[at[hit]] = slot[hit]
            go = ~hit & (have >= 0)
            at, slot = at[go], slot[go] + 1 & self.mask
        return out

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        out = np.empty(len(left), np.int32)
        for at in range(0, len(left), AT_ONCE):
            slot = self.find(left[at : at + AT_ONCE], right[at : at + AT_ONCE])
            out[at : at + AT_ONCE] = np.where(slot >= 0, self.rank[slot], NONE)
        return out
