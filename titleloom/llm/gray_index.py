"""Hamming index over fingerprints in Gray order: a forest of masked bit patterns, and joins within it.

Fingerprints that follow each other in Gray order share most of their bits. A node covers a few consecutive
children and holds the bits on which all fingerprints below it agree: a mask and the values under it. Two
nodes whose agreed bits differ in more than ``distance`` places hold no linked pair, so a pair of subtrees is
dropped as a whole as soon as the differences that have come together on the way down exceed the distance.

Everything here works on the arrays of one task and is vectorised over all its trees at once.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

FAN_OUT = 8
#: Pairs of nodes that are expanded at a time; bounds memory whatever the data are.
PAIRS = 1 << 14


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of a code word in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayForest:
    """One tree for each value of ``tree``, over codes that are sorted by tree and Gray rank."""

    def __init__(self, codes: np.ndarray, tree: np.ndarray):
        self.codes, self.size = codes, len(codes)
        low = high = codes
        #: Per level, leaves first: where the children of each node begin, the mask, and the bits under it.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while True:
            begins = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if len(tree) else np.zeros(0, np.int64)
            within = np.arange(len(tree)) - np.repeat(begins, np.diff(np.r_[begins, len(tree)]))
            first = np.flatnonzero(within % FAN_OUT == 0)
            low, high = np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first)
            self.levels.append((np.r_[first, len(tree)], ~(low ^ high), low))
            tree = tree[first]
            if len(first) == len(begins):
                break

    def join(self, left: np.ndarray, right: np.ndarray, distance: int, found: Callable) -> None:
        """Call ``found(i, j)`` with positions of linked codes, for pairs of trees ``left[k], right[k]``.

        A tree that is paired with itself gives each pair once.
        """
        stack = [(len(self.levels), left, right)]
        while stack:
            level, a, b = stack.pop()
            if len(a) > PAIRS:
                stack += [(level, a[k : k + PAIRS], b[k : k + PAIRS]) for k in range(0, len(a), PAIRS)]
                continue
            if level < len(self.levels) or level == 0:
                near = self._near(level, a, b, distance)
                a, b = a[near], b[near]
            if not len(a):
                continue
            if level == 0:
                found(a, b)
                continue
            stack.append((level - 1, *self._children(level - 1, a, b)))

    def _near(self, level: int, a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
        """Which pairs may hold links. Level 0 are the codes themselves."""
        if level == 0:
            return (np.bitwise_count(self.codes[a] ^ self.codes[b]) <= distance) & (a != b)
        _, mask, bits = self.levels[level - 1]
        return np.bitwise_count((bits[a] ^ bits[b]) & mask[a] & mask[b]) <= distance

    def _children(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of a child of ``a[k]`` and one of ``b[k]``; of a node with itself each pair once."""
        first = self.levels[level][0]
        wide, high = first[a + 1] - first[a], first[b + 1] - first[b]
        count = wide * high
        pair = np.repeat(np.arange(len(a)), count)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
        left, right = first[a[pair]] + nth // high[pair], first[b[pair]] + nth % high[pair]
        once = (a != b)[pair] | (left <= right)
        return left[once], right[once]


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of ``a[k]`` and ``b[k]``; ``parent`` always points straight at the lowest member."""
    while True:
        a, b = parent[a], parent[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up
