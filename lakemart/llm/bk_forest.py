"""BK-trees over 64-bit fingerprints, many at once in arrays.

The children of a node are keyed by their Hamming distance to it. By the triangle
inequality a search within a radius only has to follow the edges whose key differs
from the distance between query and node by no more than the radius.
"""

from __future__ import annotations

import numpy as np

_KEYS = 65
#: Pairs of query and node that a search holds at once, about.
FRONTIER = 2_000_000


class Forest:
    """One tree per group; the first row of a group is its root. Rows are sorted by group."""

    def __init__(self, prints: np.ndarray, groups: np.ndarray):
        self.prints = prints
        n = len(prints)
        starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if n else np.zeros(0, int)
        self.sizes = np.diff(np.r_[starts, n])
        self.root = np.repeat(starts, self.sizes)
        waiting = np.setdiff1d(np.arange(n), starts, assume_unique=True)
        parent = self.root[waiting]
        codes, children = [], []
        while len(waiting):
            code = parent * _KEYS + np.bitwise_count(prints[waiting] ^ prints[parent])
            order = np.argsort(code, kind="stable")
            waiting, code = waiting[order], code[order]
            first = np.r_[True, code[1:] != code[:-1]]
            codes.append(code[first])
            children.append(waiting[first])
            # The others go down to the child that has taken their edge.
            parent = waiting[first][np.cumsum(first) - 1][~first]
            waiting = waiting[~first]
        self._codes = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        self._children = np.concatenate(children) if children else np.zeros(0, np.int64)
        order = np.argsort(self._codes)
        self._codes, self._children = self._codes[order], self._children[order]

    def _within(self, query: np.ndarray, radius: int):
        node = self.root[query]
        while len(query):
            distance = np.bitwise_count(self.prints[query] ^ self.prints[node]).astype(np.int64)
            near = (distance <= radius) & (query < node)
            if near.any():
                yield query[near], node[near]
            base = node * _KEYS
            low = np.searchsorted(self._codes, base + np.maximum(distance - radius, 0))
            high = np.searchsorted(
                self._codes, base + np.minimum(distance + radius, _KEYS - 1), side="right"
            )
            count = high - low
            query = np.repeat(query, count)
            at = np.arange(len(query)) - np.repeat(np.cumsum(count) - count, count)
            node = self._children[np.repeat(low, count) + at]

    def pairs_within(self, radius: int):
        """Pairs of rows of one group at most ``radius`` bits apart, in parts."""
        n = len(self.prints)
        load = np.cumsum(np.repeat(self.sizes, self.sizes))
        start = 0
        while start < n:
            done = load[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(load, done + FRONTIER, side="right")))
            yield from self._within(np.arange(start, end), radius)
            start = end


def spanning_links(size: int, pairs) -> tuple[np.ndarray, np.ndarray]:
    """(row, smallest row it is linked to by the pairs), for rows that have a smaller one.

    Connects what the pairs connect with fewer links than rows.
    """
    label = np.arange(size)
    for left, right in pairs:
        while True:
            low = np.minimum(label[left], label[right])
            moved = (label[left] != low) | (label[right] != low)
            if not moved.any():
                break
            # Roots are hung on smaller ones, so that what hung on them follows.
            for side in (left, right):
                np.minimum.at(label, label[side], low)
            while (label[label] != label).any():
                label = label[label]
    rows = np.flatnonzero(label != np.arange(size))
    return rows, label[rows]
