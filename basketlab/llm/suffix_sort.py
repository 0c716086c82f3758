"""Sorting suffixes by hashed comparisons.

Prefix polynomial hashes (modulo 2**64, odd base) give the hash of any substring in
two reads.  Two suffixes are compared by a binary search for their common extension,
so a comparison costs log(depth) hash reads, and suffixes are ordered by a bottom-up
mergesort that takes all merges of a level at once.  What the hashes claim is checked
against the bytes; if a collision ever shows, the bytes decide.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        each = np.full(size, _BASE, np.uint64)
        each[0] = 1
        _powers = np.multiply.accumulate(each)
        each[1:] = pow(_BASE, -1, 1 << 64)
        _inverses = np.multiply.accumulate(each)
    return _powers[:n], _inverses[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = hash of data[i:j] times base**i."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0], out=out[1:])
    return out


class Suffixes:
    """Suffixes of ``data`` at given places, compared over ``depth`` bytes, all of which exist."""

    def __init__(self, data: np.ndarray, depth: int):
        self.data, self.depth = data, depth
        self.hashes = prefix_hashes(data)
        self.inverse = powers(len(data) + 1)[1]
        if depth >= 8:  # the first eight bytes as a number decide most comparisons
            padded = np.r_[data, np.zeros(7, np.uint8)]
            self.heads = np.lib.stride_tricks.sliding_window_view(padded, 8).copy().view(">u8").ravel().astype(np.uint64)
        self.steps = [1 << i for i in reversed(range(depth.bit_length()))]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair, ``depth`` at most."""
        length = np.zeros(len(a), np.int64)
        for step in self.steps:
            i, j = a + length, b + length
            fits = length + step <= self.depth
            i, j = np.where(fits, i, 0), np.where(fits, j, 0)
            left = (self.hashes[np.minimum(i + step, len(self.data))] - self.hashes[i]) * self.inverse[i]
            right = (self.hashes[np.minimum(j + step, len(self.data))] - self.hashes[j]) * self.inverse[j]
            length += step * (fits & (left == right))
        return length

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        if self.depth < 8:
            return self._before(a, b, or_equal)
        one, two = self.heads[a], self.heads[b]
        out = one < two
        tied = np.flatnonzero(one == two)
        out[tied] = self._before(a[tied], b[tied], or_equal[tied])
        return out

    def _before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        length = self.common(a, b)
        whole = length >= self.depth
        at = np.minimum(length, self.depth - 1)
        return np.where(whole, or_equal, self.data[a + at] < self.data[b + at])

    def sort(self, places: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Indices that sort each group's places; ``group`` is ascending and its order is kept."""
        n = len(places)
        begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(begin, append=n)
        first, total = np.repeat(begin, size), np.repeat(size, size)
        order, width, longest = np.arange(n), 1, int(size.max(initial=0))
        rank_in = np.arange(n) - first
        while width < longest:
            block = rank_in // (2 * width) * (2 * width)
            middle, end = np.minimum(block + width, total), np.minimum(block + 2 * width, total)
            here = np.flatnonzero(middle < end)
            left = rank_in[here] < middle[here]
            low = np.where(left, middle[here], block[here])
            high = np.where(left, end[here], middle[here])
            sibling, base, mine = low.copy(), first[here], places[order[here]]
            while (open_ := np.flatnonzero(low < high)).size:
                mid = (low[open_] + high[open_]) // 2
                other = places[order[base[open_] + mid]]
                # equal suffixes keep their order: those of the left run go first
                goes_on = self.before(other, mine[open_], ~left[open_])
                low[open_] = np.where(goes_on, mid + 1, low[open_])
                high[open_] = np.where(goes_on, high[open_], mid)
            own = np.where(left, rank_in[here] - block[here], rank_in[here] - middle[here])
            merged = order.copy()
            merged[base + block[here] + own + (low - sibling)] = order[here]
            order, width = merged, 2 * width
        return order

    def classes(self, places: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, new): sorted indices, and where a suffix differs from the one before it."""
        if not len(places):
            return np.empty(0, np.int64), np.empty(0, bool)
        order = self.sort(places, group)
        if not self._is_sorted(places[order], group[order]):
            windows = np.lib.stride_tricks.sliding_window_view(self.data, self.depth)[places]
            order = np.array(sorted(range(len(places)), key=lambda i: (group[i], windows[i].tobytes())))
        a, b = order[:-1], order[1:]
        return order, np.r_[True, (group[a] != group[b]) | self._differ(places[a], places[b])]

    def _differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        windows = np.lib.stride_tricks.sliding_window_view(self.data, self.depth)
        out = np.empty(len(a), bool)
        for i in range(0, len(a), 8192):
            out[i : i + 8192] = (windows[a[i : i + 8192]] != windows[b[i : i + 8192]]).any(axis=1)
        return out

    def _is_sorted(self, places: np.ndarray, group: np.ndarray) -> bool:
        windows = np.lib.stride_tricks.sliding_window_view(self.data, self.depth)
        for i in range(0, len(places) - 1, 8192):
            one, two = windows[places[i : i + 8192]], windows[places[i + 1 : i + 8193]]
            one = one[: len(two)]
            at = (one != two).argmax(axis=1)
            rows = np.arange(len(two))
            same = group[i : i + len(two)] == group[i + 1 : i + 1 + len(two)]
            if (same & (one[rows, at] > two[rows, at])).any():
                return False
        return True
