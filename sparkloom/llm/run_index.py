"""Run-length suffix index of a set of byte strings, in numpy.

The strings are joined with a sentinel after each (sentinels sort first, by string). The
suffix order comes from prefix doubling. Kept are only the runs of the Burrows-Wheeler
transform (start, symbol, first LF row), the text position of each run's last row, and where
the rows share their first ``depth`` bytes the start and the least key of each such interval.
The suffix array itself is dropped; for copies of one text the runs are a small part of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def _suffix_order(symbols: np.ndarray, ends: np.ndarray, longest: int, depth: int):
    """(suffix array, for each position an identifier of its first ``depth`` symbols)."""
    n = len(symbols)
    at = np.arange(n, dtype=np.int32)
    left = np.repeat(ends, np.diff(np.append(-1, ends))).astype(np.int32) - at  # symbols before the sentinel
    # seven 9-bit symbols to start with; what follows a sentinel does not count
    key = np.zeros(n, np.uint64)
    padded = np.append(symbols, np.zeros(7, symbols.dtype)).astype(np.uint64)
    for k in range(7):
        key = (key << np.uint64(9)) | np.where(left >= k, padded[k : k + n], 0)
    width, before, same = 7, 0, None
    while True:
        order = np.argsort(key)
        # a suffix that reaches its sentinel differs from all others: text order decides
        ended = np.flatnonzero((left[order] < width) & (left[order] >= before))
        own = order[ended]
        order[ended] = own[np.lexsort((own, key[own]))]
        sorted_key = key[order]
        new = np.append(True, sorted_key[1:] != sorted_key[:-1]) | (left[order] < width)
        rank = np.empty(n, np.int32)
        rank[order] = np.cumsum(new, dtype=np.int32) - 1
        if same is None and 2 * width >= depth:
            shift = np.minimum(at + (depth - width), n - 1)
            same = rank.astype(np.int64) * n + rank[shift]  # equal iff the first depth symbols are
        if width > longest or new.all():
            return order, same if same is not None else rank
        ahead = rank[np.minimum(at + width, n - 1)]
        key = rank.astype(np.uint64) * np.uint64(n) + np.where(left >= width, ahead, 0).astype(np.uint64)
        before, width = width, 2 * width


class RunLengthIndex:
    """Index of ``strings``; ``keys`` orders all text positions, smaller is earlier."""

    def __init__(self, data: np.ndarray, sizes: np.ndarray, keys: np.ndarray, depth: int):
        m = len(sizes)
        self.sizes, self.depth = sizes, depth
        ends = np.cumsum(sizes + 1) - 1  # positions of the sentinels
        symbols = np.zeros(len(data) + m, np.int16)
        inside = np.ones(len(symbols), bool)
        inside[ends] = False
        symbols[inside] = data.astype(np.int16) + 1
        self.ends, self.symbols = ends, symbols
        order, same = _suffix_order(symbols, ends, int(sizes.max(initial=0)) + 1, depth)
        bwt = symbols[order - 1]  # position 0 wraps to the last sentinel
        self.start = np.flatnonzero(np.append(True, bwt[1:] != bwt[:-1]))
        self.symbol = bwt[self.start]
        size = np.diff(np.append(self.start, len(bwt)))
        self.sample = order[self.start + size - 1]
        # first LF row of each run: smaller symbols, then the same symbol in earlier runs
        by = np.argsort(self.symbol, kind="stable")
        self.lf = np.empty(len(size), np.int64)
        self.lf[by] = np.cumsum(size[by]) - size[by]
        room = np.repeat(ends, sizes + 1) - np.arange(len(symbols)) >= depth
        deep = room[order]
        new = np.append(True, same[order][1:] != same[order][:-1]) | ~deep | np.append(True, ~deep[:-1])
        self.interval = np.flatnonzero(new)
        least = np.full(len(symbols), np.iinfo(np.uint64).max, np.uint64)
        least[inside] = keys
        self.least = np.minimum.reduceat(least[order], self.interval) if len(order) else least

    def step(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol before each row's suffix, row of the suffix longer by it)."""
        run = np.searchsorted(self.start, rows, "right") - 1
        return self.symbol[run], self.lf[run] + rows - self.start[run]

    def matching_statistics(self) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """Stream all strings backwards at once: yields (strings, length, rows), the rows of
        their suffixes of that length. A string is in the index itself, so its match only
        ever grows, and the interval around its row has every other occurrence."""
        alive, rows, length = np.arange(len(self.sizes)), np.arange(len(self.sizes)), 0
        while len(alive):
            more = self.sizes[alive] > length
            alive, rows = alive[more], rows[more]
            if not len(alive):
                return
            _, rows = self.step(rows)
            length += 1
            yield alive, length, rows

    def least_key(self, rows: np.ndarray) -> np.ndarray:
        """The least key among the suffixes that share their first ``depth`` bytes."""
        return self.least[np.searchsorted(self.interval, rows, "right") - 1]
