"""Numpy kernels over the UTF-8 bytes of an Arrow string column.

The operators that run inside Arrow batches share these: a batch is cut at document
boundaries into chunks of bounded size (one very long document is a chunk of its own),
words are found with a 256-entry byte table and hashed by their 8-byte lanes; any other byte
range gets a 64-bit polynomial hash from one prefix sum. Nothing here knows Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_LANES = 8
_LANE_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_powers: dict[int, np.ndarray] = {}

# byte tables: is the byte part of a word?
_byte = np.arange(256)
ASCII_SPACE = (_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D))
NOT_SPACE = ~ASCII_SPACE
LOWER = _byte.astype(np.uint8)
LOWER[0x41:0x5B] += 0x20
# digits, a-z and every byte of a non-ASCII character (texts are lower-cased first)
ALNUM_OR_HIGH = ((_byte >= 0x30) & (_byte <= 0x39)) | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string column; NULL counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(
    column: pa.Array, limit: int = CHUNK_BYTES, rows: int = 1 << 30
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, last row + 1, bytes, offsets), each of ``limit`` bytes and ``rows``
    rows at most, or of one row."""
    data, offsets = text_bytes(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, lo + rows, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between chunks."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if n <= 8 * CHUNK_BYTES:  # what a giant document needs is not kept
            _powers[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, so that sums of hashes do not cancel."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class RangeHash:
    """Hash of any byte range of one chunk in O(1), from a prefix sum of b[j] * base**j."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        inverse = powers(_BASE_INVERSE, len(self.sums))
        return mix((self.sums[ends] - self.sums[starts]) * inverse[starts])


class Words:
    """Words of the texts of one chunk: byte ranges, and each text's range of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = table[data]
        full = np.flatnonzero(offsets[1:] > offsets[:-1])
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        begin, end = offsets[:-1][full], offsets[1:][full] - 1
        first[begin], last[end] = inside[begin], inside[end]  # texts lie side by side
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)  # words of text i: bounds[i]:bounds[i+1]
        self.counts = np.diff(self.bounds)
        self.text = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word: its 8-byte lanes folded through the finaliser, which no
        structure of the word cancels (a sum of powers would let some long words meet); words
        beyond ``_LANES`` lanes by BLAKE2b."""
        length = self.ends - self.starts
        padded = np.append(self.data, np.zeros(8, np.uint8))
        lane_at = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))
        out = mix(length.astype(np.uint64) * np.uint64(_BASE))
        for k in range(_LANES):
            left = np.flatnonzero(length > 8 * k)
            if not len(left):
                break
            inside = np.minimum(length[left] - 8 * k, 8)
            out[left] = mix(out[left] ^ (lane_at[self.starts[left] + 8 * k] & _LANE_MASK[inside]))
        for i in np.flatnonzero(length > 8 * _LANES).tolist():
            word = self.data[self.starts[i] : self.ends[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out

    def joined(self, first: int, count: int) -> bytes:
        """The words first .. first+count-1 with one space between them."""
        return b" ".join(
            self.data[s:e].tobytes()
            for s, e in zip(self.starts[first : first + count], self.ends[first : first + count])
        )

    def windows(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of n words that lies within one text."""
        at = np.arange(len(hashes))
        at = at[at + n <= self.bounds[1:][self.text]]
        return at, window_hash(hashes, at, n)


def window_hash(hashes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Order-dependent hash of the n word hashes from each position in ``at``."""
    total = hashes[at]
    for k in range(1, n):
        total = total * np.uint64(_BASE) + hashes[at + k]
    return mix(total)


def covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask of the positions inside any of the ranges."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true runs of a mask."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
