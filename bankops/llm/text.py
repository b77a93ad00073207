"""Texts of an Arrow batch as byte arrays: words, their hashes, and a hash table, all in numpy.

Everything here works on one slice of a batch, a few MB at a time, so memory does not grow with the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# the system's allocator gives the memory of a finished batch back; Arrow's own keeps it in each worker
pa.set_memory_pool(pa.system_memory_pool())

CHUNK_BYTES = 2 << 20
LONG_RUN = 4096

U = np.uint64
_K0, _K1, _M1, _M2 = U(0x9E3779B97F4A7C15), U(0x632BE59BD9B4E019), U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F)
_MASKS = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], dtype=U)


def table(members: bytes) -> np.ndarray:
    """For each byte value, is it one of the members?"""
    out = np.zeros(256, dtype=bool)
    out[list(members)] = True
    return out


SPACE = table(b"\t\n\x0b\x0c\r ")
UPPER = table(bytes(range(65, 91)))
LETTER = UPPER | table(bytes(range(97, 123)))
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[UPPER] += 32


def text_slices(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes padded by 8, row offsets) of slices near the limit; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if not n:
        return
    offs = np.frombuffer(column.buffers()[1], kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    held = column.buffers()[2]
    raw = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        size = int(offs[hi] - offs[lo])
        data = np.zeros(size + 8, np.uint8)
        data[:size] = raw[offs[lo] : offs[hi]]
        yield lo, hi, data, offs[lo : hi + 1] - offs[lo]
        lo = hi


def inner_starts(offs: np.ndarray) -> np.ndarray:
    """Where rows after the first begin, empty rows at either end left out."""
    x = offs[1:-1]
    return x[(x > 0) & (x < offs[-1])]


def runs(inside: np.ndarray, offs: np.ndarray, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true, ended also by row ends and before each position in ``cut``."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = inner_starts(offs)
    first[at] = inside[at]
    if cut is not None:
        first |= cut & inside
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def rows_of(starts: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The row of each start; starts ascend."""
    return np.repeat(np.arange(len(offs) - 1), np.diff(np.searchsorted(starts, offs)))


def mixed(h: np.ndarray) -> np.ndarray:
    h = h * _M1
    h ^= h >> U(32)
    h *= _M2
    h ^= h >> U(29)
    return h


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run's bytes, eight bytes at a step; ``data`` is padded by 8."""
    length = ends - starts
    eights = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
    h = length.astype(U) * _K0 + _K1
    if not len(h):
        return h
    h = mixed(h ^ (eights[starts] & _MASKS[np.minimum(length, 8)]))
    long = np.flatnonzero(length > LONG_RUN)
    k, at = 8, np.flatnonzero((length > 8) & (length <= LONG_RUN))
    while len(at):
        h[at] = mixed(h[at] ^ (eights[starts[at] + k] & _MASKS[np.minimum(length[at] - k, 8)]))
        k += 8
        at = at[length[at] > k]
    for i in long:
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return h


def window_hashes(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words of one row, and the position of each window's first word."""
    if len(h) < n:
        return np.zeros(0, U), np.zeros(0, np.int64)
    m = len(h) - n + 1
    s = np.zeros(m, U)
    for k in range(n):
        s = mixed(s + h[k : k + m] * U(2 * k + 1))
    at = np.flatnonzero(row[:m] == row[n - 1 :])
    return s[at], at


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0]+lengths[0]-1, then the same for the next ones."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


class HashTable:
    """64-bit keys to non-negative numbers, open addressing, looked up and filled by whole arrays."""

    def __init__(self, bits: int = 12):
        self.n = 0
        self._room(bits)

    def _room(self, bits: int) -> None:
        self.mask = U((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, U)
        self.vals = np.full(1 << bits, -1, np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for keys that are not there."""
        slot = (h & self.mask).astype(np.int64)
        out = self.vals[slot]
        at = np.flatnonzero((out >= 0) & (self.keys[slot] != h))
        while len(at):
            s = slot[at] = (slot[at] + 1) & int(self.mask)
            out[at] = self.vals[s]
            at = at[(out[at] >= 0) & (self.keys[s] != h[at])]
        return out

    def add(self, h: np.ndarray, vals: np.ndarray) -> None:
        """Distinct keys that are not there yet."""
        if 2 * (self.n + len(h)) > len(self.keys):
            used = self.vals >= 0
            old = self.keys[used], self.vals[used]
            self._room(max(12, int(4 * (self.n + len(h))).bit_length()))
            self._put(*old)
        self._put(h, vals)
        self.n += len(h)

    def _put(self, h: np.ndarray, vals: np.ndarray) -> None:
        slot, at = (h & self.mask).astype(np.int64), np.arange(len(h))
        while len(at):
            free = at[self.vals[slot[at]] < 0]
            where, pick = np.unique(slot[free], return_index=True)
            won = free[pick]
            self.keys[where], self.vals[where] = h[won], vals[won]
            left = np.ones(len(h), bool)
            left[won] = False
            at = at[left[at]]
            slot[at] = (slot[at] + 1) & int(self.mask)
