"""Words of a batch of texts as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D. Words and runs of words
are compared by 64-bit hashes; where equality decides a result, callers combine
two independent ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[ord("A") : ord("Z") + 1] += 32

_random = np.random.default_rng(20260101)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# odd multipliers: the first for bytes within a word, the others for words within a run
_BASES = [int(x) | 5 for x in _random.integers(1 << 40, 1 << 62, 4)]
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base % (1 << 64), np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 21:
            _powers[base] = have
    return have[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts and where each text begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    if ends is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    kind = np.int64 if wide else np.int32
    off = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if len(off) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    flat = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, off - off[0]


def slices(off: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about so many bytes; a longer text stands alone."""
    at, n = 0, len(off) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
        yield at, to
        at = to


class Words:
    """Words of the texts [lo, hi) of a batch.

    start, end: bytes of each word in data; first: the first word of each text and,
    at last, how many words there are; doc: the text of each word.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, lo: int = 0, hi: int | None = None, lower: bool = False):
        hi = len(off) - 1 if hi is None else hi
        data = data[off[lo] : off[hi]]
        self.off = off[lo : hi + 1] - off[lo]
        self.data = _lower[data] if lower else data
        n = len(data)
        if n:
            space = _space[data]
            begins, ends = np.empty(n, bool), np.empty(n, bool)
            begins[0], begins[1:] = True, space[:-1]
            ends[-1], ends[:-1] = True, space[1:]
            inner = self.off[1:-1]
            begins[inner[inner < n]] = True
            ends[inner[inner > 0] - 1] = True
            solid = ~space
            self.start = np.flatnonzero(begins & solid)
            self.end = np.flatnonzero(ends & solid) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.first = np.searchsorted(self.start, self.off)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(hi - lo), self.count)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, prefix: int | None = None, family: int = 0) -> np.ndarray:
        """A 64-bit hash of each word, or of no more than its first bytes."""
        out = np.empty(len(self), np.uint64)
        at = 0
        while at < len(self):  # a bounded number of bytes at a time
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + SLICE_BYTES, "right")))
            base = self.start[at]
            part = self.data[base : self.end[to - 1]]
            start, size = self.start[at:to] - base, self.end[at:to] - self.start[at:to]
            place = np.arange(len(part)) - np.repeat(start, np.diff(np.append(start, len(part))))
            gap = _space[part] if prefix is None else _space[part] | (place >= prefix)
            size = size if prefix is None else np.minimum(size, prefix)
            place[gap] = 0
            value = _BYTE[part] * powers(_BASES[family], int(place.max()) + 1)[place]
            value[gap] = 0
            out[at:to] = mix(np.add.reduceat(value, start) + size.astype(np.uint64))
            at = to
        return out

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


class Runs:
    """Hashes of any run of words, from running sums."""

    def __init__(self, hashes: np.ndarray, family: int = 1):
        self.base = _BASES[family]
        self.inverse = pow(self.base, -1, 1 << 64)
        n = len(hashes)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * powers(self.base, n), out=self.sums[1:])

    def at(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Hashes of the runs of so many words that begin there."""
        n = len(self.sums)
        run = (self.sums[start + length] - self.sums[start]) * powers(self.inverse, n)[start]
        return mix(run + np.asarray(length).astype(np.uint64))

    def all(self, length: int) -> np.ndarray:
        """Hashes of the runs that begin at each word, texts' ends disregarded."""
        n = len(self.sums) - 1 - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        gap = (self.sums[length:] - self.sums[:n]) * powers(self.inverse, len(self.sums))[:n]
        return mix(gap + np.uint64(length))


def covered(n: int, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Which of n places lie in one of the spans."""
    steps = np.bincount(start, minlength=n + 1)[: n + 1] - np.bincount(start + length, minlength=n + 1)[: n + 1]
    return np.cumsum(steps[:n]) > 0
