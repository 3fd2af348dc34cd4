"""Vectorised scanning of whole texts inside Arrow batches: words, span hashes, sliding minima, packed buckets.

Everything here works on one slice of a batch (a few MB of consecutive texts) with numpy; Spark decides which
rows meet where. Hashes are polynomials modulo 2**64 over a random byte table, finished by a bit mixer: the hash of
a span is the difference of two prefix sums times an inverse power, so all spans of a slice cost one pass.
"""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: low bits of a sliding-minimum key hold the position, so that the leftmost of equal hashes wins
POS_BITS = 30
POS_MASK = U64((1 << POS_BITS) - 1)


def byte_class(pattern_false: bytes) -> np.ndarray:
    """Table of 256 flags: True for bytes that belong to a word (all but the given ones)."""
    t = np.ones(256, dtype=bool)
    t[np.frombuffer(pattern_false, dtype=np.uint8)] = False
    return t


# Fixed values of the contracts: word bytes.
NOT_BLANK = byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")
#: letters, digits and every byte of a non-ASCII character
ALNUM = byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mixer (splitmix64 constants) over uint64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class SpanHash:
    """Hashes of spans of a sequence of numbers. Two objects of different seed are independent hashes."""

    def __init__(self, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.table = rng.integers(0, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
        self.base = int(rng.integers(2**40, 2**62)) | 5
        self.inv = pow(self.base, -1, 2**64)
        self.pw = np.ones(1, dtype=np.uint64)
        self.ipw = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if n >= len(self.pw):
            size = 1 << int(n).bit_length()
            for name, b in (("pw", self.base), ("ipw", self.inv)):
                a = np.full(size, U64(b), dtype=np.uint64)
                a[0] = U64(1)
                setattr(self, name, np.cumprod(a, dtype=np.uint64))

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums over bytes (through the byte table) or over uint64 numbers."""
        self._grow(len(values) + 1)
        v = self.table[values] if values.dtype == np.uint8 else values
        out = np.zeros(len(v) + 1, dtype=np.uint64)
        np.cumsum(v * self.pw[: len(v)], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of values[start:end], the length mixed in."""
        return mix((prefix[end] - prefix[start]) * self.ipw[start] + (end - start).astype(np.uint64))

    def grams(self, values: np.ndarray, n: int) -> np.ndarray:
        """Hash of every n consecutive values (len - n + 1 of them, none if there are fewer)."""
        m = len(values) - n + 1
        if m <= 0:
            return np.zeros(0, dtype=np.uint64)
        p = self.prefix(values)
        return mix((p[n : n + m] - p[:m]) * self.ipw[:m])


@functools.cache
def _trim():
    """The C library's call that gives freed pages back, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


def release_memory() -> None:
    """Give back what earlier batches of this reused worker have freed: large numpy arrays otherwise stay with the process."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def text_slices(column, max_bytes: int = 1 << 18):
    """(first row, last row + 1, bytes, offsets) over consecutive rows of an Arrow string array.

    A slice holds at most ``max_bytes`` bytes, or one longer text. A null has no bytes. The bytes are a
    read-only view of the batch.
    """
    if len(column) == 0:
        return
    release_memory()
    _, off_buf, data_buf = column.buffers()
    off = np.frombuffer(off_buf, dtype=np.int32, count=len(column) + column.offset + 1)[column.offset :].astype(np.int64)
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1)
        j = min(j, len(column))
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j
    release_memory()


def find_words(data: np.ndarray, off: np.ndarray, word_byte: np.ndarray):
    """Starts and ends (bytes) of all words of a slice, and each text's first word index (texts + 1 entries)."""
    if len(data) == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(off), dtype=np.int64)
    m = word_byte[data]
    s, e = m.copy(), m.copy()
    s[1:] &= ~m[:-1]
    e[:-1] &= ~m[1:]
    edge = off[1:-1]
    cut = edge[(edge > 0) & (edge < len(data))]  # a text's edge ends a word
    s[cut] = m[cut]
    e[cut - 1] = m[cut - 1]
    starts = np.flatnonzero(s)
    return starts, np.flatnonzero(e) + 1, np.searchsorted(starts, off)


def sliding_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """Index of the smallest hash in each run of w consecutive ones (leftmost of equals)."""
    m = len(h) - w + 1
    if m <= 0:
        return np.zeros(0, dtype=np.int64)
    key = (h & ~POS_MASK) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= w:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if size < w:
        key = np.minimum(key[: len(key) - (w - size)], key[w - size :])
    return (key & POS_MASK).astype(np.int64)


def window_starts(first: np.ndarray, length: int, total: int) -> np.ndarray:
    """Flags over all positions: True where a window of ``length`` starts inside one text."""
    ok = np.zeros(total + 1, dtype=np.int32)
    last = np.maximum(first[1:] - length + 1, first[:-1])
    np.add.at(ok, first[:-1], 1)
    np.add.at(ok, last, -1)
    return np.cumsum(ok[:total]).astype(bool)


def runs_of(values: np.ndarray, keep: np.ndarray):
    """Maximal runs of equal neighbours among the kept positions: (start, end) arrays."""
    at = np.flatnonzero(keep)
    if len(at) == 0:
        return at, at
    brk = np.flatnonzero((np.diff(at) != 1) | (np.diff(values[at]) != 0)) + 1
    s = at[np.concatenate(([0], brk))]
    e = at[np.concatenate((brk, [len(at)])) - 1] + 1
    return s, e


def merge_spans(start: np.ndarray, end: np.ndarray):
    """Union of half-open spans as sorted disjoint spans (touching ones merged)."""
    if len(start) == 0:
        return start, end
    o = np.argsort(start, kind="stable")
    s, e = start[o], np.maximum.accumulate(end[o])
    new = np.concatenate(([True], s[1:] > e[:-1]))
    return s[new], e[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(s) - 1]))]
