"""Counting quotient filters over packed word-id n-grams: lossless, compact, mergeable counts.

An n-gram of word ids of ``bits`` bits is one number of n * bits bits, held in two halves. A four-round Feistel network permutes the numbers
invertibly, so that they spread evenly and a stored number gives its n-gram back. The permuted number's top bits are the *range* (which filters
meet), the next ones the *quotient* (the slot), all others the *remainder*, kept in full: a count is never another n-gram's.

A filter stores its entries in permuted order as the occupied slots and run ends (one bit a slot, one an entry), remainders of exactly the bits they
need, and counters of one byte with the few larger ones apart.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

from .rolling import U64, mix
from .terms import summed

ROUNDS = tuple(U64((0x9E3779B97F4A7C15 * (k + 1)) % 2**64) for k in range(4))
HEAD = struct.Struct("<IBI")
MOST_BITS = 124


@dataclass(frozen=True)
class Packing:
    """N-grams of ``n`` ids of ``bits`` bits; ``range_bits`` leading bits of the permuted number name the range."""

    n: int
    bits: int
    range_bits: int = 0

    def __post_init__(self):
        if self.n < 2 or self.n * self.bits > MOST_BITS:
            raise ValueError(f"n-grams of 2 ids or more and at most {MOST_BITS} bits")
        object.__setattr__(self, "range_bits", min(self.range_bits, self.half))

    @property
    def half(self) -> int:
        return -(-self.n * self.bits // 2)

    def pack(self, ids):
        """Halves (left, right) of the n-grams whose k-th ids are ids[k]."""
        h, b = U64(self.half), U64(self.bits)
        mask = U64((1 << self.half) - 1)
        left, right = np.zeros(len(ids[0]), dtype=np.uint64), np.zeros(len(ids[0]), dtype=np.uint64)
        for w in ids:
            left = (left << b) | (right >> (h - b))
            right = ((right << b) & mask) | w
        return left, right

    def unpack(self, left, right):
        h, b, low = U64(self.half), U64(self.bits), U64((1 << self.bits) - 1)
        ids = []
        for _ in range(self.n):
            ids.append(right & low)
            right = (right >> b) | ((left & low) << (h - b))
            left = left >> b
        return ids[::-1]

    def permute(self, left, right):
        cut = U64(64 - self.half)
        for c in ROUNDS:
            left, right = right, left ^ (mix(right + c) >> cut)
        return left, right

    def restore(self, left, right):
        cut = U64(64 - self.half)
        for c in ROUNDS[::-1]:
            left, right = right ^ (mix(left + c) >> cut), left
        return left, right

    def add_up(self, left, right, count):
        """Distinct permuted numbers in order and their summed counts."""
        if 2 * self.half <= 64:
            h = U64(self.half)
            key, count = summed((left << h) | right, count)
            return key >> h, key & U64((1 << self.half) - 1), count
        order = np.lexsort((right, left))
        left, right, count = left[order], right[order], count[order]
        if not len(left):
            return left, right, count
        at = np.flatnonzero(np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1]))))
        return left[at], right[at], np.add.reduceat(count, at)

    def ranges(self, left):
        return (left >> U64(self.half - self.range_bits)).astype(np.int64)


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bits of every value, one row each, highest first."""
    raw = values.astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1)[:, 64 - width :]


def _numbers(bits: np.ndarray) -> np.ndarray:
    out = np.zeros((len(bits), 64), dtype=np.uint8)
    out[:, 64 - bits.shape[1] :] = bits
    return np.packbits(out, axis=1).view(">u8").reshape(-1).astype(np.uint64)


def encode(p: Packing, left, right, count) -> bytes:
    """One filter of entries of one range in permuted order."""
    n = len(left)
    inner = p.half - p.range_bits
    q = min(inner, max(0, int(n).bit_length() - 1))
    rest = inner - q
    own = left & U64((1 << inner) - 1)
    slot = (own >> U64(rest)).astype(np.int64)
    occupied = np.zeros(1 << q, dtype=bool)
    occupied[slot] = True
    run_end = np.concatenate((slot[1:] != slot[:-1], [True]))
    remainder = np.concatenate((_bits(own, rest), _bits(right, p.half)), axis=1)
    large = np.flatnonzero(count > 254)
    small = np.where(count > 254, 255, count).astype(np.uint8)
    parts = [np.packbits(occupied), np.packbits(run_end), np.packbits(remainder), small, count[large].astype("<i8")]
    return HEAD.pack(n, q, len(large)) + b"".join(x.tobytes() for x in parts)


def decode(p: Packing, rng: int, cell: bytes):
    """(left, right, count) of a filter of range ``rng``, in permuted order."""
    n, q, n_large = HEAD.unpack_from(cell)
    inner = p.half - p.range_bits
    rest, at = inner - q, HEAD.size

    def bits(many):
        nonlocal at
        size = -(-many // 8)
        out = np.unpackbits(np.frombuffer(cell, dtype=np.uint8, count=size, offset=at), count=many)
        at += size
        return out

    slots = np.flatnonzero(bits(1 << q)).astype(np.uint64)
    run_end = bits(n)
    remainder = bits(n * (rest + p.half)).reshape(n, rest + p.half)
    count = np.frombuffer(cell, dtype=np.uint8, count=n, offset=at).astype(np.int64)
    count[count == 255] = np.frombuffer(cell, dtype="<i8", count=n_large, offset=at + n)
    run = np.cumsum(run_end) - run_end
    left = (U64(rng) << U64(inner)) | (slots[run] << U64(rest)) | _numbers(remainder[:, :rest])
    return left, _numbers(remainder[:, rest:]), count


def build(p: Packing, ids):
    """Filters of the given n-grams: yields (range, filter)."""
    left, right = p.permute(*p.pack(ids))
    left, right, count = p.add_up(left, right, np.ones(len(left), dtype=np.int64))
    if not len(left):
        return
    rng = p.ranges(left)
    at = np.flatnonzero(np.concatenate(([True], rng[1:] != rng[:-1])))
    for i, j in zip(at, np.append(at[1:], len(rng)), strict=True):
        yield int(rng[i]), encode(p, left[i:j], right[i:j], count[i:j])


def merge(p: Packing, rng: int, cells):
    """The merged filter's entries: (left, right, count) in permuted order."""
    parts = [decode(p, rng, c) for c in cells]
    return p.add_up(*[np.concatenate(x) for x in zip(*parts, strict=True)])


def entries(p: Packing, left, right):
    """Ids of stored n-grams: the permutation undone."""
    return p.unpack(*p.restore(left, right))
