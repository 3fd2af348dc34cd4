"""Distinct words of whole texts, counted inside Arrow batches before anything is shuffled."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def word_codes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, word_byte: np.ndarray, kind: pa.DataType = pa.string()):
    """(code of every word, distinct words): words of one slice as an Arrow dictionary.

    ``low`` holds the slice's bytes; all bytes of the class ``word_byte`` belong to words, so the words' bytes are its compressed copy.
    """
    off = np.zeros(len(starts) + 1, dtype=np.int32)
    np.cumsum(ends - starts, out=off[1:])
    words = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(off), pa.py_buffer(low[word_byte[low]])])
    d = words.dictionary_encode()
    return d.indices.to_numpy().astype(np.int64), d.dictionary


def merge_words(parts: list[pa.Array]):
    """One dictionary for several: (for each part the new code of each of its words, distinct words)."""
    d = pa.concat_arrays(parts).dictionary_encode()
    code = d.indices.to_numpy().astype(np.int64)
    at = np.cumsum([0, *[len(p) for p in parts]])
    return [code[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], d.dictionary


def summed(key: np.ndarray, *numbers: np.ndarray):
    """Distinct keys (ascending) and, for every array of numbers, the exact sum over each key."""
    if not len(key):
        return key, *numbers
    order = np.argsort(key, kind="stable")
    k = key[order]
    at = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    return k[at], *[np.add.reduceat(n[order], at) for n in numbers]
