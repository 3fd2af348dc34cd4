"""Word and shingle jobs over text columns: tokens by single-space split, cleaning, character and digit shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import digit_shingles, text_clean


def words(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per token of ``text.split(' ')``: runs of spaces give empty tokens, as in the plain split."""
    return df.select(F.explode(F.split(F.col(text), " ")).alias("word"))


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): map-side partial counts, so a very frequent word costs one row per map task."""
    return words(df, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def distinct_words(df: DataFrame, text: str = "text") -> DataFrame:
    return words(df, text).distinct()


def word_total(df: DataFrame, text: str = "text") -> DataFrame:
    """Number of tokens, summed per row (no explode needed)."""
    return df.agg(F.coalesce(F.sum(F.size(F.split(F.col(text), " "))), F.lit(0)).cast("bigint").alias("n_words"))


def clean_documents(df: DataFrame, text: str = "text", out: str = "text_clean") -> DataFrame:
    return df.withColumn(out, text_clean(F.col(text)))


def shingle_counts(
    docs: DataFrame,
    ks: Sequence[int] = (5, 9),
    id_col: str = "doc_id",
    text: str = "text",
    drop_short: bool = False,
) -> DataFrame:
    """Distinct character k-shingles per cleaned document, for every k in one pass over the text.

    Documents shorter than k keep a 0 count (``drop_short=True`` drops them instead, as an explode
    followed by an inner join would). Work is per document, so any number of documents spreads over
    all tasks; no document's shingles leave its row: they are numbers in numpy, sorted and counted.
    """
    d = docs.select(F.col(id_col), text_clean(F.col(text)).alias("_t"))
    names = [f"n_shingles_k{k}" for k in ks]
    schema = T.StructType([d.schema[id_col], T.StructField("n_chars_clean", T.IntegerType()), *[T.StructField(n, T.IntegerType()) for n in names]])

    def counted(batches):
        for batch in batches:
            for at, texts in content_slices(batch["_t"]):
                codes = [None if t is None else np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32) for t in texts]
                sizes = [pa.array([None if c is None else len(c) for c in codes], pa.int32())]
                counts = [pa.array([None if c is None else distinct_windows(c, k) for c in codes], pa.int32()) for k in ks]
                yield pa.RecordBatch.from_arrays([batch[id_col].slice(at, len(texts)), *sizes, *counts], names=schema.names)

    out = d.mapInArrow(counted, schema)
    if drop_short:
        out = out.where(F.col("n_chars_clean") >= max(ks))
    return out


def distinct_windows(code: np.ndarray, k: int) -> int:
    """Number of distinct runs of ``k`` consecutive codes (character by character, whatever their width)."""
    n = len(code) - k + 1
    if n < 1:
        return 0
    used = np.zeros(int(code.max()) + 1, dtype=bool)
    used[code] = True
    code = (np.cumsum(used) - 1)[code]
    letters = int(used.sum())
    key, top = code[:n], letters
    for j in range(1, k):
        if top * letters >= 2**62:  # they do not fit: number what is there so far
            seen, key = np.unique(key, return_inverse=True)
            top = len(seen)
        key, top = key * letters + code[j : n + j], top * letters
    key = np.sort(key)
    return 1 + int(np.count_nonzero(key[1:] != key[:-1]))


def digit_string_shingles(df: DataFrame, digits: str, k: int, strict: bool = True) -> DataFrame:
    """Sorted distinct k-digit shingles of a digit string column, as BIGINT array ``shingles``.

    ``strict`` raises, like the definition, when k exceeds the length of a string.
    """
    arr = digit_shingles(F.col(digits), k)
    if strict:
        arr = F.when(F.length(digits) < k, F.raise_error(F.lit(f"k={k} longer than a digit string"))).otherwise(arr)
    return df.withColumn("shingles", arr)


def content_slices(column, limit: int = 1 << 19):
    """(first row, contents) of slices of about ``limit`` characters or elements: the memory of a slice does not depend on how long the rows are."""
    at, rows, size = 0, [], 0
    for i in range(len(column)):
        rows.append(column[i].as_py())
        size += len(rows[-1] or ())
        if size >= limit:
            yield at, rows
            at, rows, size = i + 1, [], 0
    if rows:
        yield at, rows


def shingle_ids(texts: Sequence[str | None], k: int) -> list:
    """Per text, the distinct ids of its character k-shingles: the first 15 hex digits of the shingle's md5.

    Windows of all the texts are numbered together, so a shingle of several texts is hashed once. Memory is about 100 bytes a character.
    """
    texts = [t or "" for t in texts]
    whole = "".join(texts)
    size = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(size) - size
    n = len(whole) - k + 1
    none = np.zeros(0, dtype=np.int64)
    if n < 1 or size.max() < k:
        return [none for _ in texts]
    code = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
    used = np.zeros(int(code.max()) + 1, dtype=bool)
    used[code] = True
    code = (np.cumsum(used) - 1)[code]
    letters = int(used.sum())
    key, top = code[:n], letters
    for j in range(1, k):
        if top * letters >= 2**62:  # so many characters that k of them do not fit: number what is there so far
            seen, key = np.unique(key, return_inverse=True)
            top = len(seen)
        key, top = key * letters + code[j : n + j], top * letters
    inside = np.concatenate([np.arange(s, s + m - k + 1) for s, m in zip(starts.tolist(), size.tolist(), strict=True) if m >= k])
    _, first, number = np.unique(key[inside], return_index=True, return_inverse=True)
    heads = b"".join([hashlib.md5(whole[i : i + k].encode()).digest()[:8] for i in inside[first].tolist()])
    ids = (np.frombuffer(heads, dtype=">u8") >> np.uint64(4)).astype(np.int64)
    ends = np.cumsum(np.maximum(size - k + 1, 0))
    return [np.unique(ids[np.unique(number[e - m + k - 1 : e])]) if m >= k else none for e, m in zip(ends.tolist(), size.tolist(), strict=True)]


def sorted_distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order; several times cheaper than ``np.unique`` on whole numbers. Sorts ``values`` in place."""
    values.sort()
    return values[np.concatenate((np.ones(min(len(values), 1), dtype=bool), values[1:] != values[:-1]))]


def shingle_keys(texts: Sequence[str | None], k: int) -> list:
    """As ``shingle_ids``, with other keys, the same in every call: k characters packed into 60 bits, or a hash of 62 bits where one of them does not fit.

    Several times cheaper.
    """
    bits, out = 60 // k, []
    for t in texts:
        c = np.frombuffer((t or "").encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        n = max(0, len(c) - k + 1)
        key, wide = c[:n].copy(), c >= 1 << bits
        for j in range(1, k):
            key = (key << np.uint64(bits)) | c[j : n + j]
        if wide.any():
            at = np.flatnonzero(np.convolve(wide, np.ones(k, dtype=np.int64))[k - 1 : k - 1 + n])  # windows with a character that does not fit
            z = np.zeros(len(at), dtype=np.uint64)
            for j in range(k):
                z = (z ^ c[at + j]) * np.uint64(0x9E3779B97F4A7C15)
                z ^= z >> np.uint64(29)
            key[at] = (z >> np.uint64(2)) | np.uint64(1 << 62)
        out.append(sorted_distinct(key.view(np.int64)))
    return out


def shingle_arrays(contents: DataFrame, k: int) -> DataFrame:
    """(set_id, elements ARRAY<BIGINT>) of rows (set_id, content): ``shingle_ids`` of every text."""

    def rows(batches):
        for batch in batches:
            for at, texts in content_slices(batch["content"]):
                ids = shingle_ids(texts, k)
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([batch["set_id"].slice(at, len(texts)), lists], names=["set_id", "elements"])

    return contents.select("set_id", "content").mapInArrow(rows, "set_id bigint, elements array<bigint>")
