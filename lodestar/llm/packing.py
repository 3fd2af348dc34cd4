"""Packed shuffles: numpy arrays cut by a bucket number into one binary cell per bucket, and keys of document rows.

Operators that compare positions of texts move millions of small fixed-size records. A row per record would cost more
than the record; a row per (map batch, bucket) with the records as bytes shuffles the same data in a few large cells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NULL_ID = 1 << 62  # flag in ``part`` of a row whose id is null


def bucket_count(rows: int, per_bucket: int = 512, least: int = 64) -> int:
    """Buckets so that each gets about ``per_bucket`` documents' records, whatever the table's size."""
    return max(least, -(-rows // per_bucket))


def row_part(text, null_id):
    """62 bits of the text's hash, a null id flagged apart: with the id it names a row. A third of all rows may have a null
    id and only this number to tell them apart, for which 32 bits are too few."""
    hashed = F.coalesce(F.shiftrightunsigned(F.xxhash64(text.cast("binary")), 2), F.lit(0))
    return hashed + F.when(null_id, F.lit(NULL_ID)).otherwise(F.lit(0))


def keyed_texts(docs: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """_id, _part, _db, _text. (_id, _part) names a row: its id (0 for null) and ``row_part`` of its text.

    Rows that agree in both have equal texts and so equal results. ``_db`` is the row's document bucket.
    """
    part = row_part(F.col(text_col), F.col(id_col).isNull())
    x = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(0)).alias("_id"), part.alias("_part"), F.col(text_col).alias("_text"))
    return x.select("_id", "_part", F.pmod(F.xxhash64("_id", "_part"), F.lit(buckets)).cast("int").alias("_db"), "_text")


def null_ids(ids: np.ndarray, part: np.ndarray) -> pa.Array:
    """Ids for the result: null again where the flag says so."""
    return pa.array(ids, type=pa.int64(), mask=part >= NULL_ID)


def cut(bucket: np.ndarray, *arrays: np.ndarray, cell=np.ndarray.tobytes):
    """Distinct buckets and, for every array, the bytes of each bucket's elements (order kept)."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    if not len(b):
        return b, [[] for _ in arrays]
    at = np.concatenate(([0], np.flatnonzero(np.diff(b)) + 1))
    end = np.append(at[1:], len(b))
    cells = []
    for a in arrays:
        a = a[order]
        cells.append([cell(a[i:j]) for i, j in zip(at, end, strict=True)])
    return b[at], cells


def joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """All cells of a binary column as one array."""
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), dtype=dtype)


def pack(a: np.ndarray) -> bytes:
    """An array as compressed byte planes (all first bytes of the records, all second bytes, ...)."""
    raw = np.frombuffer(a.tobytes(), dtype=np.uint8).reshape(len(a), -1)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def unpack(cell: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(cell), dtype=np.uint8)
    size = np.dtype(dtype).itemsize
    return np.frombuffer(np.ascontiguousarray(raw.reshape(size, -1).T).tobytes(), dtype=dtype)


def unpacked(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """All cells of a column of packed arrays as one array."""
    cells = [unpack(x, dtype) for x in column.to_pylist() if x]
    return np.concatenate(cells) if cells else np.zeros(0, dtype=dtype)


SPAN = np.dtype([("id", "<i8"), ("part", "<i8"), ("db", "<i4"), ("start", "<u4"), ("end", "<u4")])
SPAN_SCHEMA = "bucket int, spans binary"


def span_rows(spans: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    """Spans cut by their document bucket."""
    db, (cells,) = cut(spans["db"], spans)
    return pa.record_batch([pa.array(db, pa.int32()), pa.array(cells, pa.binary())], schema=schema)


def spans_by_row(spans: np.ndarray) -> dict:
    """(id, part) -> (starts, ends) of a document bucket's spans."""
    if not len(spans):
        return {}
    s = spans[np.lexsort((spans["part"], spans["id"]))]
    at = np.flatnonzero(np.concatenate(([True], (np.diff(s["id"]) != 0) | (np.diff(s["part"]) != 0))))
    end = np.append(at[1:], len(s))
    return {(int(s["id"][i]), int(s["part"][i])): (s["start"][i:j].astype(np.int64), s["end"][i:j].astype(np.int64)) for i, j in zip(at, end, strict=True)}


def bounded_sample(ids: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """At most ``most`` rows of each group: those of smallest key hash.

    Group sizes (one row a group, partial sums) first set a hash threshold that leaves about 1.2 * most rows of a group, so
    the exact ranking never sees a large group. The number of groups must be small; ``ids`` is read twice.
    """
    sizes = ids.groupBy(group).agg(F.count(F.lit(1)).alias("n")).collect()
    span = 1 << 31
    limit = F.lit(span)
    for r in sizes:
        cut_at = min(span, int(span * (1.2 * most + 50) / r["n"]))
        limit = F.when(F.col(group) == F.lit(r[group]), F.lit(cut_at)).otherwise(limit)
    low = F.pmod(F.xxhash64(key), F.lit(span))
    w = Window.partitionBy(group).orderBy(low, key)
    few = ids.where(low < limit)
    return few.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")
