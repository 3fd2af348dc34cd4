"""Remove every word that lies in a repeated window, with a count-min prefilter and an exact second pass.

A window is ``length`` consecutive words of one document (35), equal when its word sequence is. Both passes speak of
*anchors*: a window's anchor is its 12-word gram of smallest hash (the leftmost of equals), so equal windows have equal
anchors at equal places, one anchor serves a run of neighbouring windows (12 on average), and an anchor occurs at least
as often as each of its windows.

1. *Sketch.* Every partition counts its anchors into a count-min sketch (two rows of 2**26 cells that stop at 2); partition
   sketches travel as their touched cells, are merged per block of cells, and the cells that reached 2 become a bitmap. Its
   size is fixed (16 MB), so it may be broadcast whatever the corpus; a fuller sketch passes more windows and loses none.
2. *Exact pass.* Windows whose anchor is estimated to occur once are unique. The others are hashed (64 bits, inside a bucket
   chosen by another hash of the anchor) and counted exactly: first inside the map task, where windows seen twice are settled and
   leave only one record each, then per bucket. So a passage that a third of all documents share sends one record per map flush, not
   one per document. Anchors that the sketch's sums find hot may stand in ever different surroundings; their windows go to buckets by the
   window's own hash.
3. Spans of repeated windows return to their documents by document bucket and the covered words go.

Defined results: a null text has no words; a text under 35 words loses none; repeated rows are documents of their own (their windows
repeat each other); rows with a null id come back with a null id; an empty table gives no rows. Only id and text are read. A window
counts as equal by 64 bits of hash inside its bucket.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.groups import reliable_checkpoint
from . import rolling as R
from .packing import SPAN, SPAN_SCHEMA, bucket_count, cut, joined, keyed_texts, null_ids, span_rows, spans_by_row

GRAM = 12
ROWS, CELL_BITS, BLOCK_BITS = 2, 26, 18
FLUSH = 1 << 20
HOT, HOT_SHARE, HOT_LOCAL = 1 << 16, 4096, 256  # see repeat_sketch

RUN = np.dtype([("id", "<i8"), ("part", "<i8"), ("db", "<i4"), ("start", "<u4"), ("n", "<u4")])
BUCKET_SCHEMA = "bucket int, twice binary, once binary, runs binary, spans binary"


class _Scan:
    """Anchors and windows of text slices (made once in a worker)."""

    def __init__(self, length: int):
        self.length = length
        self.gram = min(GRAM, length)
        self.words, self.anchor, self.window = R.SpanHash(101), R.SpanHash(102), R.SpanHash(103)

    def slice(self, data, off):
        """Word hashes, anchor index of every window, anchor hashes, which windows lie inside one text, first words."""
        s, e, first = R.find_words(data, off, R.NOT_BLANK)
        wh = self.words.spans(self.words.prefix(data), s, e) if len(s) else np.zeros(0, dtype=np.uint64)
        ah = self.anchor.grams(wh, self.gram)
        at = R.sliding_argmin(ah, self.length - self.gram + 1)
        inside = R.window_starts(first, self.length, len(wh))[: len(at)]
        return wh, at, ah, inside, first


def _cells(ah: np.ndarray):
    """The sketch cells of anchor hashes, one array a row."""
    return [(R.mix(ah + R.U64(0x9E3779B97F4A7C15 * (r + 1) % 2**64)) >> R.U64(64 - CELL_BITS)).astype(np.int64) for r in range(ROWS)]


def repeat_sketch(texts: DataFrame, length: int = 35, hot: int = HOT, hot_local: int = HOT_LOCAL):
    """Bitmap rows (ROWS x 2**CELL_BITS bits) of the cells that count two or more anchors, merged over all partitions; and the hot cells.

    A hot cell of the first row counts ``hot`` anchors and at least one in HOT_SHARE of all, so there are at most HOT_SHARE of them.
    Counts below ``hot_local`` of a worker's flush are left out of that sum: a cell that is rare everywhere is not hot.
    """
    block = 1 << BLOCK_BITS
    n_blocks = 1 << (CELL_BITS - BLOCK_BITS)
    schema = pa.schema([("block", pa.int32()), ("salt", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
    many = pa.schema([*schema, ("cell", pa.int64()), ("n", pa.int64())])

    def frequent(cell, n):
        none = [pa.nulls(len(cell), t) for t in schema.types]
        return pa.record_batch([*none, pa.array(cell, pa.int64()), pa.array(n, pa.int64())], schema=many)

    def flush(found, salt):
        ids, once, twice = [], [], []
        all_ = np.concatenate(found)
        yield frequent([-1], [len(all_)])
        for r, cells in enumerate(_cells(all_)):
            c, n = np.unique(cells, return_counts=True)
            if r == 0:
                yield frequent(c[n >= hot_local], n[n >= hot_local])
            for some, out in ((n < 2, once), (n >= 2, twice)):
                b, (got,) = cut(c[some] >> BLOCK_BITS, (c[some] & (block - 1)).astype(np.uint32))
                ids += (b + r * n_blocks).tolist()
                out += got
                (twice if out is once else once).extend([b""] * len(got))
        none = pa.nulls(len(ids), pa.int64())
        yield pa.record_batch([pa.array(ids, pa.int32()), pa.array([salt] * len(ids), pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary()), none, none], schema=many)

    def scan(batches):
        from pyspark import TaskContext

        salt, sc, found, held = TaskContext.get().partitionId() // 64, _Scan(length), [], 0
        for batch in batches:
            for _, _, data, off in R.text_slices(batch.column(0)):
                _, at, ah, inside, _ = sc.slice(data, off)
                a = ah[np.unique(at[inside])]  # an anchor that serves any window, once per occurrence
                found.append(a)
                held += len(a)
                if held >= FLUSH:
                    yield from flush(found, salt)
                    found, held = [], 0
        if held:
            yield from flush(found, salt)

    def merged(table):
        n = np.bincount(joined(table["once"], np.uint32), minlength=block)
        full = np.bincount(joined(table["twice"], np.uint32), minlength=block)
        return n, full

    def first_merge(table):
        n, full = merged(table)
        two = np.flatnonzero((n >= 2) | (full > 0)).astype(np.uint32)
        one = np.flatnonzero((n == 1) & (full == 0)).astype(np.uint32)
        return pa.table([table["block"][:1], table["salt"][:1], pa.chunked_array([[one.tobytes()]], pa.binary()), pa.chunked_array([[two.tobytes()]], pa.binary())], schema=schema)

    last = pa.schema([("block", pa.int32()), ("bits", pa.binary())])

    def last_merge(table):
        n, full = merged(table)
        bits = np.packbits((n >= 2) | (full > 0), bitorder="little")
        return pa.table([table["block"][:1], pa.chunked_array([[zlib.compress(bits.tobytes(), 1)]], pa.binary())], schema=last)

    x = reliable_checkpoint(texts.select("_text").mapInArrow(scan, "block int, salt int, once binary, twice binary, cell bigint, n bigint"))
    total = x.where("cell = -1").agg(F.sum("n")).first()[0] or 0
    least = max(hot, -(-total // HOT_SHARE))
    cells = x.where("cell >= 0").groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("cell").collect()  # at most HOT_SHARE
    x = x.where("block IS NOT NULL").select("block", "salt", "once", "twice")
    x = x.groupBy("block", "salt").applyInArrow(first_merge, "block int, salt int, once binary, twice binary")
    x = x.groupBy("block").applyInArrow(last_merge, "block int, bits binary")
    bits = np.zeros((ROWS, 1 << (CELL_BITS - 3)), dtype=np.uint8)
    flat = bits.reshape(ROWS * n_blocks, -1)
    for row in x.toLocalIterator():  # ROWS * n_blocks rows of 32 KB at most
        flat[row["block"]] = np.frombuffer(zlib.decompress(row["bits"]), dtype=np.uint8)
    return bits, np.sort(np.array([r["cell"] for r in cells], dtype=np.int64))


def _estimated_twice(bits: np.ndarray, ah: np.ndarray) -> np.ndarray:
    ok = np.ones(len(ah), dtype=bool)
    for r, c in enumerate(_cells(ah)):
        ok &= (bits[r][c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
    return ok


def _spread(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start+1, ... for every run."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n) + np.repeat(starts, n)


def _flagged_spans(runs: np.ndarray, flag: np.ndarray, length: int) -> np.ndarray:
    """Word spans covered by the flagged windows; ``flag`` has one entry per window of each run in order."""
    run = np.repeat(np.arange(len(runs)), runs["n"])
    s, e = R.runs_of(run, flag)
    first = np.cumsum(runs["n"]) - runs["n"]
    out = np.zeros(len(s), dtype=SPAN)
    own = runs[run[s]] if len(s) else runs[:0]
    for c in ("id", "part", "db"):
        out[c] = own[c]
    begin = own["start"].astype(np.int64) + (s - first[run[s]] if len(s) else 0)
    out["start"], out["end"] = begin, begin + (e - s) + length - 1
    return out


def repeated_spans(texts: DataFrame, length: int, buckets: int, hot: int = HOT, hot_local: int = HOT_LOCAL) -> DataFrame:
    """(bucket = document bucket, spans): the word spans that repeated windows cover. ``texts`` as of keyed_texts()."""
    x = candidate_windows(texts, length, buckets, hot, hot_local)
    out_schema = pa.schema([("bucket", pa.int32()), ("spans", pa.binary())])

    def exact(key, table):
        if key[0].as_py() < 0:
            spans = joined(table["spans"], SPAN)
        else:
            runs, once, twice = joined(table["runs"], RUN), joined(table["once"], np.uint64), joined(table["twice"], np.uint64)
            _, inv, n = np.unique(np.concatenate((once, twice)), return_inverse=True, return_counts=True)
            n = n + np.bincount(inv[len(once) :], minlength=len(n))  # a settled window counts twice
            spans = _flagged_spans(runs, n[inv[: len(once)]] >= 2, length)
        return pa.Table.from_batches([span_rows(spans, out_schema)])

    return x.groupBy("bucket").applyInArrow(exact, SPAN_SCHEMA)


def candidate_windows(texts: DataFrame, length: int, buckets: int, hot: int = HOT, hot_local: int = HOT_LOCAL) -> DataFrame:
    """Windows estimated repeated, as packed rows of the bucket where equal ones meet.

    The bucket is the anchor's, which keeps a run of windows in one record. The windows of a hot anchor, which may stand in a third of all
    documents in ever different surroundings, go one by one to the bucket of their own hash: only equal windows share it for sure.
    """
    sketch, hot_cells = repeat_sketch(texts, length, hot, hot_local)
    bits = texts.sparkSession.sparkContext.broadcast(sketch)
    schema = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("twice", "once", "runs", "spans")]])

    def rows(bucket, **cells):
        none = [None] * len(bucket)
        return pa.record_batch([pa.array(bucket, pa.int32()), *[pa.array(cells.get(c, none), pa.binary()) for c in schema.names[1:]]], schema=schema)

    def bucket_of(anchors, is_hot, run_of, h):
        return (np.where(is_hot[run_of], R.mix(h + R.U64(13)), anchors[run_of]) % R.U64(buckets)).astype(np.int32)

    def flush(runs, hashes, anchors, is_hot):
        runs, h, anchors, is_hot = np.concatenate(runs), np.concatenate(hashes), np.concatenate(anchors), np.concatenate(is_hot)
        _, first, inv, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        twice = n[inv] >= 2
        if twice.any():  # settled here; negative buckets carry spans straight to their document bucket
            spans = _flagged_spans(runs, twice, length)
            db, (cells,) = cut(spans["db"], spans)
            yield rows(-1 - db, spans=cells)
            lead = first[n >= 2]
            run_of = np.repeat(np.arange(len(runs)), runs["n"])
            b, (cells,) = cut(bucket_of(anchors, is_hot, run_of[lead], h[lead]), h[lead])
            yield rows(b, twice=cells)
        run_of = np.repeat(np.arange(len(runs)), runs["n"])
        # windows of a hot anchor are runs of their own
        apart = np.where(is_hot[run_of], np.arange(len(run_of)) + len(runs), run_of)
        s, e = R.runs_of(apart, ~twice)
        if len(s):
            part = runs[run_of[s]].copy()
            part["start"] += (s - (np.cumsum(runs["n"]) - runs["n"])[run_of[s]]).astype(np.uint32)
            part["n"] = e - s
            bucket = bucket_of(anchors, is_hot, run_of[s], h[s])
            b, (cells,) = cut(bucket, part)
            _, (hs,) = cut(np.repeat(bucket, e - s), h[_spread(s, e - s)])
            yield rows(b, runs=cells, once=hs)

    def scan(batches):
        sc, table = _Scan(length), bits.value
        runs, hashes, anchors, is_hot, held = [], [], [], [], 0
        for batch in batches:
            ids, part, db = (batch.column(c).to_numpy() for c in range(3))
            for i, _, data, off in R.text_slices(batch.column(3)):
                wh, at, ah, inside, first = sc.slice(data, off)
                if not inside.any():
                    continue
                keep = inside.copy()
                est = np.zeros(len(ah), dtype=bool)
                used = np.unique(at[inside])
                est[used] = _estimated_twice(table, ah[used])
                keep &= est[at]
                s, e = R.runs_of(at, keep)
                if not len(s):
                    continue
                doc = np.searchsorted(first, s, side="right") - 1
                r = np.zeros(len(s), dtype=RUN)
                r["id"], r["part"], r["db"] = ids[i + doc], part[i + doc], db[i + doc]
                r["start"], r["n"] = s - first[doc], e - s
                runs.append(r)
                hashes.append(sc.window.grams(wh, length)[_spread(s, e - s)])
                anchors.append(R.mix(ah[at[s]] + R.U64(7)))
                is_hot.append(np.isin(_cells(ah[at[s]])[0], hot_cells) if len(hot_cells) else np.zeros(len(s), dtype=bool))
                held += len(hashes[-1])
                if held >= FLUSH:
                    yield from flush(runs, hashes, anchors, is_hot)
                    runs, hashes, anchors, is_hot, held = [], [], [], [], 0
        if held:
            yield from flush(runs, hashes, anchors, is_hot)

    return texts.mapInArrow(scan, BUCKET_SCHEMA)


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35, with_text: bool = False, hot: int = HOT, hot_local: int = HOT_LOCAL) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 (and kept_text) of every document."""
    buckets = bucket_count(docs.count())
    texts = keyed_texts(docs, id_col, text_col, buckets)
    spans = repeated_spans(texts, length, buckets, hot, hot_local)
    id_type = dict(docs.dtypes)[id_col]
    schema = f"_id bigint, n_words bigint, n_removed bigint, kept_sha256 string{', kept_text string' if with_text else ''}"

    def apply(left, right):
        by_row = spans_by_row(joined(right["spans"], SPAN))
        ids, part = left["_id"].to_numpy(), left["_part"].to_numpy()
        n_words, n_removed, sha, kept_texts = [], [], [], []
        for k, text in enumerate(left["_text"]):
            words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()  # the same six blanks
            n_words.append(len(words))
            span = by_row.get((int(ids[k]), int(part[k])))
            if span:
                s, e = R.merge_spans(*span)
                kept, at = [], 0
                for a, b in zip(s.tolist(), e.tolist(), strict=True):
                    kept += words[at:a]
                    at = b
                words = kept + words[at:]
            n_removed.append(n_words[-1] - len(words))
            kept = b" ".join(words)
            sha.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                kept_texts.append(kept.decode())
        cols = [null_ids(ids, part), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())]
        names = ["_id", "n_words", "n_removed", "kept_sha256"]
        return pa.table([*cols, *([pa.array(kept_texts, pa.string())] if with_text else [])], names=names + ["kept_text"] * with_text)

    out = texts.groupBy("_db").cogroup(spans.groupBy("bucket")).applyInArrow(apply, schema)
    return out.withColumn("_id", F.col("_id").cast(id_type)).withColumnRenamed("_id", id_col)
