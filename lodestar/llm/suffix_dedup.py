"""Remove bytes covered by a 50-byte string that also starts in a document of smaller id: suffixes in deep-shallow order.

Sorting every suffix of a corpus would shuffle 50 bytes for every byte of text. Only suffixes that can matter are sorted:

1. *Anchors.* The anchor of a 50-byte window is its 24-byte gram of smallest hash (the leftmost of equals). Equal windows have
   equal anchors at equal places, so windows meet by anchor, and one record stands for a run of neighbouring windows (14 on
   average). A fixed-size count-min sketch of all anchors (merged from partition sketches, 2 x 2**28 cells of two bits, 64 MB to
   broadcast) keeps back anchors that occur once; a fuller sketch keeps back fewer and loses none.
2. *Classes.* Runs of windows with equal bytes (by a 96-bit fingerprint of anchor and run) form a class. All but the occurrences in the class's
   smallest document are covered; that is settled inside the map task first, so a passage in a third of all documents sends one
   record per map flush, then per bucket.
3. *Suffixes.* Where an anchor has several classes in several documents, the bytes of each class's smallest occurrence are fetched, and all
   suffixes that start a window are sorted: multikey quicksort over 8-byte characters to a shallow depth of 32 bytes (all groups of a
   level at once), then a blind trie orders each remaining group of suffixes with a long common prefix. Suffixes of one trie leaf
   agree on all 50 bytes; those not in the leaf's smallest document are covered.
4. Covered spans return to their documents by document bucket.

Defined results: null is the empty text; rows that share an id never cover each other (neither id is smaller); a null id counts as larger than
every other; matches never cross documents; an empty table gives no rows. Only id and text are read.
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
from .packing import NULL_ID, SPAN, bucket_count, cut, keyed_texts, null_ids, pack, spans_by_row, unpack, unpacked

LENGTH, GRAM = 50, 24
SHALLOW_WORDS = 4  # 32 bytes
CELL_BITS, BLOCK_BITS, ROWS = 28, 20, 2
FLUSH = 1 << 20

RUN = np.dtype([("a", "<u4"), ("c", "<u8"), ("id", "<i8"), ("part", "<i8"), ("db", "<i4"), ("start", "<u4"), ("n", "<u1")])
WANT = np.dtype([("a", "<u4"), ("home", "<i4"), ("id", "<i8"), ("part", "<i8"), ("db", "<i4"), ("start", "<u4"), ("n", "<u1")])


def _order(r: np.ndarray) -> np.ndarray:
    """Sort key of the documents: the id, null after all."""
    return np.where(r["part"] >= NULL_ID, np.iinfo(np.int64).max, r["id"])


class _Scan:
    def __init__(self, length: int):
        self.length, self.gram = length, min(GRAM, length)
        self.anchor, self.run = R.SpanHash(301), R.SpanHash(302)

    def slice(self, data, off):
        """Runs of windows with one anchor: (anchor hash, start, windows, run fingerprint maker)."""
        h = self.anchor.grams(data, self.gram)
        at = R.sliding_argmin(h, self.length - self.gram + 1)
        s, e = R.runs_of(at, R.window_starts(off, self.length, len(data))[: len(at)])
        return h[at[s]] if len(s) else h[:0], at, s, e

    def prints(self, data, at, s, e):
        """64-bit fingerprints of the runs' bytes and of the anchor's place in them."""
        place = (at[s] - s).astype(np.uint64)
        return R.mix(self.run.spans(self.run.prefix(data), s, e + self.length - 1) + place * R.U64(0x9E3779B97F4A7C15))


def _cells(ah: np.ndarray):
    return [(R.mix(ah + R.U64(0x9E3779B97F4A7C15 * (r + 3) % 2**64)) >> R.U64(64 - CELL_BITS)).astype(np.int64) for r in range(ROWS)]


def anchor_sketch(texts: DataFrame, length: int) -> np.ndarray:
    """Bitmap rows of the sketch cells that count two or more anchors over all partitions."""
    block, n_blocks = 1 << BLOCK_BITS, 1 << (CELL_BITS - BLOCK_BITS)
    schema = pa.schema([("block", pa.int32()), ("salt", pa.int32()), ("cells", pa.binary())])
    two = np.uint32(1 << 31)

    def rows(block_ids, salt, cells):
        return pa.record_batch([pa.array(block_ids, pa.int32()), pa.array([salt] * len(block_ids), pa.int32()), pa.array(cells, pa.binary())], schema=schema)

    def flush(found, salt):
        for r, cells in enumerate(_cells(np.concatenate(found))):
            c, n = np.unique(cells, return_counts=True)
            b, (got,) = cut(c >> BLOCK_BITS, (c & (block - 1)).astype(np.uint32) | np.where(n > 1, two, np.uint32(0)), cell=pack)
            yield rows(b + r * n_blocks, salt, got)

    def scan(batches):
        from pyspark import TaskContext

        salt, sc, found, held = TaskContext.get().partitionId() // 64, _Scan(length), [], 0
        for batch in batches:
            for _, _, data, off in R.text_slices(batch.column(0), 1 << 20):
                a, at, s, _ = sc.slice(data, off)
                a = a[np.concatenate(([True], np.diff(at[s]) != 0))] if len(s) else a
                found.append(a)
                held += len(a)
                if held >= 2 * FLUSH:
                    yield from flush(found, salt)
                    found, held = [], 0
        if held:
            yield from flush(found, salt)

    def counts(table):
        c = unpacked(table["cells"], np.uint32)
        seen = np.zeros(block, dtype=np.uint8)
        for part, weight in ((c[c < two], 1), (c[c >= two] - two, 2)):
            n = np.bincount(part, minlength=block) * weight
            seen = np.minimum(seen + np.minimum(n, 2), 2).astype(np.uint8)
        return seen

    def first_merge(table):
        seen = counts(table)
        c = np.flatnonzero(seen).astype(np.uint32)
        c |= np.where(seen[c] > 1, two, np.uint32(0))
        return pa.Table.from_batches([rows(table["block"][:1].to_pylist(), table["salt"][0].as_py(), [pack(c)])])

    def last_merge(table):
        bits = np.packbits(counts(table) > 1, bitorder="little")
        return pa.Table.from_batches([rows(table["block"][:1].to_pylist(), 0, [zlib.compress(bits.tobytes(), 1)])])

    kind = "block int, salt int, cells binary"
    x = texts.select("_text").mapInArrow(scan, kind).groupBy("block", "salt").applyInArrow(first_merge, kind)
    x = x.groupBy("block").applyInArrow(last_merge, kind)
    flat = np.zeros((ROWS * n_blocks, block // 8), dtype=np.uint8)
    for row in x.toLocalIterator():  # ROWS * n_blocks rows, 64 MB in all
        flat[row["block"]] = np.frombuffer(zlib.decompress(row["cells"]), dtype=np.uint8)
    return flat.reshape(ROWS, -1)


def merge_rows(spans: np.ndarray) -> np.ndarray:
    """Union of the spans of every row (touching ones merged)."""
    if not len(spans):
        return spans
    o = np.lexsort((spans["start"], spans["part"], spans["id"]))
    x = spans[o]
    new = np.concatenate(([False], (np.diff(x["id"]) != 0) | (np.diff(x["part"]) != 0)))
    base = np.cumsum(new).astype(np.int64) << 33  # apart from each other
    s, e = R.merge_spans(x["start"] + base, x["end"] + base)
    own = np.searchsorted(x["start"] + base, s)
    out = x[own].copy()
    out["start"], out["end"] = s - base[own], e - base[own]
    return out


def _spans(rows: np.ndarray, start, end) -> np.ndarray:
    out = np.zeros(len(rows), dtype=SPAN)
    for c in ("id", "part", "db"):
        out[c] = rows[c]
    out["start"], out["end"] = start, end
    return out


class BlindTrie:
    """Compacted trie that keeps only branching depths and branching bytes; one full comparison places a key.

    A node is [depth, {byte: child}], a leaf is (key, members). Keys of one trie have equal length.
    """

    def __init__(self, key: bytes, member: int):
        self.root = (key, [member])

    def insert(self, key: bytes, member: int) -> None:
        node = self.root
        while type(node) is list:  # descend blindly; where a byte has no branch, any leaf will do
            child = node[1].get(key[node[0]])
            node = child if child is not None else next(iter(node[1].values()))
        other = node[0]
        if other == key:
            node[1].append(member)
            return
        d = 0
        while other[d] == key[d]:
            d += 1
        up, node = None, self.root
        while type(node) is list and node[0] < d:
            up, node = node, node[1][key[node[0]]]
        if type(node) is list and node[0] == d:
            node[1][key[d]] = (key, [member])
            return
        new = [d, {other[d]: node, key[d]: (key, [member])}]
        if up is None:
            self.root = new
        else:
            up[1][key[up[0]]] = new

    def leaves(self):
        """Members of each distinct key, in key order."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if type(node) is list:
                stack += [c for _, c in sorted(node[1].items(), reverse=True)]
            else:
                yield node[1]


def shallow_groups(text: np.ndarray, group: np.ndarray, pos: np.ndarray, doc: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort over 8-byte characters, one character of all groups per level.

    text: bytes with at least 8 * words readable after every position. Returns positions' indexes in suffix order and group
    numbers, of the groups that still hold two suffixes of different documents.
    """
    cols = np.lib.stride_tricks.as_strided(text, shape=(len(text) - 7, 8), strides=(1, 1), writeable=False)
    idx, g = np.arange(len(pos)), group
    for level in range(words + 1):
        if level:
            key = cols[pos[idx] + 8 * (level - 1)].view(">u8").ravel()
            o = np.lexsort((key, g))
            idx, g, key = idx[o], g[o], key[o]
            new = (g[1:] != g[:-1]) | (key[1:] != key[:-1])
        else:
            o = np.argsort(g, kind="stable")
            idx, g = idx[o], g[o]
            new = g[1:] != g[:-1]
        if not len(idx):
            return idx, g
        start = np.flatnonzero(np.concatenate(([True], new)))
        n = np.diff(np.append(start, len(idx)))
        d = doc[idx]
        keep = np.repeat(np.minimum.reduceat(d, start) < np.maximum.reduceat(d, start), n)
        g = np.repeat(np.arange(len(start)), n)[keep]
        idx = idx[keep]
    return idx, g


def repeated_windows(text: np.ndarray, group: np.ndarray, pos: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """Flags of the windows text[pos:pos+length] whose bytes also start in a smaller document of their group."""
    flag = np.zeros(len(pos), dtype=bool)
    words = min(SHALLOW_WORDS, length // 8)
    idx, g = shallow_groups(text, group, pos, doc, words)
    if not len(idx):
        return flag
    raw, depth = text.tobytes(), 8 * words
    start = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
    idx_list, pos_list, doc_list = idx.tolist(), pos[idx].tolist(), doc[idx].tolist()
    for a, b in zip(start.tolist(), np.append(start[1:], len(idx)).tolist(), strict=True):
        trie = None
        for k in range(a, b):
            key = raw[pos_list[k] + depth : pos_list[k] + length]
            if trie is None:
                trie = BlindTrie(key, k)
            else:
                trie.insert(key, k)
        for leaf in trie.leaves():
            if len(leaf) > 1:
                low = min(doc_list[k] for k in leaf)
                for k in leaf:
                    if doc_list[k] > low:
                        flag[idx_list[k]] = True
    return flag


def covered_spans(texts: DataFrame, length: int, buckets: int) -> DataFrame:
    """(bucket = document bucket, spans): packed byte spans that windows of smaller documents cover."""
    bits = texts.sparkSession.sparkContext.broadcast(anchor_sketch(texts, length))
    schema = pa.schema([("bucket", pa.int32()), ("runs", pa.binary()), ("spans", pa.binary())])

    def rows(bucket, runs=None, spans=None):
        none = [None] * len(bucket)
        return pa.record_batch([pa.array(bucket, pa.int32()), pa.array(runs or none, pa.binary()), pa.array(spans or none, pa.binary())], schema=schema)

    def losers(r):
        """Runs in (anchor, class, document) order, and which are not in their class's smallest document."""
        r = r[np.lexsort((r["start"], _order(r), r["c"], r["a"]))]
        first = np.concatenate(([True], (r["a"][1:] != r["a"][:-1]) | (r["c"][1:] != r["c"][:-1])))
        low = _order(r)[np.flatnonzero(first)][np.cumsum(first) - 1]
        return r, _order(r) > low, first

    def flush(found, homes):
        r, home = np.concatenate(found), np.concatenate(homes)
        # the home bucket is a function of the anchor, so it may ride along in the sort as part of it
        o = np.lexsort((r["start"], _order(r), r["c"], r["a"], home))
        r, home = r[o], home[o]
        first = np.concatenate(([True], (r["a"][1:] != r["a"][:-1]) | (r["c"][1:] != r["c"][:-1]) | (home[1:] != home[:-1])))
        lost = _order(r) > _order(r)[np.flatnonzero(first)][np.cumsum(first) - 1]
        if lost.any():
            x = r[lost]
            spans = merge_rows(_spans(x, x["start"], x["start"] + x["n"] + (length - 1)))
            db, (cells,) = cut(spans["db"], spans, cell=pack)
            yield rows(-1 - db, spans=cells)
        b, (cells,) = cut(home[~lost], r[~lost], cell=pack)
        yield rows(b, runs=cells)

    def scan(batches):
        sc, table = _Scan(length), bits.value
        found, homes, held = [], [], 0
        for batch in batches:
            ids, part, db = (batch.column(c).to_numpy() for c in range(3))
            for i, _, data, off in R.text_slices(batch.column(3), 1 << 20):
                a, at, s, e = sc.slice(data, off)
                ok = np.ones(len(a), dtype=bool)
                for row, c in enumerate(_cells(a)):
                    ok &= (table[row][c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
                a, s, e = a[ok], s[ok], e[ok]
                if not len(s):
                    continue
                doc = np.searchsorted(off, s, side="right") - 1
                r = np.zeros(len(s), dtype=RUN)
                m = R.mix(a + R.U64(13))
                r["a"], r["c"] = m & R.U64(0xFFFFFFFF), sc.prints(data, at, s, e)
                r["id"], r["part"], r["db"] = ids[i + doc], part[i + doc], db[i + doc]
                r["start"], r["n"] = s - off[doc], e - s
                found.append(r)
                homes.append(((m >> R.U64(32)) % R.U64(buckets)).astype(np.int32))
                held += len(r)
                if held >= FLUSH:
                    yield from flush(found, homes)
                    found, homes, held = [], [], 0
        if held:
            yield from flush(found, homes)

    out = pa.schema([("db", pa.int32()), ("want", pa.binary()), ("spans", pa.binary())])

    def resolved(want, spans):
        batches = []
        for name, a in (("want", want), ("spans", spans)):
            b, (cells,) = cut(a["db"], a, cell=pack)
            none = [None] * len(b)
            batches.append(pa.record_batch([pa.array(b, pa.int32()), pa.array(cells if name == "want" else none, pa.binary()), pa.array(cells if name == "spans" else none, pa.binary())], schema=out))
        return pa.Table.from_batches(batches, schema=out)

    def settle(key, table):
        bucket = key[0].as_py()
        if bucket < 0:
            return resolved(np.zeros(0, dtype=WANT), merge_rows(unpacked(table["spans"], SPAN)))
        r, lost, first = losers(unpacked(table["runs"], RUN))
        spans = _spans(r[lost], r["start"][lost], r["start"][lost] + r["n"][lost] + (length - 1))
        new = np.concatenate(([True], r["a"][1:] != r["a"][:-1]))
        start, g = np.flatnonzero(new), np.cumsum(new) - 1
        o = _order(r)
        several = (np.bincount(g[first], minlength=len(start)) > 1) & (np.minimum.reduceat(o, start) < np.maximum.reduceat(o, start))
        x = r[several[g] & ~lost]
        want = np.zeros(len(x), dtype=WANT)
        for c in ("a", "id", "part", "db", "start", "n"):
            want[c] = x[c]
        want["home"] = bucket
        return resolved(want, merge_rows(spans))

    found = texts.mapInArrow(scan, "bucket int, runs binary, spans binary").groupBy("bucket").applyInArrow(settle, "db int, want binary, spans binary")
    found = reliable_checkpoint(found)

    fetched = pa.schema([("bucket", pa.int32()), ("meta", pa.binary()), ("bytes", pa.binary())])

    def fetch(left, right):
        want = unpacked(right["want"], WANT)
        if not len(want) or not left.num_rows:
            return fetched.empty_table()
        want = np.unique(want)  # rows repeated with equal texts ask for the same bytes
        want = want[np.lexsort((want["part"], want["id"]))]
        ids, part, text = left["_id"].to_numpy(), left["_part"].to_numpy(), left["_text"]
        at = {(int(i), int(p)): k for k, (i, p) in enumerate(zip(ids, part, strict=True))}
        new = np.concatenate(([True], (np.diff(want["id"]) != 0) | (np.diff(want["part"]) != 0)))
        start = np.flatnonzero(new)
        got = np.empty(len(want), dtype=object)
        for a, b in zip(start.tolist(), np.append(start[1:], len(want)).tolist(), strict=True):
            raw = text[at[(int(want["id"][a]), int(want["part"][a]))]].as_buffer().to_pybytes()
            for k in range(a, b):
                p = int(want["start"][k])
                got[k] = raw[p : p + int(want["n"][k]) + length - 1]
        b, (metas, raws) = cut(want["home"], want, got, cell=lambda a: pack(a) if a.dtype == WANT else pack(np.frombuffer(b"".join(a.tolist()), dtype=np.uint8)))
        return pa.table([pa.array(b, pa.int32()), pa.array(metas, pa.binary()), pa.array(raws, pa.binary())], schema=fetched)

    span_schema = pa.schema([("bucket", pa.int32()), ("spans", pa.binary())])

    def compare(table):
        cells = [(unpack(m, WANT), unpack(t, np.uint8)) for m, t in zip(table["meta"].to_pylist(), table["bytes"].to_pylist(), strict=True)]
        r = np.concatenate([m for m, _ in cells])
        text = np.concatenate([t for _, t in cells] + [np.zeros(8, dtype=np.uint8)])
        n = r["n"].astype(np.int64)
        size = n + length - 1
        begin = np.cumsum(size) - size
        run = np.repeat(np.arange(len(r)), n)
        shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        rank = np.unique(_order(r), return_inverse=True)[1]
        flag = repeated_windows(text, r["a"][run], begin[run] + shift, rank[run], length)
        p = r["start"][run][flag] + shift[flag]
        spans = merge_rows(_spans(r[run[flag]], p, p + length))
        db, (cells,) = cut(spans["db"], spans, cell=pack)
        return pa.table([pa.array(db, pa.int32()), pa.array(cells, pa.binary())], schema=span_schema)

    want = found.where("want IS NOT NULL").select("db", "want")
    more = texts.groupBy("_db").cogroup(want.groupBy("db")).applyInArrow(fetch, "bucket int, meta binary, bytes binary")
    more = more.groupBy("bucket").applyInArrow(compare, "bucket int, spans binary")
    return found.where("spans IS NOT NULL").select(F.col("db").alias("bucket"), "spans").union(more)


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, with_bytes: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the remaining bytes) of every document."""
    buckets = bucket_count(docs.count())
    texts = keyed_texts(docs, id_col, text_col, buckets)
    spans = covered_spans(texts, length, buckets)
    schema = f"_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string{', kept binary' if with_bytes else ''}"

    def apply(left, right):
        by_row = spans_by_row(unpacked(right["spans"], SPAN))
        ids, part = left["_id"].to_numpy(), left["_part"].to_numpy()
        rows = []
        for k, text in enumerate(left["_text"]):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            span, kept, runs = by_row.get((int(ids[k]), int(part[k]))), raw, 0
            if span:
                s, e = R.merge_spans(*span)
                runs = len(s)
                kept = b"".join(raw[a:b] for a, b in zip([0, *e.tolist()], [*s.tolist(), len(raw)], strict=True))
            rows.append((len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest(), *([kept] if with_bytes else [])))
        cols = list(zip(*rows, strict=True)) or [[]] * (5 if with_bytes else 4)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        return pa.table([null_ids(ids, part), *[pa.array(c, t) for c, t in zip(cols, kinds, strict=False)]], names=names[: 1 + len(cols)])

    out = texts.groupBy("_db").cogroup(spans.groupBy("bucket")).applyInArrow(apply, schema)
    return out.withColumn("_id", F.col("_id").cast(dict(docs.dtypes)[id_col])).withColumnRenamed("_id", id_col)
