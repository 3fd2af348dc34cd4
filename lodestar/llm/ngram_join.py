"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters, verified once per pair.

A document's set is its distinct ``n``-word shingles (5); two documents link when 100 * |A & B| >= percent * |A | B| (75).

1. *Classes.* Documents of one lower-cased word sequence are one class (its id: 64 bits of the sequence's MD5). Copies are never paired.
2. *Rarity.* A sketch of 2**20 cells counts the shingles of all documents (fixed size: it may be broadcast). Shingles are ordered
   by (cell count, hash). Any total order gives right results; this one puts frequent shingles last.
3. *Prefixes.* Linked sets share one of the first |A| - ceil(t |A|) + 1 shingles of each. Those entries are grouped by shingle; a
   shingle whose cell count is high is salted, and groups without two classes of fitting length go.
4. *Candidates.* Instead of all pairs of a group, stars: every member is paired with the group's leaders (the smallest under
   two hash orders), under the length and positional filters, then the suffix filter (sets are split at fixed hash pivots; parts of
   unequal parity bound the distance of the sets). A pair is verified once, on the texts. Classes that link get one label.
5. *Rest.* After that only members of one group with *different* labels may hide a link: all such pairs are
   verified. So no link between components is lost, while a large group of near copies costs a few stars.

Output: one row a document with its set size and the smallest doc_id that it reaches. Defined results: null or empty texts (no word)
have an empty set and stay alone; shorter texts than n words have one shingle, the whole sequence; repeated rows link with each other; a
null id counts only if its component has no other (the component is then null); an empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.groups import reliable_checkpoint
from . import rolling as R
from .components import connected_components
from .packing import NULL_ID, bucket_count, cut, joined, keyed_texts, row_part

CELL_BITS = 20
BLOCKS = 64
BITMAP_BITS = 26
PARTS = 512
HOT = 4096
FLUSH = 1 << 18
KEPT = 50_000  # shingles of texts that a verifying task keeps
SALTED = 1 << 31  # flag in ``pos``: the shingle's entries lie in several buckets

ENTRY = np.dtype([("h", "<u4"), ("cls", "<i8"), ("n", "<u4"), ("pos", "<u4")])


class _Sets:
    """Shingle sets of text slices (made once in a worker)."""

    def __init__(self, n: int):
        self.n, self.words, self.gram = n, R.SpanHash(201), R.SpanHash(202)

    def slice(self, data, off):
        """Per text of the slice: (sorted distinct shingle hashes, lower-cased word sequence as bytes)."""
        low = R.LOWER[data]
        s, e, first = R.find_words(low, off, R.NOT_BLANK)
        wh = self.words.spans(self.words.prefix(low), s, e) if len(s) else np.zeros(0, dtype=np.uint64)
        grams = self.gram.grams(wh, self.n)
        raw = low.tobytes()
        for k in range(len(off) - 1):
            a, b = int(first[k]), int(first[k + 1])
            seq = b" ".join(raw[off[k] : off[k + 1]].split())
            if b - a >= self.n:
                yield np.unique(grams[a : b - self.n + 1]), seq
            elif b > a:
                yield self.gram.grams(wh[a:b], b - a), seq
            else:
                yield grams[:0], seq


def class_id(seq: bytes) -> int:
    return int.from_bytes(hashlib.md5(seq, usedforsecurity=False).digest()[:8], "little", signed=True)


def _parities(h: np.ndarray) -> np.ndarray:
    """Whether the set has an odd number of shingles between each two of PARTS fixed hash pivots, as 64-bit words."""
    odd = np.bincount((h >> R.U64(55)).astype(np.int64), minlength=PARTS) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def _scan_classes(texts: DataFrame, n: int) -> DataFrame:
    """One pass: kind 0 rows (_id, _part, cls, n, bits) and kind 1 rows (block number as _id, counts of the sketch)."""
    types = "kind int, _id bigint, _part bigint, cls bigint, n int, bits array<bigint>, cells binary"

    def rows(kind, ids, part, cls, size, bits, cells):
        lists = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(bits)), PARTS // 64).cast(pa.list_(pa.int64()))
        cols = [pa.array([kind] * len(ids), pa.int32()), pa.array(ids, pa.int64()), pa.array(part, pa.int64()), pa.array(cls, pa.int64()), pa.array(size, pa.int32()), lists, pa.array(cells, pa.binary())]
        return pa.record_batch(cols, names=["kind", "_id", "_part", "cls", "n", "bits", "cells"])

    def scan(batches):
        sets, cells = _Sets(n), np.zeros(1 << CELL_BITS, dtype=np.uint32)
        for batch in batches:
            ids, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, j, data, off in R.text_slices(batch.column(3)):
                found = list(sets.slice(data, off))
                cls = [class_id(seq) if len(h) else None for h, seq in found]
                all_ = np.concatenate([h for h, _ in found])
                cells += np.bincount((all_ >> R.U64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells)).astype(np.uint32)
                yield rows(0, ids[i:j], part[i:j], cls, [len(h) for h, _ in found], [_parities(h) for h, _ in found], [None] * (j - i))
        if cells.any():
            blocks = cells.reshape(BLOCKS, -1)
            none = [None] * BLOCKS
            yield rows(1, range(BLOCKS), none, none, none, [np.zeros(PARTS // 64 * BLOCKS, dtype=np.int64)], [zlib.compress(b.tobytes(), 1) for b in blocks])

    return reliable_checkpoint(texts.mapInArrow(scan, types))


def _merged_cells(scanned: DataFrame) -> np.ndarray:
    """Shingle counts per cell over all documents (2**20 numbers; sums travel in 64 blocks, first per salt)."""

    def add(table):
        total = np.zeros((1 << CELL_BITS) // BLOCKS, dtype=np.uint64)
        for x in table["cells"].to_pylist():
            got = zlib.decompress(x)
            total += np.frombuffer(got, dtype=np.uint32 if len(got) == total.nbytes // 2 else np.uint64)
        return pa.table({"_id": table["_id"][:1], "salt": table["salt"][:1], "cells": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    kind = "_id bigint, salt int, cells binary"
    x = scanned.where("kind = 1").select("_id", F.pmod(F.xxhash64("cells"), F.lit(16)).cast("int").alias("salt"), "cells")
    x = x.groupBy("_id", "salt").applyInArrow(add, kind).withColumn("salt", F.lit(0)).groupBy("_id", "salt").applyInArrow(add, kind)
    cells = np.zeros((BLOCKS, (1 << CELL_BITS) // BLOCKS), dtype=np.uint64)
    for row in x.toLocalIterator():
        cells[row["_id"]] = np.frombuffer(zlib.decompress(row["cells"]), dtype=np.uint64)
    return cells.reshape(-1)


def prefix_size(n: int, percent: int) -> int:
    return n - (-(-percent * n // 100)) + 1


def _entries(texts: DataFrame, cells: np.ndarray, n: int, percent: int, buckets: int) -> DataFrame:
    """Rows (gid, cls, n, pos): prefix entries of shingles that two classes of fitting length share."""
    order = texts.sparkSession.sparkContext.broadcast(cells)
    schema = pa.schema([("bucket", pa.int64()), ("rows", pa.binary())])

    def flush(bs, rows):
        b, (cells_,) = cut(np.concatenate(bs), np.concatenate(rows))
        return pa.record_batch([pa.array(b, pa.int64()), pa.array(cells_, pa.binary())], schema=schema)

    def scan(batches):
        sets, count = _Sets(n), order.value
        bs, rows, held = [], [], 0
        for batch in batches:
            for _, _, data, off in R.text_slices(batch.column(3)):
                for h, seq in sets.slice(data, off):
                    if not len(h) or seq.count(b" ") + 1 < n:
                        continue  # too short to link with anything but its copies
                    c = count[(h >> R.U64(64 - CELL_BITS)).astype(np.int64)]
                    first = np.lexsort((h, c))[: prefix_size(len(h), percent)]
                    cls = class_id(seq)
                    salts = R.U64(1) + c[first] // R.U64(HOT)  # the cell count bounds the group's size
                    mixed = R.mix(h[first] + R.U64(11))
                    r = np.zeros(len(first), dtype=ENTRY)
                    r["h"], r["cls"], r["n"], r["pos"] = mixed & R.U64(0xFFFFFFFF), cls, len(h), np.arange(len(first))
                    r["pos"][salts > 1] |= SALTED
                    base = (mixed >> R.U64(32)) % R.U64(buckets)
                    bs.append((base + R.U64(buckets) * (R.U64(cls & (2**64 - 1)) % salts)).astype(np.int64))
                    rows.append(r)
                    held += len(r)
                if held >= FLUSH:
                    yield flush(bs, rows)
                    bs, rows, held = [], [], 0
        if held:
            yield flush(bs, rows)

    return _alive(texts.mapInArrow(scan, "bucket bigint, rows binary"), percent, buckets)


def _alive(shuffled: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Entries of groups in which a neighbour by set size fits; salted groups are kept whole."""
    out = pa.schema([("gid", pa.int64()), ("cls", pa.int64()), ("n", pa.int32()), ("pos", pa.int32())])

    def keep(key, table):
        r = joined(table["rows"], ENTRY)
        r = r[np.lexsort((r["cls"], r["n"], r["h"]))]
        new = np.concatenate(([True], (r["h"][1:] != r["h"][:-1]) | (r["cls"][1:] != r["cls"][:-1])))[: len(r)]
        r = r[new]
        fit = (r["h"][1:] == r["h"][:-1]) & (100 * r["n"][:-1].astype(np.int64) >= percent * r["n"][1:].astype(np.int64))
        ok = r["pos"] >= SALTED
        ok[1:] |= fit
        ok[:-1] |= fit
        r = r[ok]
        r["pos"] &= SALTED - 1
        gid = (np.int64(key[0].as_py() % buckets) << 32) | r["h"].astype(np.int64)
        return pa.table([pa.array(gid), pa.array(r["cls"]), pa.array(r["n"].astype(np.int32)), pa.array(r["pos"].astype(np.int32))], schema=out)

    return shuffled.groupBy("bucket").applyInArrow(keep, "gid bigint, cls bigint, n int, pos int")


def key_bitmap(keys: DataFrame, col: str = "k") -> np.ndarray:
    """2**26 bits, set at a hash of every BIGINT key: a fixed-size set that may hold more than was put in."""
    block = 1 << 18
    schema = pa.schema([("block", pa.int32()), ("bits", pa.binary())])

    def mark(k):
        return (R.mix(k.astype(np.int64).view(np.uint64)) >> R.U64(64 - BITMAP_BITS)).astype(np.int64)

    def scan(batches):
        bits = np.zeros(1 << (BITMAP_BITS - 3), dtype=np.uint8)
        for b in batches:
            at = mark(b.column(0).to_numpy())
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        byte = np.flatnonzero(bits)
        at = (byte[:, None] * 8 + np.arange(8))[np.unpackbits(bits[byte, None], axis=1, bitorder="little").astype(bool)]
        b, (cells,) = cut(at // block, (at % block).astype(np.uint32))
        yield pa.record_batch([pa.array(b, pa.int32()), pa.array(cells, pa.binary())], schema=schema)

    def merge(table):
        bits = np.zeros(block, dtype=bool)
        bits[joined(table["bits"], np.uint32)] = True
        return pa.table([table["block"][:1], pa.chunked_array([[zlib.compress(np.packbits(bits).tobytes(), 1)]], pa.binary())], schema=schema)

    out = np.zeros((1 << BITMAP_BITS) // block * (block // 8), dtype=np.uint8).reshape(-1, block // 8)
    x = keys.select(col).mapInArrow(scan, "block int, bits binary").groupBy("block").applyInArrow(merge, "block int, bits binary")
    for row in x.toLocalIterator():  # 256 rows of at most 32 KB
        out[row["block"]] = np.frombuffer(zlib.decompress(row["bits"]), dtype=np.uint8)
    return out.reshape(-1)


def _in_bitmap(bits: np.ndarray, k: np.ndarray) -> np.ndarray:
    c = (R.mix(k.astype(np.int64).view(np.uint64)) >> R.U64(64 - BITMAP_BITS)).astype(np.int64)
    return (bits[c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 == 1


def _row_key(i, p):
    return F.xxhash64(i, p)


def _verify(texts: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link, exactly: suffix filter, then the texts' own shingles.

    Only texts named by a surviving pair (by a fixed-size bitmap of row keys) are shuffled, compressed.
    """
    side = lambda c: classes.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"s{c}"), F.col("rep._id").alias(f"i{c}"), F.col("rep._part").alias(f"p{c}"))
    x = pairs.join(side("a"), "a").join(side("b"), "b")
    x = x.where(_near("sa", "na", "sb", "nb", percent))
    x = reliable_checkpoint(x.select("a", "b", "ia", "pa", "ib", "pb"))
    keys = x.select(_row_key("ia", "pa").alias("k")).union(x.select(_row_key("ib", "pb").alias("k")))
    bits = texts.sparkSession.sparkContext.broadcast(key_bitmap(keys))
    schema = pa.schema([("_id", pa.int64()), ("_part", pa.int64()), ("z", pa.binary())])

    def pick(batches):
        z = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            text = batch.column(3)
            at = np.flatnonzero(_in_bitmap(bits.value, batch.column(2).to_numpy()))
            got = []
            for i in at:
                raw = R.LOWER[np.frombuffer(text[i].as_buffer(), dtype=np.uint8)].tobytes() if text[i].is_valid else b""
                got.append(z.compress(b" ".join(raw.split())))
            yield pa.record_batch([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(got, pa.binary())], schema=schema)

    t = texts.select("_id", "_part", _row_key("_id", "_part").alias("k"), "_text").mapInArrow(pick, "_id bigint, _part bigint, z binary")
    x = x.join(t.select(F.col("_id").alias("ia"), F.col("_part").alias("pa"), F.col("z").alias("za")), ["ia", "pa"])
    x = x.join(t.select(F.col("_id").alias("ib"), F.col("_part").alias("pb"), F.col("z").alias("zb")), ["ib", "pb"])
    link_schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def shingles(z, cache, key):
        if key not in cache:
            if sum(map(len, cache.values())) > KEPT:
                cache.clear()
            w = zstandard.ZstdDecompressor().decompress(z).split(b" ")
            cache[key] = set(zip(*(w[k:] for k in range(n)), strict=False))
        return cache[key]

    def check(batches):
        cache = {}
        for batch in batches:
            a, b, za, zb = (batch.column(k).to_pylist() for k in range(4))
            ok = []
            for k in range(len(a)):
                u, v = shingles(za[k], cache, a[k]), shingles(zb[k], cache, b[k])
                both = len(u & v)
                ok.append(100 * both >= percent * (len(u) + len(v) - both))
            yield pa.record_batch([batch.column(0).filter(pa.array(ok, pa.bool_())), batch.column(1).filter(pa.array(ok, pa.bool_()))], schema=link_schema)

    return reliable_checkpoint(x.select("a", "b", "za", "zb").mapInArrow(check, "a bigint, b bigint").distinct())


def _near(b1, n1, b2, n2, percent: int):
    """Suffix filter. Between two hash pivots, sets of unequal parity differ by a shingle at least, so the parities that
    differ bound the sets' Hamming distance from below; linked sets have at most (1-t)/(1+t) (n1+n2)."""
    differ = sum((F.bit_count(F.col(b1)[k].bitwiseXOR(F.col(b2)[k])) for k in range(1, PARTS // 64)), F.bit_count(F.col(b1)[0].bitwiseXOR(F.col(b2)[0])))
    return (100 + percent) * differ <= (100 - percent) * (F.col(n1) + F.col(n2))


def _fits(n1, p1, n2, p2, percent: int):
    """Length filter, and the overlap still possible after the shared shingle at positions p1, p2."""
    n1, p1, n2, p2 = (F.col(c).cast("bigint") for c in (n1, p1, n2, p2))
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & (
        (100 + percent) * (1 + F.least(n1 - p1 - 1, n2 - p2 - 1)) >= percent * (n1 + n2)
    )


def _ordered(a, b):
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _labelled(entries: DataFrame, labels: DataFrame) -> DataFrame:
    lab = labels.select(F.col("node").alias("cls"), F.col("label").alias("_l"))
    return entries.join(lab, "cls", "left").withColumn("label", F.coalesce("_l", "cls")).drop("_l")


def _mixed_groups(entries: DataFrame) -> DataFrame:
    """Entries (with label) of the groups that still hold more than one label."""
    g = reliable_checkpoint(entries.groupBy("gid").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 < l1").select("gid"))
    return entries.join(g, "gid")


def linked_classes(texts: DataFrame, classes: DataFrame, entries: DataFrame, n: int, percent: int, leaders: int = 2) -> DataFrame:
    """(node, label) of the classes that have a link."""
    seeds = [F.min(F.struct(F.xxhash64("cls", F.lit(k)).alias("o"), "cls", "n", "pos")) for k in range(leaders)]
    lead = entries.groupBy("gid").agg(F.array_distinct(F.array(*seeds)).alias("l"))
    lead = reliable_checkpoint(lead.select("gid", F.explode("l").alias("l")).select("gid", F.col("l.cls").alias("lc"), F.col("l.n").alias("ln"), F.col("l.pos").alias("lp")))
    star = entries.join(lead, "gid").where((F.col("cls") != F.col("lc")) & _fits("n", "pos", "ln", "lp", percent))
    done = reliable_checkpoint(star.select(*_ordered("cls", "lc")).distinct())
    links = _verify(texts, classes, done, n, percent)
    labels = connected_components(links)
    e = reliable_checkpoint(_mixed_groups(_labelled(entries, labels)))
    # pairs of one label need no check: members of a group's most frequent label only meet the others
    most = e.groupBy("gid", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("gid").agg(F.max(F.struct("c", "label")).alias("m"))
    most = reliable_checkpoint(most.select("gid", F.col("m.label").alias("top")))
    e = e.join(most, "gid").join(classes.select("cls", "bits"), "cls")
    # sets that can link lie in neighbouring length classes
    e = e.withColumn("lc", F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent + 0.01))).cast("int"))
    side = lambda c: [F.col("cls").alias(f"c{c}"), F.col("label").alias(f"l{c}"), F.col("n").alias(f"n{c}"), F.col("pos").alias(f"p{c}"), F.col("bits").alias(f"b{c}")]
    left = e.where("label <> top").select("gid", "top", *side("a"), F.explode(F.array(F.col("lc") - 1, F.col("lc"), F.col("lc") + 1)).alias("lc"))
    right = e.select("gid", "lc", *side("b"))
    once = (F.col("lb") == F.col("top")) | (F.col("ca") < F.col("cb"))
    rest = left.join(right, ["gid", "lc"]).where(
        (F.col("la") != F.col("lb")) & once & _fits("na", "pa", "nb", "pb", percent) & _near("ba", "na", "bb", "nb", percent)
    )
    rest = reliable_checkpoint(rest.select(*_ordered("ca", "cb")).distinct().join(done, ["a", "b"], "left_anti"))
    if rest.isEmpty():
        return labels
    return connected_components(links.union(_verify(texts, classes, rest, n, percent)))


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 75) -> DataFrame:
    """id, n_shingles, component_id of every row, _part (of its text, to tell rows of one id apart) and _label.

    ``_label`` is the component itself (null for texts without words); its ``component_id`` is null for every component of
    null ids and may be shared where one id has several texts.
    """
    buckets = bucket_count(docs.count())
    texts = keyed_texts(docs, id_col, text_col, buckets)
    scanned = _scan_classes(texts, n)
    rows = scanned.where("kind = 0").select("_id", "_part", "cls", "n", "bits")
    cells = _merged_cells(scanned)
    classes = reliable_checkpoint(
        rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min(F.struct("_id", "_part")).alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    )
    entries = reliable_checkpoint(_entries(texts, cells, n, percent, buckets))
    labels = linked_classes(texts, classes, entries, n, percent)
    x = rows.select("_id", "_part", "cls", "n")
    lab = labels.select(F.col("node").alias("cls"), F.col("label"))
    x = x.join(lab, "cls", "left").withColumn("cls", F.coalesce("label", "cls")).drop("label")
    real = F.when(F.col("_part") < F.lit(NULL_ID), F.col("_id"))
    comp = reliable_checkpoint(x.where("cls IS NOT NULL").groupBy("cls").agg(F.min(real).alias("component")))
    x = x.join(comp, "cls", "left")
    t = dict(docs.dtypes)[id_col]
    return x.select(
        real.cast(t).alias(id_col), F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("cls").isNull(), real).otherwise(F.col("component")).cast(t).alias("component_id"), "_part", F.col("cls").alias("_label"),
    )


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does: the one of the smallest id (a null id is the largest).

    Among repeated rows of that id, the row of the smallest text hash stays. Texts without words all stay.
    """
    c = near_duplicate_components(docs, id_col, text_col, n, percent).select(F.col(id_col).alias("_i"), "_part", "_label")
    first = c.where("_label IS NOT NULL").groupBy("_label").agg(F.min(F.struct(F.col("_i").isNull().alias("o"), F.col("_i").alias("i"), F.col("_part").alias("p"))).alias("k"))
    keep = first.select(F.col("k.i").alias("__ki"), F.col("k.p").alias("__kp"))
    part = row_part(F.col(text_col), F.col(id_col).isNull())
    has_word = F.coalesce(F.length(F.translate(F.col(text_col), " \t\n\x0b\x0c\r", "")) > 0, F.lit(False))
    x = docs.select(*docs.columns, part.alias("__dp"), has_word.alias("__dw"))
    worded = x.where("__dw").join(keep, F.col(id_col).eqNullSafe(F.col("__ki")) & (F.col("__dp") == F.col("__kp")), "left_semi")
    worded = worded.dropDuplicates(["__dp", id_col])
    return worded.union(x.where("NOT __dw")).select(*docs.columns)
