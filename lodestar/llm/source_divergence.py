"""How far the term distributions of a language's sources lie apart, by hash-consed segment trees over term ids.

Terms are runs of letters and non-ASCII characters, A-Z lower-cased. A language keeps the terms of at least ``min_docs`` of its documents; every
(language, source) group gives each kept term p = 1 + floor(10^9 (count + 1) / (N + V)).

1. *Counts.* Every worker counts (group, term) over many texts before the shuffle; partial sums follow.
2. *Trees.* Kept terms get dense ids, frequent ones first. ``block`` consecutive ids are a subtree; one task holds the subtrees of two
   tiles of at most ``tile`` sources. A node is named by its two children (a leaf by its count), so identical count subtrees are one
   node whichever source or place they belong to: the empty tail of a small source is one node a level.
3. *Traversal.* All pairs of sources of the two tiles descend together, level by level. Equal (pair, node, node) triples merge and carry their
   number, so each is expanded once and each pair of counts is priced once, however often it occurs; prices are exact integers.
4. *Terms.* The same descent with the language's tree finds the terms that a source over-uses; a block sends the 200 best (and their ties).

Sums of the blocks give a pair's divergence. Nothing is broadcast, no task holds more than two tiles of one block, and the work of a block does not
depend on how many documents a source has.

Defined results: null texts, languages and sources are ''; every row is a document, repeated rows too, whatever its id; a group without terms has count 0
everywhere; a language without kept terms has divergence 0 for all its pairs and no terms; an empty table gives no rows; a language's only source has
no pairs. Ties rank by item in UTF-8 order. Only the three named columns are read, so other columns may have any names. Counts are exact up to
N + V < 9 * 10^15.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.groups import global_row_number, reliable_checkpoint
from . import rolling as R
from .terms import merge_words, summed, word_codes

#: letters of ASCII and every byte of a non-ASCII character
LETTER = R.byte_class(bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
SCALE = 10**9
BLOCK = 2048
TILE = 32
FLUSH = 1 << 20  # counted (group, term) entries held by a worker
SLICE = 4 << 20
LANGUAGE = -1  # the place of the language's own tree among its sources


# ---------------------------------------------------------------- counts


def _slice_counts(data, off, group):
    """(group * words + code, documents, occurrences) and the distinct words of a slice; ``group`` has one number a text."""
    low = R.LOWER[data]
    s, e, first = R.find_words(low, off, LETTER)
    code, words = word_codes(low, s, e, LETTER)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    key, n = summed(doc * max(1, len(words)) + code, np.ones(len(code), dtype=np.int64))
    doc, code = key // max(1, len(words)), key % max(1, len(words))
    return group[doc], code, np.ones(len(key), dtype=np.int64), n, words


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, df, n): documents with the term and its occurrences, partial sums a worker."""
    types = "lang string, source string, term string, df bigint, n bigint"

    def flush(held, names):
        codes, words = merge_words([h[4] for h in held])
        wide = max(1, len(words))
        key = np.concatenate([h[0] * wide + c[h[1]] for h, c in zip(held, codes, strict=True)])
        key, df, n = summed(key, np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held]))
        g, code = key // wide, key % wide
        lang, source = (pa.array([x[k] for x in names], pa.string()).take(pa.array(g)) for k in range(2))
        for i in range(0, len(key), 50_000):
            j = slice(i, i + 50_000)
            cols = [lang[j], source[j], words.take(pa.array(code[j])), pa.array(df[j]), pa.array(n[j])]
            yield pa.record_batch(cols, names=["lang", "source", "term", "df", "n"])

    def scan(batches):
        names, held, size = {}, [], 0
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            group = np.array([names.setdefault(p, len(names)) for p in pairs], dtype=np.int64)
            for i, j, data, off in R.text_slices(batch.column(2), SLICE):
                held.append(_slice_counts(data, off, group[i:j]))
                size += len(held[-1][0])
                if size >= FLUSH:
                    yield from flush(held, list(names))
                    held, size = [], 0
        if size:
            yield from flush(held, list(names))

    none = F.lit("")
    x = docs.select(*[F.coalesce(F.col(c).cast("string"), none).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "_t"))])
    return x.mapInArrow(scan, types).groupBy("lang", "source", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))


# ---------------------------------------------------------------- trees


def consed_trees(counts: np.ndarray):
    """Hash-consed segment trees of the rows of ``counts`` (trees x a power of two leaves).

    Returns the distinct counts (the leaves' nodes), per level from the leaves up the children (left, right) of its distinct nodes, and the
    root node of every row. Two subtrees of a level have one node exactly if their leaves are equal.
    """
    leaf, ids = np.unique(counts, return_inverse=True)
    ids, levels = ids.reshape(counts.shape).astype(np.int64), []
    while ids.shape[1] > 1:
        wide = int(ids.max()) + 1
        node, above = np.unique(ids[:, ::2] * wide + ids[:, 1::2], return_inverse=True)
        levels.append((node // wide, node % wide))
        ids = above.reshape(len(ids), -1).astype(np.int64)
    return leaf, levels, ids[:, 0]


def meet(levels, root_a: np.ndarray, root_b: np.ndarray):
    """Simultaneous descent of many pairs of trees: (pair, leaf node a, leaf node b, times), ordered by pair, each triple once."""
    pair, a, b, times = np.arange(len(root_a)), root_a, root_b, np.ones(len(root_a), dtype=np.int64)
    for left, right in reversed(levels):
        wide = int(max(left.max(), right.max())) + 1
        kids = [(pair * wide + side[a]) * wide + side[b] for side in (left, right)]
        key, times = summed(np.concatenate(kids), np.concatenate((times, times)))
        pair, rest = np.divmod(key, wide * wide)
        a, b = np.divmod(rest, wide)
    return pair, a, b, times


def mass(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / total) in 64 bits: the quotient's digits by thousands."""
    whole, rest = np.divmod(count + 1, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _block(sid, total, tile, counts, pos, size: int, own_tiles: bool, top: int):
    """Sums of one block: pairs (a, b, value) and, for a diagonal tile, terms (a, place, value).

    Leaves beyond the block's ``size`` terms only fill the trees; they are taken off the pair of two counts of 0.
    """
    leaf, levels, root = consed_trees(counts)
    group = np.flatnonzero(sid != LANGUAGE)
    g = group[np.argsort(sid[group], kind="stable")]
    if own_tiles:
        a, b = np.triu_indices(len(g), 1)
    else:
        first = np.flatnonzero(tile[g] == tile[g].min())
        second = np.flatnonzero(tile[g] != tile[g].min())
        a, b = np.repeat(first, len(second)), np.tile(second, len(first))
    a, b = g[a], g[b]
    out_a, out_b, out_v = [], [], []
    if len(a):
        pair, la, lb, times = meet(levels, root[a], root[b])
        times = times - (counts.shape[1] - size) * ((leaf[la] == 0) & (leaf[lb] == 0))
        p, q = mass(leaf[la], total[a[pair]]), mass(leaf[lb], total[b[pair]])
        at = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        for x, y, v in ((a, b, price(p, q)), (b, a, price(q, p))):
            out_a.append(sid[x])
            out_b.append(sid[y])
            out_v.append(np.add.reduceat(v * times, at))
    terms = []
    if own_tiles:
        lang = int(np.flatnonzero(sid == LANGUAGE)[0])
        pair, la, lb, _ = meet(levels, root[g], np.full(len(g), root[lang]))
        p, q = mass(leaf[la], total[g[pair]]), mass(leaf[lb], total[np.full(len(pair), lang)])
        over = (leaf[la] > 0) & (p > q)
        value = np.where(over, price(p, q), -1)
        wide = len(leaf)
        key = (pair * wide + la) * wide + lb  # ascending
        leaf_of = np.searchsorted(leaf, counts)
        for k, row in enumerate(g):
            at = np.flatnonzero(counts[row])
            v = value[np.searchsorted(key, (k * wide + leaf_of[row, at]) * wide + leaf_of[lang, at])]
            at, v = at[v >= 0], v[v >= 0]
            if len(v) > top:
                few = v >= np.partition(v, len(v) - top)[len(v) - top]
                at, v = at[few], v[few]
            terms.append((np.full(len(at), sid[row]), at + pos, v))
    return out_a, out_b, out_v, terms


def _trees(base: DataFrame, terms_a_block: int, top: int) -> DataFrame:
    """(lang, a, b, term, value): the blocks' sums for pairs (term null) and their best terms (b null)."""
    schema = pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("term", pa.int64()), ("value", pa.int64())])

    def task(key, table):
        lang, block, ti, tj = (k.as_py() for k in key)
        sid, total, tile = (table[c].to_numpy().astype(np.int64) for c in ("sid", "total", "tile"))
        cell = table["cells"].combine_chunks()
        counts = np.zeros((len(sid), terms_a_block), dtype=np.int64)
        flat = cell.flatten()
        row = np.repeat(np.arange(len(sid)), np.asarray(cell.value_lengths().fill_null(0)))
        counts[row, flat.field("pos").to_numpy()] = flat.field("n").to_numpy()
        pos = block * terms_a_block
        a, b, v, terms = _block(sid, total, tile, counts, pos, min(terms_a_block, table["v"][0].as_py() - pos), ti == tj, top)
        out = []
        if a:
            n = sum(map(len, a))
            out.append([pa.array(np.concatenate(x)) for x in (a, b)] + [pa.nulls(n, pa.int64()), pa.array(np.concatenate(v))])
        if terms:
            s, t, w = (np.concatenate(x) for x in zip(*terms, strict=True))
            out.append([pa.array(s), pa.nulls(len(s), pa.int64()), pa.array(t), pa.array(w)])
        batches = [pa.record_batch([pa.array([lang] * len(c[0]), pa.string()), *c], schema=schema) for c in out]
        return pa.Table.from_batches(batches, schema=schema)

    return base.groupBy("lang", "block", "ti", "tj").applyInArrow(task, "lang string, a bigint, b bigint, term bigint, value bigint")


# ---------------------------------------------------------------- operator


def source_divergence(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = 3, top: int = 200,
    block: int = BLOCK, tile: int = TILE,
) -> DataFrame:
    """lang, source, part, item, value, rank: divergence of each source from its language's others (``pair``) and its ``top`` over-used terms.

    ``block`` terms (a power of two) and two tiles of ``tile`` sources meet in one task.
    """
    if block < 2 or block & (block - 1):
        raise ValueError("block must be a power of two")
    counts = reliable_checkpoint(term_counts(docs, lang_col, source_col, text_col))
    kept = counts.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("n")).where(F.col("df") >= min_docs)
    kept = reliable_checkpoint(global_row_number(kept, ["lang", F.col("n").desc(), "term"], "at"))
    none = F.lit("")
    groups = docs.select(F.coalesce(F.col(lang_col).cast("string"), none).alias("lang"), F.coalesce(F.col(source_col).cast("string"), none).alias("source")).distinct()
    groups = reliable_checkpoint(global_row_number(groups, ["lang", "source"], "at"))
    langs = groups.groupBy("lang").agg(F.min("at").alias("s0"), F.count(F.lit(1)).alias("sources"))
    size = kept.groupBy("lang").agg(F.min("at").alias("t0"), F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_n"))
    langs = reliable_checkpoint(
        langs.join(size, "lang", "left").select("lang", "s0", "sources", "t0", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_n", F.lit(0)).alias("lang_n"))
    )
    groups = groups.join(langs, "lang").select("lang", "source", (F.col("at") - F.col("s0")).alias("sid"), "sources", "v")
    terms = kept.join(langs.select("lang", "t0"), "lang").select("lang", "term", (F.col("at") - F.col("t0")).alias("tid"), "n")
    used = counts.join(terms.select("lang", "term", "tid"), ["lang", "term"]).join(groups.select("lang", "source", "sid"), ["lang", "source"])
    used = reliable_checkpoint(used.select("lang", "sid", "tid", "n").unionByName(terms.select("lang", F.lit(LANGUAGE).cast("bigint").alias("sid"), "tid", "n")))

    # one row a (tree, block), also where the source has none of the block's terms
    totals = used.groupBy("lang", "sid").agg(F.sum("n").alias("own"))
    trees = groups.select("lang", "sid", "sources", "v").unionByName(langs.select("lang", F.lit(LANGUAGE).cast("bigint").alias("sid"), "sources", "v"))
    trees = trees.where("v > 0").join(totals, ["lang", "sid"], "left")
    trees = trees.select("lang", "sid", (F.coalesce("own", F.lit(0)) + F.col("v")).alias("total"), "sources", "v", F.explode(F.expr(f"sequence(0L, (v - 1) div {block})")).alias("block"))
    cells = used.groupBy("lang", "sid", F.expr(f"tid div {block}").alias("block")).agg(
        F.collect_list(F.struct(F.expr(f"cast(tid % {block} AS int)").alias("pos"), "n")).alias("cells")
    )
    base = trees.join(cells, ["lang", "sid", "block"], "left")
    tiles = F.expr(f"sequence(0L, (sources - 1) div {tile})")
    base = base.withColumn("tile", F.expr(f"CASE WHEN sid < 0 THEN -1L ELSE sid div {tile} END")).withColumn("u", F.explode(tiles))
    base = base.withColumn("ti", F.expr("CASE WHEN sid < 0 THEN u ELSE least(tile, u) END")).withColumn("tj", F.expr("CASE WHEN sid < 0 THEN u ELSE greatest(tile, u) END"))
    found = reliable_checkpoint(_trees(base.select("lang", "block", "ti", "tj", "sid", "total", "tile", "v", "cells"), block, top))

    names = groups.select("lang", "sid", "source")
    sums = found.where("term IS NULL").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = groups.select("lang", F.col("sid").alias("a"), F.explode(F.expr("sequence(0L, sources - 1)")).alias("b")).where("a <> b")
    pairs = pairs.join(sums, ["lang", "a", "b"], "left").select("lang", "a", "b", F.coalesce("value", F.lit(0)).cast("bigint").alias("value"))
    pairs = pairs.join(names.select("lang", F.col("sid").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    pairs = pairs.select("lang", "a", F.lit("pair").alias("part"), "item", "value")
    best = found.where("term IS NOT NULL").join(terms.select("lang", F.col("tid").alias("term"), F.col("term").alias("item")), ["lang", "term"])
    best = best.select("lang", "a", F.lit("term").alias("part"), "item", "value")
    order = Window.partitionBy("lang", "a", "part").orderBy(F.col("value").desc(), "item")
    both = [x.withColumn("rank", F.row_number().over(order)) for x in (pairs, best)]
    out = both[0].unionByName(both[1].where(F.col("rank") <= top))
    out = out.join(names.withColumnRenamed("sid", "a"), ["lang", "a"])
    return out.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
