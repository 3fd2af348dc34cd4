"""Phrases whose words occur together more often than apart, counted exactly in counting quotient filters.

Texts are lower-cased (A-Z), cut into pieces at sentence punctuation and line breaks, and pieces into words at blanks. Phrases lie within a piece; all
counts are per language.

1. *Shards.* A worker numbers the words of some MB of texts and writes the texts as those numbers, with one row a distinct (language, word).
2. *Vocabulary.* Words that occur ``min_count`` times get global ids. Rarer words cannot be part of a candidate and become breaks. The ids return
   to their shards by a join: the vocabulary is never broadcast.
3. *Filters.* A shard's n-grams of ids are permuted and stored as counting quotient filters, one a range of the permuted numbers
   (``quotient_filter.py``). A frequent n-gram is one entry a shard, whatever its count.
4. *Merge.* Filters of one range meet, entries are summed, those of ``min_count`` and more give their ids back. The number of ranges follows the number of words.
5. *Scores.* Every cut of a candidate is scored floor(scale * a * a / (l * r)) in DECIMAL(38, 0); parts and longer candidates are joined by id.

Defined results: null texts have no words; a null language is 'und' (and shares it with rows of that language); rows are counted one by one, repeated rows
and repeated ids too; an empty table, and a language without candidates, give no rows. Ties rank by phrase in UTF-8 order. Only the two named columns
are read. Ids of n-grams may take 124 bits together.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.groups import global_row_number, reliable_checkpoint
from ..session import ensure_checkpoint_dir
from . import quotient_filter as Q
from . import rolling as R
from .packing import pack, unpack
from .terms import merge_words, word_codes

# Fixed values of the contract: piece ends and blanks; every other byte belongs to a word.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD = R.byte_class(PIECE_ENDS + b"\x20\x09")
END = ~R.byte_class(PIECE_ENDS)
SHARD_BYTES = 8 << 20
RANGE_ENTRIES = 1 << 20
SCALE = 1_000_000


def write_shards(docs: DataFrame, path: str, lang_col: str, text_col: str, unknown: str) -> DataFrame:
    """The written table: per shard one row with ``pieces`` (local word numbers, 0 between pieces) and one row a (lang, word): local, n."""
    schema = pa.schema(
        [("shard", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("local", pa.int32()), ("n", pa.int64()), ("pieces", pa.binary())]
    )

    def flush(shard, held, langs):
        codes, words = merge_words([h[1] for h in held])
        wide = max(1, len(words))
        key = np.concatenate([h[2] * wide + c[h[0]] for h, c in zip(held, codes, strict=True)])
        new = np.concatenate([h[3] for h in held])
        distinct, local, n = np.unique(key, return_inverse=True, return_counts=True)
        seq = np.zeros(len(key) + int(new.sum()), dtype=np.int32)
        seq[np.arange(len(key)) + np.cumsum(new)] = local + 1
        yield pa.record_batch([pa.array([x], t) for x, t in zip((shard, None, None, None, None, pack(seq)), schema.types, strict=True)], schema=schema)
        lang = pa.array(langs, pa.string()).take(pa.array(distinct // wide))
        word = words.take(pa.array(distinct % wide))
        for i in range(0, len(distinct), 20_000):
            size = min(20_000, len(distinct) - i)
            number = pa.array(np.arange(i + 1, i + size + 1, dtype=np.int32))
            cols = [pa.array(np.full(size, shard)), lang[i : i + size], word[i : i + size], number, pa.array(n[i : i + size]), pa.nulls(size, pa.binary())]
            yield pa.record_batch(cols, schema=schema)

    def scan(batches):
        shard = TaskContext.get().partitionId() << 32
        langs, held, size = {}, [], 0
        for batch in batches:
            lang = np.array([langs.setdefault(x, len(langs)) for x in batch.column(0).to_pylist()], dtype=np.int64)
            for i, j, data, off in R.text_slices(batch.column(1)):
                low = R.LOWER[data]
                s, e, first = R.find_words(low, off, WORD)
                if not len(s):
                    continue
                code, words = word_codes(low, s, e, WORD)
                ends = np.cumsum(END[low])[s]
                new = np.concatenate(([True], ends[1:] != ends[:-1]))
                new[first[:-1][np.diff(first) > 0]] = True
                held.append((code, words, np.repeat(lang[i:j], np.diff(first)), new))
                size += len(data)
                if size >= SHARD_BYTES:
                    yield from flush(shard, held, list(langs))
                    shard, held, size = shard + 1, [], 0
        if held:
            yield from flush(shard, held, list(langs))

    x = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(unknown)).alias("lang"), F.col(text_col).alias("_t"))
    x = x.mapInArrow(scan, "shard bigint, lang string, word string, local int, n bigint, pieces binary")
    x.write.option("parquet.block.size", str(16 << 20)).option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def phrase_counts(shards: DataFrame, vocabulary: DataFrame, size: int, words: int, max_words: int, min_count: int) -> DataFrame:
    """(n, w1 .. w{max_words}, a): all n-grams of vocabulary ids of 2 to ``max_words`` words that occur ``min_count`` times.

    ``size`` is the number of vocabulary words, ``words`` the number of word occurrences (it sets the number of ranges).
    """
    bits = max(1, int(size).bit_length())
    range_bits = max(0, int(words // RANGE_ENTRIES).bit_length())
    packings = {n: Q.Packing(n, bits, range_bits) for n in range(2, max_words + 1)}
    cells = pa.schema([("n", pa.int32()), ("range", pa.int64()), ("cell", pa.binary())])
    found = pa.schema([("n", pa.int32()), *[(f"w{k + 1}", pa.int64()) for k in range(max_words)], ("a", pa.int64())])

    def filters(key, pieces, ids):
        out = []
        for cell in pieces["pieces"].to_pylist():
            seq = unpack(cell, "<i4")
            local, gid = ids["local"].to_numpy(), ids["gid"].to_numpy()
            number = np.zeros(max(int(seq.max(initial=0)), int(local.max(initial=0))) + 1, dtype=np.uint64)
            number[local] = gid
            w = number[seq]
            ok = w > 0
            for n, p in packings.items():
                m = len(w) - n + 1
                if m <= 0:
                    break
                at = np.flatnonzero(reduce(np.logical_and, [ok[k : m + k] for k in range(n)]))
                rows = list(Q.build(p, [w[at + k] for k in range(n)]))
                out.append(pa.record_batch([pa.array([n] * len(rows), pa.int32()), pa.array([r for r, _ in rows], pa.int64()), pa.array([c for _, c in rows], pa.binary())], schema=cells))
        return pa.Table.from_batches(out, schema=cells)

    def meet(key, table):
        n, rng = (k.as_py() for k in key)
        p = packings[n]
        left, right, count = Q.merge(p, rng, table["cell"].to_pylist())
        keep = count >= min_count
        ids = Q.entries(p, left[keep], right[keep])
        cols = [pa.array(i.astype(np.int64)) for i in ids] + [pa.nulls(len(ids[0]), pa.int64())] * (max_words - n)
        return pa.table([pa.array(np.full(len(ids[0]), n, dtype=np.int32)), *cols, pa.array(count[keep])], schema=found)

    ids = shards.where("word IS NOT NULL").select("shard", "lang", "word", "local").join(vocabulary.select("lang", "word", "gid"), ["lang", "word"])
    pieces = shards.where("pieces IS NOT NULL").select("shard", "pieces")
    x = pieces.groupBy("shard").cogroup(ids.select(F.col("shard").alias("own"), "local", "gid").groupBy("own")).applyInArrow(filters, "n int, range bigint, cell binary")
    columns = ", ".join(f"w{k + 1} bigint" for k in range(max_words))
    return x.groupBy("n", "range").applyInArrow(meet, f"n int, {columns}, a bigint")


def _scored(grams: dict, words: DataFrame, n: int, scale: int) -> DataFrame:
    """Candidates of ``n`` words with the parts of their lowest-scoring cut and their words."""
    x = grams[n]
    names = [f"w{k + 1}" for k in range(n)]
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    for k in range(1, n):
        for side, part in (("l", names[:k]), ("r", names[k:])):
            g = grams[len(part)].select(*[F.col(f"w{i + 1}").alias(c) for i, c in enumerate(part)], F.col("a").alias(f"{side}{k}"))
            x = x.join(g, part)
        x = x.withColumn(f"s{k}", F.lit(scale).cast("decimal(7,0)") * (wide("a") * wide("a"))).withColumn(f"d{k}", wide(f"l{k}") * wide(f"r{k}"))
        x = x.withColumn(f"s{k}", F.expr(f"s{k} div d{k}"))
    cuts = [F.struct(F.col(f"s{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, n)]
    x = x.select(*names, "a", (F.least(*cuts) if n > 2 else cuts[0]).alias("cut"))
    for k, c in enumerate(names):
        own = [F.col("gid").alias(c), F.col("word").alias(f"t{k}"), *([F.col("lang")] if k == 0 else [])]
        x = x.join(words.select(*own), c)
    return x.select("lang", *names, F.concat_ws(" ", *[f"t{k}" for k in range(n)]).alias("phrase"), "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", max_words: int = 3, min_count: int = 10, inside_percent: int = 50,
    top: int | None = 2000, scale: int = SCALE, unknown: str = "und", path: str | None = None,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of every language's ``top`` phrases (all with None) of 2 to ``max_words`` words.

    Candidates inside a longer candidate that makes up ``inside_percent`` of their occurrences are dropped. Shards go to ``path``, a
    new folder in the shared checkpoint folder unless given.
    """
    spark = docs.sparkSession
    shards = write_shards(docs, path or f"{ensure_checkpoint_dir(spark)}/shards-{uuid.uuid4().hex}", lang_col, text_col, unknown)
    counts = reliable_checkpoint(shards.where("word IS NOT NULL").groupBy("lang", "word").agg(F.sum("n").alias("a")))
    totals = reliable_checkpoint(counts.groupBy("lang").agg(F.sum("a").alias("n")))
    words = reliable_checkpoint(global_row_number(counts.where(F.col("a") >= min_count), ["lang", "word"], "gid"))
    size, total = words.count(), totals.agg(F.sum("n")).first()[0] or 0
    found = reliable_checkpoint(phrase_counts(shards, words, size, total, max_words, min_count))
    grams = {1: words.select(F.col("gid").alias("w1"), "a")}
    for n in range(2, max_words + 1):
        grams[n] = found.where(F.col("n") == n).select(*[f"w{k + 1}" for k in range(n)], "a")

    kept = []
    for n in range(2, max_words + 1):
        x = _scored(grams, words, n, scale)
        names = [f"w{k + 1}" for k in range(n)]
        inside = [
            grams[m].select(*[F.col(f"w{at + k + 1}").alias(names[k]) for k in range(n)], F.col("a").alias("_long"))
            for m in range(n + 1, max_words + 1)
            for at in range(m - n + 1)
        ]
        if inside:
            longest = reduce(DataFrame.unionByName, inside).groupBy(*names).agg(F.max("_long").alias("_long"))
            x = x.join(longest, names, "left").where(F.expr(f"_long IS NULL OR 100 * _long < {inside_percent} * a"))
        kept.append(x.select("lang", "phrase", "a", "l", "r", "score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    out = reduce(DataFrame.unionByName, kept).withColumn("rank", F.row_number().over(order))
    if top is not None:
        out = out.where(F.col("rank") <= top)
    return out.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
