"""Mix sources to target weights: token blocks, multinomial counts per output shard, index permutations.

1. *Targets.* Sources in code-point order (null last) carry the weights 5, 2, 1, repeating. They share the words of
   all documents by weight; a target stops at ``max_repeat`` times its source's words and the excess is shared anew
   by weight among the others until none is above.
2. *Blocks.* A source's words, its documents in a pseudorandom order, are cut into blocks of ``block_len`` words (the
   last may be short). A document's place is a running total inside (source, salt) plus the salt's offset: the number
   of salts grows with the rows, so a source with a third of all rows is still many window groups.
3. *Draws.* Every output shard draws its source counts from a multinomial over the slots' shares, seeded by the shard.
   What a source drew beyond its slots is handed, by index, to the sources that drew too few, so every source gets
   exactly its number of slots.
4. *Permutations.* Slot k of a source takes block ``perm(k mod blocks)`` of a keyed permutation that changes with every
   pass ``k div blocks``: within a pass no block comes twice, so no block comes more than ``max_repeat`` times.
5. *Join.* Slots and the documents' pieces meet on (source, block).

What reaches the driver is one row a source (at most ``MAX_SOURCES``, else an error); that table is also what is broadcast.
Draws, permutations and order depend only on the data and ``seed``: reruns and recomputed partitions agree.

Defined results: null or empty text has size 0 and is never taken; an all-empty source has target 0; a null source is a
source; repeated rows are documents of their own; a null id sorts like any other value; an empty table gives no rows. Only
the three named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.groups import reliable_checkpoint

# Fixed values of the contract.
WEIGHTS = (5.0, 2.0, 1.0)
WORD = r"[^\x20\x09-\x0D]+"
MAX_SOURCES = 100_000


def share_targets(sizes, weights, max_repeat: float = 3.0) -> np.ndarray:
    """Share sum(sizes) by weight, no target above max_repeat times its size; excess is shared anew by weight."""
    s, w = np.asarray(sizes, dtype=float), np.asarray(weights, dtype=float)
    cap, out, open_ = max_repeat * s, np.zeros(len(s)), np.ones(len(s), dtype=bool)
    while open_.any():
        level = (s.sum() - cap[~open_].sum()) / w[open_].sum()
        over = open_ & (w * level > cap)
        if not over.any():
            out[open_] = w[open_] * level
            break
        out[over] = cap[over]
        open_ &= ~over
    return np.minimum(out, cap)


def slot_counts(sizes, targets, block_len: int, max_repeat: int = 3):
    """Blocks and slots of each source: whole passes over all blocks, then the nearest number of single blocks."""
    s = np.asarray(sizes, dtype=np.int64)
    blocks = -(-s // block_len)
    passes = np.where(s > 0, np.floor(np.asarray(targets) / np.maximum(s, 1) + 1e-12), 0).astype(np.int64)
    rest = np.rint((targets - passes * s) / np.minimum(block_len, np.maximum(s, 1))).astype(np.int64)
    slots = passes * blocks + np.clip(rest, 0, blocks)
    return blocks, np.minimum(slots, max_repeat * blocks)


def _mix(x: np.ndarray, key) -> np.ndarray:
    x = (x ^ np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1 (balanced Feistel network, walking until the value is below n)."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)

    def rounds(x):
        left, right = x >> half, x & mask
        for r in range(4):
            left, right = right, left ^ (_mix(right, (key * 4 + r) & ((1 << 64) - 1)) & mask)
        return (left << half) | right

    x = rounds(index.astype(np.uint64))
    while (out := x >= np.uint64(n)).any():
        x[out] = rounds(x[out])
    return x.astype(np.int64)


@dataclass
class Mix:
    """sizes: _id, _source, _tie, _occ, src, size, start, source_size, target. slots: shard, src, block. pieces: src, start, block, at, words, times."""

    sizes: DataFrame
    slots: DataFrame
    pieces: DataFrame


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_len: int = 64,
    shard_slots: int = 8192,
    max_repeat: int = 3,
    seed: int = 17,
    salt_rows: int = 4_000,
) -> Mix:
    spark = docs.sparkSession
    rows = reliable_checkpoint(
        docs.select(
            F.col(id_col).alias("_id"),
            F.col(source_col).alias("_source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            F.xxhash64(F.col(text_col)).alias("_tie"),
        )
    )
    per = rows.groupBy("_source").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"))
    per = per.limit(MAX_SOURCES + 1).collect()
    if len(per) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: mix by a coarser column")
    per = sorted(per, key=lambda r: (r["_source"] is None, str(r["_source"]).encode()))
    sizes = np.array([r["s"] for r in per], dtype=np.int64)
    weights = np.array([WEIGHTS[i % len(WEIGHTS)] for i in range(len(per))])
    targets = share_targets(sizes, weights, max_repeat) if len(per) else np.zeros(0)
    blocks, slots = slot_counts(sizes, targets, block_len, max_repeat)
    schema = f"src int, _source {dict(rows.dtypes)['_source']}, source_size bigint, target double"
    # from Arrow: a list of rows would start Python workers of another kind on the executors
    cols = [pa.array(range(len(per)), pa.int32()), pa.array([r["_source"] for r in per]), pa.array(sizes), pa.array(targets, pa.float64())]
    table = spark.createDataFrame(pa.table(cols, names=["src", "_source", "source_size", "target"]), schema)
    b = F.broadcast(table.withColumnRenamed("_source", "_bsource"))  # at most MAX_SOURCES rows
    n_salts = max(1, -(-sum(r["n"] for r in per) // salt_rows))
    x = rows.join(b, F.col("_source").eqNullSafe(F.col("_bsource"))).drop("_bsource")
    x = x.withColumn("_salt", F.pmod(F.xxhash64("_id", "_tie", F.lit(seed)), F.lit(n_salts)))
    w = Window.partitionBy("src", "_salt").orderBy("_id", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    occ = F.row_number().over(Window.partitionBy("src", "_salt", "_id", "_tie").orderBy("_id"))
    x = x.withColumn("_end", F.sum("size").over(w)).withColumn("_occ", occ)
    salts = rows.join(b, F.col("_source").eqNullSafe(F.col("_bsource")))
    salts = salts.groupBy("src", F.pmod(F.xxhash64("_id", "_tie", F.lit(seed)), F.lit(n_salts)).alias("_salt"))
    salts = salts.agg(F.sum("size").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy("src").orderBy("_salt")) - F.col("_sum")
    x = x.join(salts.select("src", "_salt", before.alias("_before")), ["src", "_salt"])
    x = x.withColumn("start", F.col("_before") + F.col("_end") - F.col("size")).drop("_salt", "_end", "_before")

    slot_rows = _draw(spark, blocks, slots, shard_slots, seed)
    times = slot_rows.groupBy("src", "block").agg(F.count(F.lit(1)).alias("times"))
    length = F.lit(block_len)
    piece = x.where("size > 0").select(
        "src", "start", "size",
        F.explode(F.sequence(F.floor(F.col("start") / length), F.floor((F.col("start") + F.col("size") - 1) / length))).alias("block"),
    )
    lo = F.greatest(F.col("start"), F.col("block") * length)
    hi = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * length)
    # the planner takes the slots for as small as the few rows they are drawn from: a merge join, never a broadcast
    pieces = piece.select("src", "start", "block", (lo - F.col("start")).alias("at"), (hi - lo).alias("words")).join(
        times.hint("merge"), ["src", "block"]
    )
    return Mix(x, slot_rows, pieces)


def _draw(spark, blocks: np.ndarray, slots: np.ndarray, shard_slots: int, seed: int) -> DataFrame:
    """Rows (shard, src, block), one for every slot of the mix."""
    total = int(slots.sum())
    n_shards = -(-total // shard_slots)
    if not total:
        return spark.createDataFrame([], "shard bigint, src int, block bigint")
    share = slots / total

    def counts(batches):
        for pdf in batches:
            for shard in pdf["id"]:
                n = min(shard_slots, total - shard * shard_slots)
                c = np.random.Generator(np.random.PCG64([seed, int(shard)])).multinomial(n, share)
                src = np.flatnonzero(c)
                yield pd.DataFrame({"shard": np.int64(shard), "src": src.astype(np.int32), "n": c[src]})

    drawn = spark.range(n_shards).mapInPandas(counts, "shard bigint, src int, n bigint")
    got = np.zeros(len(slots), dtype=np.int64)
    for r in drawn.groupBy("src").agg(F.sum("n").alias("n")).collect():  # one row a source
        got[r["src"]] = r["n"]
    surplus, lack = np.maximum(got - slots, 0), np.maximum(slots - got, 0)
    surplus_at, lack_at = np.cumsum(surplus) - surplus, np.cumsum(lack)
    first = F.sum("n").over(Window.partitionBy("src").orderBy("shard")) - F.col("n")

    def place(batches):
        for pdf in batches:
            for shard, src, n, k0 in zip(pdf["shard"], pdf["src"], pdf["n"], pdf["k0"], strict=True):
                k = np.arange(k0, k0 + n, dtype=np.int64)
                own = k < slots[src]
                s = np.full(n, src, dtype=np.int64)
                given = surplus_at[src] + k[~own] - slots[src]  # index among all slots handed on
                to = np.searchsorted(lack_at, given, side="right")
                s[~own] = to
                k[~own] = got[to] + given - (lack_at[to] - lack[to])
                block = np.empty(n, dtype=np.int64)
                for one in np.unique(s):
                    for turn in np.unique(k[s == one] // blocks[one]):
                        here = (s == one) & (k // blocks[one] == turn)
                        key = (seed * 1_000_003 + int(one)) * 8 + int(turn)
                        block[here] = permute(k[here] - turn * blocks[one], int(blocks[one]), key)
                yield pd.DataFrame({"shard": np.int64(shard), "src": s.astype(np.int32), "block": block})

    # a drawn row is up to shard_slots slots: spread the few rows over all tasks
    drawn = drawn.withColumn("k0", first).repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return drawn.mapInPandas(place, "shard bigint, src int, block bigint")


def taken_words(mix: Mix, id_col: str = "doc_id") -> DataFrame:
    """id, size, source_size, target, taken: the words of each document that the mix takes, repeats counted."""
    t = mix.pieces.groupBy("src", "start").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    t = t.withColumn("size0", F.lit(False))
    x = mix.sizes.withColumn("size0", F.col("size") == 0)  # rows without words share a start with their successor
    return x.join(t, ["src", "start", "size0"], "left").select(
        F.col("_id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")
    )


def mixed_documents(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as documents: each row's text becomes its taken words (pass after pass, joined by one space).

    A row meets its pieces by id, source, text hash and its number among the rows that agree in all three.
    Rows of which nothing is taken go. Other columns stay as they are; an ``n_chars`` column is counted anew.
    """
    piece = F.struct("at", "words", "times")
    t = mix.pieces.groupBy("src", "start").agg(F.array_sort(F.collect_list(piece)).alias("_pieces"))
    keyed = mix.sizes.where("size > 0").join(t, ["src", "start"]).select(
        F.col("_id").alias("__kid"), F.col("_source").alias("__ksource"), F.col("_tie").alias("__ktie"), F.col("_occ").alias("__kocc"), F.col("_pieces").alias("__pieces")
    )
    x = docs.select(*docs.columns, F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), F.xxhash64(F.col(text_col)).alias("__tie"))
    x = x.withColumn("__occ", F.row_number().over(Window.partitionBy("__id", "__source", "__tie").orderBy("__id")))
    same = F.col("__id").eqNullSafe(F.col("__kid")) & F.col("__source").eqNullSafe(F.col("__ksource")) & (F.col("__tie") == F.col("__ktie")) & (F.col("__occ") == F.col("__kocc"))
    x = x.join(keyed, same)
    pieces = F.col("__pieces")

    def passes(w):
        return F.transform(
            F.sequence(F.lit(0), F.array_max(F.transform(pieces, lambda p: p["times"])) - 1),
            lambda r: F.flatten(
                F.transform(F.filter(pieces, lambda p: p["times"] > r), lambda p: F.slice(w, (p["at"] + 1).cast("int"), p["words"].cast("int")))
            ),
        )

    # the words are bound to a lambda variable: as a column they would be cut anew for every piece
    words = F.array(F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)))
    x = x.withColumn("__text", F.transform(words, lambda w: F.array_join(F.flatten(passes(w)), " "))[0])
    out = []
    for c in docs.columns:
        if c == text_col:
            out.append(F.col("__text").alias(c))
        elif c == "n_chars":
            out.append(F.length("__text").cast(dict(docs.dtypes)[c]).alias(c))
        else:
            out.append(F.col(c))
    return x.select(*out)
