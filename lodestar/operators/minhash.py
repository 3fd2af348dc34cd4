"""Sets, MinHash signatures and exact Jaccard similarity on long (set_id, element) tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MERSENNE_31, decimal_linear_hash, linear_hash, safe_div
from .block_overlap import block_overlaps, distinct_arrays
from .groups import pairs_in_groups, reliable_checkpoint
from .text import content_slices

# The hash given with the exercise, h(x) = ((37*x + 126) % p) % N + 1.
GIVEN_HASH = (37, 126)
# The large primes of the single-set signature, 10**15 + 223 for the given hash
# and 10**15 + 37, 10**15 + 91, 10**15 + 159, 10**15 + 187 for the four drawn ones.
LARGE_PRIMES = (10**15 + 223, 10**15 + 37, 10**15 + 91, 10**15 + 159, 10**15 + 187)


def _draw(label: str, modulus: int) -> int:
    return int(hashlib.md5(label.encode()).hexdigest()[:15], 16) % modulus


def hash_family(num_hashes: int, seed: int = 7, p: int = MERSENNE_31) -> list[tuple[int, int]]:
    """K pairs (a, b) with a in [1, p-1], b in [0, p-1]: the given hash first, the rest drawn from md5(seed, k).

    Drawing from md5 makes the family the same on every machine and in the SQL twin.
    """
    fam = [GIVEN_HASH]
    for k in range(1, num_hashes):
        fam.append((1 + _draw(f"{seed}:a:{k}", p - 1), _draw(f"{seed}:b:{k}", p)))
    return fam[:num_hashes]


def large_prime_family(seed: int = 7, upper: int = 10**12) -> list[tuple[int, int, int]]:
    """(a, b, p): the given hash with p = 10**15 + 223, then four with a, b drawn in [0, upper]."""
    fam = [(GIVEN_HASH[0], GIVEN_HASH[1], LARGE_PRIMES[0])]
    for i, p in enumerate(LARGE_PRIMES[1:], start=1):
        fam.append((_draw(f"{seed}:A:{i}", upper + 1), _draw(f"{seed}:B:{i}", upper + 1), p))
    return fam


def set_elements(df: DataFrame, set_col: str = "set_id", element: str = "element") -> DataFrame:
    """Standard form: one row per distinct (set_id, element)."""
    return df.select(F.col(set_col).alias("set_id"), F.col(element).cast("bigint").alias("element")).dropDuplicates(
        ["set_id", "element"]
    )


def signature_arrays(
    sets: DataFrame, hashes: Sequence[tuple[int, int]], p: int = MERSENNE_31, n: int | None = None, digest: bool = False, elements: Callable | None = None, parts: bool = False
) -> DataFrame:
    """(set_id, sig ARRAY<BIGINT>): per set, min over elements of each hash ((a*x+b) % p) % n + 1.

    One aggregate with K min() columns keyed by set: one hash-table lookup per element row, partial
    aggregation before the shuffle, no K-fold row explosion. Empty sets have no rows (their signature
    would be +infinity everywhere). ``digest`` adds the number of elements ``n`` and a column ``digest`` (see ``digest_columns``) from the
    same aggregate: equal signatures say that two sets are similar, equal digests that they are equal.

    With ``elements``, ``sets`` is (set_id, content), a whole set in one row, and nothing is shuffled: ``elements`` makes a list of contents into one array of
    distinct BIGINTs each, in the task that has the row. Long rows of a set whose elements are spread over all partitions would instead ship a
    partial signature from each of them. With ``parts``, several rows of a set hold disjoint elements, and their signatures are merged.
    """
    if elements is not None:
        sig = _row_signatures(sets, hashes, p, n, elements)
        if parts:
            mins = [F.min(F.col("sig")[i]).alias(f"_h{i}") for i in range(len(hashes))]
            sums = [F.sum("digest._dn").alias("_dn"), *[F.bit_xor(f"digest._d{k}").alias(f"_d{k}") for k in range(2)]]
            sig = sig.groupBy("set_id").agg(*mins, *sums).select("set_id", F.array(*[F.col(f"_h{i}") for i in range(len(hashes))]).alias("sig"), _digest())
        return sig.select("set_id", "sig", *([F.col("digest._dn").alias("n"), "digest"] if digest else []))
    mins = [F.min(linear_hash(F.col("element"), a, b, p, n)).alias(f"_h{i}") for i, (a, b) in enumerate(hashes)]
    agg = sets.groupBy("set_id").agg(*mins, *(digest_columns() if digest else []))
    sig = F.array(*[F.col(f"_h{i}") for i in range(len(hashes))]).alias("sig")
    return agg.select("set_id", sig, *([F.col("_dn").alias("n"), _digest()] if digest else []))


def _mixed(x, seed: int):
    """A 64-bit hash of every element (the finalizer of splitmix64)."""
    z = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _row_signatures(sets: DataFrame, hashes: Sequence[tuple[int, int]], p: int, n: int | None, elements: Callable) -> DataFrame:
    """(set_id, sig, digest) of every row (set_id, content) that has an element; the digest is that of ``digest_columns`` with other hashes."""
    if p >= 2**31:
        raise ValueError("products of larger primes do not fit 64 bits")
    family = [(a % p, b % p) for a, b in hashes]

    def signed(batches):
        for batch in batches:
            for at, contents in content_slices(batch["content"]):
                part = batch.slice(at, len(contents))
                own = elements(contents)
                some = [i for i, x in enumerate(own) if len(x)]
                if not some:
                    continue
                size = np.array([len(own[i]) for i in some], dtype=np.int64)
                first = np.cumsum(size) - size
                # each distinct element of the slice is hashed once
                x, number = np.unique(np.concatenate([own[i] for i in some]), return_inverse=True)
                sig, small = np.empty((len(some), len(family)), dtype=np.int64), x % p
                for k, (a, b) in enumerate(family):
                    h = (a * small + b) % p
                    h = (h if n is None or n >= p else h % n) + 1
                    sig[:, k] = np.minimum.reduceat(h[number], first)
                xors = [np.bitwise_xor.reduceat(_mixed(x, k)[number], first).view(np.int64) for k in range(2)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * len(family)), pa.array(sig.ravel()))
                digests = pa.StructArray.from_arrays([pa.array(size), *[pa.array(v) for v in xors]], names=["_dn", "_d0", "_d1"])
                yield pa.RecordBatch.from_arrays([part["set_id"].take(pa.array(some)), lists, digests], names=["set_id", "sig", "digest"])

    rows = sets.select(F.col("set_id").cast("bigint").alias("set_id"), "content")
    return rows.mapInArrow(signed, "set_id bigint, sig array<bigint>, digest struct<_dn: bigint, _d0: bigint, _d1: bigint>")


def digest_columns() -> list:
    """Aggregates that name a set by its elements: their number and the XOR of two 64-bit hashes of each.

    They do not depend on the order of the elements and have partial sums, so no task holds a large set.
    """
    h = [F.bit_xor(F.xxhash64("element", F.lit(k))).alias(f"_d{k}") for k in range(2)]
    return [F.count(F.lit(1)).alias("_dn"), *h]


def _digest():
    return F.struct("_dn", "_d0", "_d1").alias("digest")


def set_digests(sets: DataFrame) -> DataFrame:
    """(set_id, digest) of every set."""
    return sets.groupBy("set_id").agg(*digest_columns()).select("set_id", _digest())


def set_copies(sets: DataFrame) -> DataFrame:
    """(set_id, representative) of every set: the smallest set_id with the same elements.

    ``sets`` is (set_id, element), or (set_id, digest) that is already written. The representatives are written before the join, so that
    the join of a large group of copies is split.
    """
    d = sets.select("set_id", "digest") if "digest" in sets.columns else reliable_checkpoint(set_digests(sets))
    rep = reliable_checkpoint(d.groupBy("digest").agg(F.min("set_id").alias("representative")))
    return d.join(rep, "digest").select("set_id", "representative")


def signatures_long(sig: DataFrame) -> DataFrame:
    """Signature matrix cells (set_id, k, h)."""
    return sig.select("set_id", F.posexplode("sig").alias("k", "h"))


def large_prime_signatures(sets: DataFrame, family: Sequence[tuple[int, int, int]], salts: int = 16) -> DataFrame:
    """Per set, min of ((a + x*b) % p) % N + 1 with N = the size of the set, in DECIMAL(38,0).

    N comes from a written aggregate joined back on set_id (so that the join of a huge set is split), then
    len(family) min() columns, first per (set, salt) and then per set. Output (set_id, k, h).
    """
    size = reliable_checkpoint(sets.groupBy("set_id").agg(F.count(F.lit(1)).alias("_n")))
    x = sets.join(size, "set_id").withColumn("_salt", F.pmod(F.xxhash64("element"), F.lit(salts)))
    x = x.repartition(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "set_id", "_salt")
    mins = [F.min(decimal_linear_hash(F.col("element"), a, b, p, F.col("_n"))).alias(f"_h{i}") for i, (a, b, p) in enumerate(family)]
    part = x.groupBy("set_id", "_salt").agg(*mins)
    agg = part.groupBy("set_id").agg(*[F.min(f"_h{i}").alias(f"_h{i}") for i in range(len(family))])
    return agg.select("set_id", F.posexplode(F.array(*[F.col(f"_h{i}") for i in range(len(family))])).alias("k", "h"))


def jaccard_pairs(sets: DataFrame, tile_rows: int = 2048) -> DataFrame:
    """Exact Jaccard of every pair of sets sharing at least one element (set_a < set_b).

    Intersection = shared elements of the pair (hot elements split into tiles), union = |A| + |B| - |A n B|; sizes travel with the sets, so that no pair is shuffled.
    Pairs without a shared element have Jaccard 0 and are not listed.
    """
    size = reliable_checkpoint(sets.groupBy("set_id").agg(F.count(F.lit(1)).alias("_n")))
    p = pairs_in_groups(sets.join(size, "set_id"), "element", "set_id", ["_n"], tile_rows=tile_rows, reduce=lambda lo, hi, first: [lo[0][first], hi[0][first]], reduced="na bigint, nb bigint")
    union = F.col("na") + F.col("nb") - F.col("n_common")
    return p.select(
        F.col("lo").alias("set_a"), F.col("hi").alias("set_b"), F.col("n_common").alias("intersection"), union.alias("union_size"), safe_div(F.col("n_common"), union).alias("jaccard")
    )


def pair_overlap(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(set_a, set_b, intersection, union_size) of the given pairs: each meets the elements of its two sets, row by row, so a set may be of any size."""
    a = pairs.join(sets.select(F.col("set_id").alias("set_a"), "element"), "set_a")
    b = sets.select(F.col("set_id").alias("set_b"), "element", F.lit(1).alias("_hit"))
    inter = a.join(b, ["set_b", "element"], "left").groupBy("set_a", "set_b").agg(F.count("_hit").alias("intersection"))
    size = sets.groupBy("set_id").agg(F.count(F.lit(1)).alias("_n"))
    out = (
        pairs.join(inter, ["set_a", "set_b"], "left")
        .join(size.select(F.col("set_id").alias("set_a"), F.col("_n").alias("_na")), "set_a", "left")
        .join(size.select(F.col("set_id").alias("set_b"), F.col("_n").alias("_nb")), "set_b", "left")
    )
    i = F.coalesce(F.col("intersection"), F.lit(0))
    union = F.coalesce(F.col("_na"), F.lit(0)) + F.coalesce(F.col("_nb"), F.lit(0)) - i
    return out.select("set_a", "set_b", i.alias("intersection"), union.alias("union_size"))


def pair_jaccard(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Exact Jaccard for the given (set_a, set_b) pairs only (0 for two empty sets)."""
    o = pair_overlap(sets, pairs)
    return o.select("set_a", "set_b", F.coalesce(safe_div(F.col("intersection"), F.col("union_size")), F.lit(0.0)).alias("jaccard"))


def named_sets(pairs: DataFrame) -> DataFrame:
    """(set_id) of every set that a pair names."""
    return pairs.select(F.explode(F.array("set_a", "set_b")).alias("set_id")).distinct()


def array_overlap(arrays: DataFrame, pairs: DataFrame, total: int, tile_elements: int = 1 << 24, elements: Callable | None = None) -> DataFrame:
    """(set_a, set_b, intersection, union_size) of the given pairs from (set_id, elements ARRAY<BIGINT>, distinct elements).

    Blocks of sets of about ``tile_elements`` elements are held while the others pass by (``block_overlap``). ``total`` is the number of elements of all named sets.
    Sets without an array are empty; of several arrays of one
    set the union counts. With ``elements`` the sets are (set_id, content), and their arrays are made where they meet:
    a text is several times smaller than its shingles' ids.
    """
    contents = arrays if elements else arrays.select("set_id", F.col("elements").alias("content"))
    o = block_overlaps(contents, pairs, int(total), elements or distinct_arrays, block_elements=tile_elements)
    return o.select("set_a", "set_b", "intersection", "union_size")


def signature_agreement(sig: DataFrame, pairs: DataFrame) -> DataFrame:
    """Share of signature rows on which the two sets of each pair agree (arrays zipped per pair, no explode)."""
    a = sig.select(F.col("set_id").alias("set_a"), F.col("sig").alias("_sa"))
    b = sig.select(F.col("set_id").alias("set_b"), F.col("sig").alias("_sb"))
    j = pairs.join(a, "set_a").join(b, "set_b")
    eq = F.aggregate(F.zip_with("_sa", "_sb", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, v: s + v)
    return j.select("set_a", "set_b", (eq / F.size("_sa")).alias("signature_similarity"))
