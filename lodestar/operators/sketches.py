"""Stream moments (exact and AMS) and Bloom filters (sizing, build, probe) as DataFrame jobs."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import md5_hex_int
from .groups import reliable_checkpoint

# Fixed value: ln 2, the optimal-k factor of a Bloom filter.
LN2 = math.log(2)


def exact_moments(stream: DataFrame, element: str, ks: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """F_k = sum over distinct elements of count^k as DECIMAL(38,0): partial counts per element, then one global sum."""
    c = stream.groupBy(element).agg(F.count(F.lit(1)).alias("_c"))
    return c.agg(*[power_sum(F.col("_c"), k).alias(f"f{k}") for k in ks])


def power_sum(c: Column, k: int) -> Column:
    """sum(c^k), exact: products in DECIMAL(38,0), which holds the cube of a count of 10^12."""
    power = F.lit(1).cast("decimal(38,0)")
    for _ in range(k):
        power = (power * c.cast("decimal(38,0)")).cast("decimal(38,0)")
    return F.sum(power).cast("decimal(38,0)")


def ams_choice(sample: Column, pos: Column) -> Column:
    """Uniform h(sample, pos) in (0, 1) from the first 13 hex digits of md5('sample:pos').

    52 bits, exact in a double: a position is a candidate with probability 1 / pos up to 2**52.
    """
    key = F.concat_ws(":", sample.cast("string"), pos.cast("string"))
    return (md5_hex_int(key, 13).cast("double") + F.lit(0.5)) / F.lit(float(16**13))


def ams_samples(stream: DataFrame, element: str, pos: str, v: int) -> DataFrame:
    """Each of the v variables takes the last position p with h(s, p) * p < 1: the reservoir rule, so the
    chosen position is uniform over the stream without knowing its length. Positions start at 1.

    Expected candidates per variable ~ ln n, so the v-fold generate is filtered right away in the same
    stage; the result has v rows. Variables are numbered 1..v. Output (sample, t, el).
    """
    s = stream.select(F.col(pos).alias("_p"), F.col(element).alias("_el"), F.explode(F.sequence(F.lit(1), F.lit(v))).alias("sample"))
    cand = s.where(ams_choice(F.col("sample"), F.col("_p")) * F.col("_p") < 1.0)
    return cand.groupBy("sample").agg(F.max(F.struct("_p", "_el")).alias("_x")).select(
        "sample", F.col("_x._p").alias("t"), F.col("_x._el").alias("el")
    )


def ams_moment(stream: DataFrame, element: str, pos: str, k: int, v: int, variant: str = "standard") -> DataFrame:
    """AMS estimate of the k-th moment: mean over v variables of n * (c^k - (c-1)^k), c = occurrences of
    the variable's element at or after its position (Alon, Matias, Szegedy).

    ``variant='literal'`` counts the element over the whole stream plus one and averages
    (n * (k*c - (k-1)))^k, the defective formula kept for comparison. The v samples are a table of v
    rows (a size fixed by the parameter), broadcast into the count join. Output one row
    (k, v, n, sum_counts, estimate).
    """
    samples = ams_samples(stream, element, pos, v)
    ev = stream.select(F.col(pos).alias("_p"), F.col(element).alias("el"))
    j = ev.join(F.broadcast(samples), "el")
    if variant == "literal":
        counts = j.groupBy("sample").agg((F.count(F.lit(1)) + 1).alias("c"))
    else:
        counts = j.where(F.col("_p") >= F.col("t")).groupBy("sample").agg(F.count(F.lit(1)).alias("c"))
    n = stream.select(F.count(F.lit(1))).scalar()
    c = F.col("c").cast("double")
    if variant == "literal":
        est = F.pow(n * (F.lit(float(k)) * c - F.lit(float(k - 1))), F.lit(float(k)))
    else:
        est = n * (F.pow(c, F.lit(float(k))) - F.pow(c - 1, F.lit(float(k))))
    return counts.agg(
        F.lit(k).alias("k"),
        F.lit(v).alias("v"),
        F.lit(n).cast("bigint").alias("n"),
        F.sum("c").cast("bigint").alias("sum_counts"),
        F.avg(est).alias("estimate"),
    )


def skip_position(sample: int, n: int) -> int:
    """The position (1..n) that variable ``sample`` holds after n positions, by jumps.

    A reservoir of one that holds position t keeps it up to position m with probability t / m, so with a uniform u the next one it takes is
    floor(t / u) + 1: about ln n draws instead of one a position. u comes from md5('skip:sample:t') (52 bits), so the position is the
    same wherever it is computed, and after more positions the same jumps go on.
    """
    t = 1
    while True:
        u = (int(hashlib.md5(f"skip:{sample}:{t}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
        following = math.floor(t / u) + 1
        if following > n:
            return t
        t = following


def ams_skip_samples(stream: DataFrame, element: str, pos: str, v: int) -> DataFrame:
    """(variable, position, element, count) of v variables: uniform positions drawn by ``skip_position`` from the stream's length, the
    element there, and its occurrences from there on.

    Positions run from 1 without gaps. The v positions are drawn beside the data (v * ln n hashes, not v * n); the data are read for their number,
    for the v elements and for the counts, each time in full partitions with partial sums.
    """
    n = stream.count()
    drawn = [(s, skip_position(s, n)) for s in range(1, v + 1)] if n else []
    chosen = stream.sparkSession.createDataFrame(drawn, "variable INT, position BIGINT")  # v rows
    ev = stream.select(F.col(pos).cast("bigint").alias("_p"), F.col(element).alias("element"))
    at = reliable_checkpoint(ev.join(F.broadcast(chosen), F.col("_p") == F.col("position")).select("variable", "position", "element"))
    hits = ev.join(F.broadcast(at), "element").where(F.col("_p") >= F.col("position"))
    return hits.groupBy("variable", "position", "element").agg(F.count(F.lit(1)).alias("count"))


def ams_from_samples(samples: DataFrame, n: Column, ks: Sequence[int]) -> DataFrame:
    """(k, estimate) for every k from one set of samples: the mean of n * (c^k - (c - 1)^k)."""
    c = F.col("count").cast("double")
    terms = [F.struct(F.lit(k).alias("k"), (n * (F.pow(c, F.lit(float(k))) - F.pow(c - 1, F.lit(float(k))))).alias("x")) for k in ks]
    return samples.select(F.inline(F.array(*terms))).groupBy("k").agg(F.avg("x").alias("estimate"))


def bloom_false_positive(n_bits: Column, n_keys: Column, k: Column) -> Column:
    """(1 - exp(-k m / n))^k for m keys in n bits with k hash functions."""
    return F.pow(F.lit(1.0) - F.exp(-k * n_keys / n_bits), k)


def bloom_sizing(keys: DataFrame, key: str, targets: Sequence[float], max_factor: int = 20) -> DataFrame:
    """For m = distinct keys and each target b: the smallest n in steps of max(1, m // 8) (up to max_factor * m)
    with (1 - exp(-k m/n))^k <= b, k = round-half-even(n/m * ln 2). Output (b, n_keys, n_bits, k, p_fp); a target
    that no n reaches keeps its row, with nulls for n_bits, k and p_fp.

    m comes from one aggregate; the n grid (bounded by max_factor * 8 steps) is exploded on that row.
    """
    m = keys.select(F.countDistinct(key).alias("m"))
    step = F.greatest(F.lit(1), F.floor(F.col("m") / 8))
    grid = m.select("m", step.alias("_step"), F.explode(F.sequence(F.lit(1), F.lit(max_factor * 8 + 8))).alias("_j"))
    grid = grid.select("m", (F.col("_j") * F.col("_step")).alias("n")).where(F.col("n") <= max_factor * F.col("m"))
    grid = grid.withColumn("k", F.bround(F.col("n") / F.col("m") * F.lit(LN2), 0).cast("int"))
    grid = grid.withColumn("p", bloom_false_positive(F.col("n").cast("double"), F.col("m").cast("double"), F.col("k").cast("double")))
    tb = F.array(*[F.lit(float(b)) for b in targets])
    hits = grid.select("*", F.explode(tb).alias("b")).where(F.col("p") <= F.col("b"))
    best = hits.groupBy("b").agg(F.min_by(F.struct("n", "k", "p"), F.col("n")).alias("_r"))
    rows = m.select(F.col("m").alias("n_keys"), F.explode(tb).alias("b")).join(best, "b", "left")
    return rows.select("b", "n_keys", F.col("_r.n").alias("n_bits"), F.col("_r.k").alias("k"), F.col("_r.p").alias("p_fp"))


def bloom_positions(key: Column, n_bits: int, k: int) -> Column:
    """k bit positions (h1 + i*h2) mod n from two 52-bit parts of md5(key) (double hashing), distinct."""
    h1 = md5_hex_int(key, 13)
    h2 = F.conv(F.substring(F.md5(key.cast("string")), 14, 13), 16, 10).cast("bigint")
    return F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.pmod(h1 + i.cast("bigint") * (h2 * 2 + 1), F.lit(n_bits))))


def bloom_build(keys: DataFrame, key: str, n_bits: int, k: int) -> DataFrame:
    """The set bits (bit BIGINT), as a long distinct table: partitioned like any other join side."""
    return keys.select(F.explode(bloom_positions(F.col(key), n_bits, k)).alias("bit")).distinct()


def bloom_probe(probes: DataFrame, key: str, bits: DataFrame, n_bits: int, k: int) -> DataFrame:
    """(key, passed): a key passes when all of its bit positions are set (an equi join on bit)."""
    p = probes.select(F.col(key).alias("key"), bloom_positions(F.col(key), n_bits, k).alias("_bits"))
    e = p.select("key", F.size("_bits").alias("_need"), F.explode("_bits").alias("bit"))
    hit = e.join(bits.withColumn("_set", F.lit(1)), "bit", "left")
    return hit.groupBy("key", "_need").agg(F.count("_set").alias("_got")).select("key", (F.col("_got") == F.col("_need")).alias("passed"))


# ---------------------------------------------------------------- blocked filter

BLOCK_BITS, WORD_BITS = 512, 64
WORDS = [f"w{i}" for i in range(BLOCK_BITS // WORD_BITS)]
BLOCK_BYTES = BLOCK_BITS // 8 + 8
BROADCAST_BYTES = 32 << 20


def block_count(n_bits: int) -> int:
    """Blocks of 512 bits that hold ``n_bits``."""
    return max(1, -(-int(n_bits) // BLOCK_BITS))


def _with_words(df: DataFrame, key: str, blocks: int, k: int) -> DataFrame:
    """(key, block, w0 .. w7): the key's block and its k bits there as eight 64-bit words.

    The block is the first 52 bits of md5(key) mod the blocks; bit i is (start + i * stride) mod 512 with start and an odd stride from the next 52 bits, so
    the k bits are distinct.
    """
    h2 = F.conv(F.substring(F.md5(F.col(key).cast("string")), 14, 13), 16, 10).cast("bigint")
    x = df.select(F.col(key).alias("key"), F.pmod(md5_hex_int(F.col(key), 13), F.lit(blocks)).alias("block"), h2.alias("_h"))
    start, stride = F.col("_h").bitwiseAND(F.lit(BLOCK_BITS - 1)), F.shiftright("_h", 9).bitwiseAND(F.lit(255)) * 2 + 1
    x = x.select("key", "block", *[(start + stride * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int").alias(f"_b{i}") for i in range(k)])
    words = []
    for w, name in enumerate(WORDS):
        own = F.lit(0).cast("bigint")
        for i in range(k):
            one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(f"_b{i}").bitwiseAND(F.lit(WORD_BITS - 1)))
            own = own.bitwiseOR(F.when(F.shiftright(f"_b{i}", 6) == w, one).otherwise(F.lit(0).cast("bigint")))
        words.append(own.alias(name))
    return x.select("key", "block", *words)


def blocked_bloom_build(keys: DataFrame, key: str, blocks: int, k: int) -> DataFrame:
    """(block, w0 .. w7): one row a used block, bits packed with ``bit_or`` (partial before the shuffle, so repeated keys cost nothing there)."""
    if not 0 < k <= BLOCK_BITS:
        raise ValueError("k must lie in 1..512")
    x = _with_words(keys.where(F.col(key).isNotNull()), key, blocks, k)
    return x.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS])


def blocked_bloom_probe(probes: DataFrame, key: str, filter_rows: DataFrame, blocks: int, k: int, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(key, passed) of every probe: one join row each, no matter how many bits. Null keys do not pass.

    The filter is broadcast if its ``blocks`` rows of 72 bytes stay under ``broadcast_bytes``; a larger one is joined by block.
    """
    p = _with_words(probes, key, blocks, k)
    f = filter_rows.select("block", *[F.col(w).alias(f"_{w}") for w in WORDS])
    if blocks * BLOCK_BYTES <= broadcast_bytes:
        f = F.broadcast(f)
    hit = F.lit(True)
    for w in WORDS:
        hit = hit & (F.col(w).bitwiseAND(F.col(f"_{w}")) == F.col(w))
    return p.join(f, "block", "left").select("key", F.coalesce(hit, F.lit(False)).alias("passed"))
