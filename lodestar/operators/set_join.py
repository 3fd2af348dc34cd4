"""Pairs of sets above a similarity: a prefix-filtered join on (set_id, element) tables whose output, not its candidates, grows with the pairs.

Elements are ordered by rarity (sets that hold them, then the element). Two sets of Jaccard >= t = numerator / denominator share an element among the first
n - ceil(t * n) + 1 of each, so only those prefixes are joined, element by element, and the common prefix elements of a pair are counted. A pair must also
fit in length (the smaller set has at least t of the larger one's size) and in reach: what it has in common beyond its common prefix elements follows the last of
them on both sides, and lies beyond the prefix of one side, which leaves out ceil(t * n) - 1 elements. With a small t the prefixes are nearly whole, and few pairs are
within reach. The pairs that are left are counted exactly on all elements. All bounds are in integers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from .groups import global_row_number, pairs_in_groups, reliable_checkpoint
from .minhash import pair_overlap


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + F.lit(b - 1)) / F.lit(b)).cast("bigint")


def rarity_prefixes(sets: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """(element, set_id, n, pos): the rarest elements of every set that a partner must share one of; ``pos`` counts from 0.

    Elements of a single set take a place in the order but have no partner and are left out. Places come from one global sort,
    so a set of any size is cut over the tasks.
    """
    held = reliable_checkpoint(sets.groupBy("element").agg(F.count(F.lit(1)).alias("_held")))
    ranked = global_row_number(sets.join(held, "element"), ["set_id", "_held", "element"], "_rn")
    own = reliable_checkpoint(ranked.groupBy("set_id").agg(F.min("_rn").alias("_first"), F.count(F.lit(1)).alias("n")))
    x = ranked.join(own, "set_id").withColumn("pos", F.col("_rn") - F.col("_first"))
    needed = _ceil_div(F.col("n") * numerator, denominator)
    return x.where((F.col("pos") <= F.col("n") - needed) & (F.col("_held") > 1)).select("element", "set_id", "n", "pos")


def candidate_pairs_at_least(sets: DataFrame, numerator: int, denominator: int, tile_rows: int = 2048) -> DataFrame:
    """(set_a, set_b): every pair that may reach the similarity, set_a < set_b, each once."""
    prefixes = reliable_checkpoint(rarity_prefixes(sets, numerator, denominator))
    p = pairs_in_groups(
        prefixes, "element", "set_id", ["n", "pos"], tile_rows=tile_rows, reduce=_prefix_overlap, reduced="lo_n bigint, hi_n bigint, lo_pos bigint, hi_pos bigint"
    )
    fits = F.least("lo_n", "hi_n") * denominator >= F.greatest("lo_n", "hi_n") * numerator
    overlap = _ceil_div((F.col("lo_n") + F.col("hi_n")) * numerator, numerator + denominator)
    after = F.least(F.col("lo_n") - F.col("lo_pos"), F.col("hi_n") - F.col("hi_pos")) - 1
    beyond = _ceil_div(F.greatest("lo_n", "hi_n") * numerator, denominator) - 1
    reach = F.col("n_common") + F.least(after, beyond)
    return p.where(fits & (reach >= overlap)).select(F.col("lo").alias("set_a"), F.col("hi").alias("set_b"))


def _prefix_overlap(lo, hi, first):
    """Per pair, both sizes and the places of the last common prefix element."""
    return [lo[0][first], hi[0][first], np.maximum.reduceat(lo[1], first), np.maximum.reduceat(hi[1], first)]


def jaccard_at_least(sets: DataFrame, numerator: int, denominator: int, tile_rows: int = 2048) -> DataFrame:
    """(set_a, set_b, intersection, union_size, jaccard) of every pair with intersection / union >= numerator / denominator > 0.

    ``sets`` has one row a (set_id, element) (``minhash.set_elements``) and is read several times: write it first. Equal sets are pairs like
    any other. Empty sets have no rows and no pairs.
    """
    if not 0 < numerator <= denominator:
        raise ValueError("the similarity must lie in (0, 1]")
    pairs = reliable_checkpoint(candidate_pairs_at_least(sets, numerator, denominator, tile_rows))
    o = pair_overlap(sets, pairs).where(F.col("intersection") * denominator >= F.col("union_size") * numerator)
    return o.select("set_a", "set_b", "intersection", "union_size", safe_div(F.col("intersection"), F.col("union_size")).alias("jaccard"))
