"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is an aggregation (partial sums first) and a join over the edges; a node's edges are salted in the join, so a hot
node is never one task. One written table (a reliable checkpoint) a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.groups import reliable_checkpoint


SALTS = 16


def _hang(edges: DataFrame, low: DataFrame) -> DataFrame:
    """(v, m) for every edge (u, v) and its node's minimum (u, m). A node's edges are spread over SALTS join keys."""
    left = edges.withColumn("_s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    right = low.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, ["u", "_s"]).select("u", "v", "m")


def _round(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step over edges (u, v), u > v."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # large star: every larger neighbour of a node is hung on the node's smallest neighbour
    x = _hang(both, low).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    # small star: the smaller neighbours of a node, and the node, are hung on the smallest of them
    low = x.groupBy("u").agg(F.min("v").alias("m"))
    x = _hang(x, low).select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return reliable_checkpoint(x.where("u > v").distinct())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node reachable from every node that has an edge. Loops in the input are ignored."""
    x = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    x = reliable_checkpoint(x)
    for _ in range(max_rounds):
        x = _round(x)
        # done when every edge ends in a root: no node is both hung and hung upon
        if x.join(x.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    roots = x.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return x.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
