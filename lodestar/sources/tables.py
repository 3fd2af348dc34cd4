"""Parquet tables of a scale-factor folder, and the rating tables derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; Catalyst prunes columns and pushes filters into the parquet scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, per_core: int = 2) -> DataFrame:
    """Round-robin the rows over ``per_core`` x the cluster's cores when the scan yields fewer splits.

    For per-row heavy work (regex shingling, hashing of long texts): a file with few row groups
    otherwise leaves most cores idle. On a large table the scan already has more splits and
    nothing is added.
    """
    target = per_core * df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def documents(spark: SparkSession, sf_dir: str, columns=("doc_id", "text")) -> DataFrame:
    """The documents table, projected, and spread over all cores for text work."""
    return spread(table(spark, sf_dir, "documents").select(*columns))


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating event per line item: (user_id = o_custkey, item_id = l_partkey, rating = l_quantity).

    A sort-merge (or AQE broadcast) join on the order key; only four columns are read. Keys are
    filtered non-null explicitly, the same filter Catalyst infers for join keys: every branch of a
    query that reuses the ratings then has the same scan, and Spark reuses one shuffle for all.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").where(
        F.col("o_orderkey").isNotNull() & F.col("o_custkey").isNotNull()
    )
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity").where(
        F.col("l_orderkey").isNotNull() & F.col("l_partkey").isNotNull()
    )
    return orders.join(items, orders.o_orderkey == items.l_orderkey).select(
        F.col("o_custkey").cast("bigint").alias("user_id"),
        F.col("l_partkey").cast("bigint").alias("item_id"),
        F.col("l_quantity").cast("double").alias("rating"),
    )


def customer_item_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of the MinHash jobs: distinct (set_id = customer, element = part)."""
    return rating_events(spark, sf_dir).select(
        F.col("user_id").alias("set_id"), F.col("item_id").alias("element")
    ).distinct()
