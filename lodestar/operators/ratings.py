"""Rating tables: utility matrix (long form), profiles, per-user statistics, centring, inverted index, pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import round6
from .groups import chunked_collect, reliable_checkpoint


def utility_matrix(events: DataFrame, user: str = "user_id", item: str = "item_id", value: str = "rating") -> DataFrame:
    """Utility matrix by sum: one row per (user, item) holding the summed value. Absent row = unrated."""
    return events.groupBy(user, item).agg(F.sum(value).cast("double").alias(value))


def ratings_profile(um: DataFrame) -> DataFrame:
    """Rows, users, items, density and rating range of a long utility matrix, in one aggregate."""
    return um.agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("item_id").alias("n_items"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        round6(F.avg("rating")).alias("avg_rating"),
    ).withColumn(
        "density", round6(F.col("n_ratings") / (F.col("n_users").cast("double") * F.col("n_items")))
    )


def user_stats(um: DataFrame, user: str = "user_id", value: str = "rating") -> DataFrame:
    """Per user: number of ratings, mean and L2 norm, from one aggregate (partial before the shuffle)."""
    s = um.groupBy(user).agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.avg(value).alias("mean_rating"),
        F.sum(F.col(value) * F.col(value)).alias("_ss"),
    )
    return s.select(
        user,
        "n_ratings",
        "mean_rating",
        F.sqrt("_ss").alias("norm"),
    )


def center_ratings(um: DataFrame, axis: str = "user", user: str = "user_id", item: str = "item_id", value: str = "rating", totals: bool = False) -> DataFrame:
    """Subtract the mean of the user (axis='user'), of the item ('item') or of all ratings ('all').

    Absent rows play 0 after centring, as in the dense form. The means are written, then joined
    back: AQE splits a hot key only between two plain shuffles, and a window would buffer a whole hot user. With ``totals`` (of a user or an item) a
    row also has what its mean is made of, ``_sum`` and ``_n``: they are shorter than ``centered``, which is ``rating - _sum / _n``.
    """
    if axis == "all":
        mean = um.select(F.avg(value)).scalar()
        return um.withColumn("centered", F.col(value) - mean)
    key = {"user": user, "item": item}[axis]
    means = reliable_checkpoint(um.groupBy(key).agg(F.avg(value).alias("_mean"), *([F.sum(value).alias("_sum"), F.count(value).alias("_n")] if totals else [])))
    return um.join(means, key).select(user, item, value, (F.col(value) - F.col("_mean")).alias("centered"), *(["_sum", "_n"] if totals else []))


def rated_by(um: DataFrame, user: str = "user_id", item: str = "item_id", chunk_rows: int = 10000) -> DataFrame:
    """Inverted index item -> sorted users who rated it, in bounded chunks."""
    return chunked_collect(um, [item], user, F.col(user), "users", chunk_rows)


def user_vectors(um: DataFrame, user: str = "user_id", item: str = "item_id", value: str = "rating", chunk_rows: int = 10000) -> DataFrame:
    """Sparse vector per user: sorted (item, rating) entries, in bounded chunks."""
    return chunked_collect(um, [user], item, F.struct(F.col(item), F.col(value)), "entries", chunk_rows)


def um_pivot(um: DataFrame, row: str, column: str, values: Sequence, value: str = "rating") -> DataFrame:
    """Long -> wide with an explicit column list (bounded width); a duplicate (row, column) is an error."""
    dup = um.groupBy(row, column).count().where("count > 1").limit(1).count()
    if dup:
        raise ValueError(f"duplicate ({row}, {column}) entries: aggregate first")
    return um.groupBy(row).pivot(column, list(values)).agg(F.first(value))
