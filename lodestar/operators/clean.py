"""Cleaning: unknown markers to null and row drop, key canonicalisation through an alias table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .groups import reliable_checkpoint


def unknown_to_null(df: DataFrame, markers: Sequence[str] = ("?",), columns: Sequence[str] | None = None) -> DataFrame:
    """Trimmed string values equal to a marker, and empty strings, become null."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    out = df
    for c in cols:
        t = F.trim(F.col(c))
        out = out.withColumn(c, F.when((t == "") | t.isin(*markers), F.lit(None)).otherwise(F.col(c)))
    return out


def drop_unknown(df: DataFrame, markers: Sequence[str] = ("?",), columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without any null after the marker rule (``na.drop`` on the cleaned frame)."""
    return unknown_to_null(df, markers, columns).na.drop()


def canonicalize(df: DataFrame, column: str, alias: DataFrame, bad: str = "badid", good: str = "goodid") -> DataFrame:
    """Map ``column`` through alias (bad -> good), identity on a miss, one step (not transitive).

    The alias table is first made unique on the bad key (smallest good id wins) and written, so that the
    join of a hot id is split between two plain shuffles. It is a plain left join: AQE turns it into a broadcast only when the runtime size of the alias side is under the
    broadcast threshold, so nothing unbounded is broadcast.
    """
    a = reliable_checkpoint(alias.groupBy(F.col(bad).alias("_bad")).agg(F.min(good).alias("_good")))
    return (
        df.join(a, F.col(column) == F.col("_bad"), "left")
        .withColumn(column, F.coalesce(F.col("_good"), F.col(column)).cast(df.schema[column].dataType))
        .drop("_bad", "_good")
    )
