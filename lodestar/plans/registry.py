"""Registry of the driver queries: name -> Spark builder (spark, sf_dir) -> DataFrame, and name -> DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def _positive_zero_rounds(sql: str) -> str:
    """Append ``+ 0.0`` to every ``round(...)``: DuckDB keeps -0.0 after rounding, Spark's round gives 0.0."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):  # bround( and the like
            out.append(sql[i : j + 6])
            i = j + 6
            continue
        depth, k = 1, j + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j] + "(" + sql[j : j + 6] + _positive_zero_rounds(sql[j + 6 : k - 1]) + ") + 0.0)")
        i = k


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB twin over the same tables (omit for non-SQL operators)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _positive_zero_rounds(sql.strip())
        return fn

    return deco
