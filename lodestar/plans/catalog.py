"""All driver queries: importing the plan modules fills the registry."""

from __future__ import annotations

from . import cf, factors, files, fits, sets, streams, text  # noqa: F401
from .registry import ORACLE, QUERIES


def all_queries():
    return QUERIES


def all_oracle_sql():
    return ORACLE
