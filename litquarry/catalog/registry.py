"""Registry of the queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
oracles: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where there is one."""

    def register(fn):
        queries[fn.__name__] = fn
        if sql is not None:
            oracles[fn.__name__] = sql
        return fn

    return register
