"""Evaluating a column once for several uses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, whatever the number of its uses."""
    return F.transform(F.array(value), use)[0]


def keep_where(df: DataFrame, value: Column, condition: Callable[[Column], Column], alias: str) -> DataFrame:
    """Rows whose value meets the condition, with the value as a column.

    A filter over a costly column would be pushed below it and compute it a second
    time; here it is computed once.
    """
    return df.select("*", F.explode(F.filter(F.array(value), condition)).alias(alias))
