"""Helpers the operators share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Model = TypeVar("Model")

SPACE = "[ \\x09-\\x0D]+"
"""White space of every word and normalisation rule here: space and the five ASCII controls."""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_prefix(columns: list[str]) -> str:
    """Underscores that no column's name begins with, for helper columns."""
    prefix = "__"
    while any(c.startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def known_id(doc_id: str) -> Column:
    """The id as a key for plain equality: null as the largest number, which also puts it last."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1))


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


def power_of_two(least: int) -> int:
    """The smallest power of two that is at least ``least``."""
    return 1 << max(0, least - 1).bit_length()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_model: list = []


def worker_model(key: Hashable, make: Callable[[], Model]) -> Model:
    """The model that this worker process works with, made when ``key`` is new.

    Workers live on from stage to stage; only the last model is held, so a pipeline needs the
    memory of one.
    """
    if not _model or _model[0] != key:
        _model.clear()
        gc.collect()
        _model.extend([key, make()])
    return _model[1]
