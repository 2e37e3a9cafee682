"""Reproducible pseudo-random values from row keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def seeded_hash(seed: int | str, key: Column | str) -> Column:
    """md5 of ``seed:key``: the same for a row in every run, task retry and partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def hash_number(digest: Column) -> Column:
    """First 32 bits of a hex digest as a number below 2**32."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
