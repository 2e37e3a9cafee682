"""Joins of matches, dimensions and abstracts.

No side carries a broadcast hint. Spark broadcasts a side whose size, from file
statistics or measured at run time, is under ``spark.sql.autoBroadcastJoinThreshold``
and otherwise sort-merges, splitting oversized partitions of a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def attach_dimension(
    facts: DataFrame, dim: DataFrame, left_on: str, right_on: str, value: str, alias: str | None = None
) -> DataFrame:
    """Facts with the dimension's value in place of its key; facts without a value are dropped.

    A key that is repeated in the dimension gives one row per value.
    """
    values = dim.filter(F.col(value).isNotNull()).select(
        F.col(right_on).alias("_key"), F.col(value).alias(alias or value)
    )
    return facts.join(values, facts[left_on] == values["_key"]).drop(left_on, "_key")


def restrict_to(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys, on, "left_semi")


def combine_evidence(genes: DataFrame, diseases: DataFrame, organisms: DataFrame, on: str = "pmid") -> DataFrame:
    """Gene evidence with the diseases and each organism list of its key."""
    return genes.join(diseases, on, "left").join(organisms, on, "left")


def attach_abstracts(df: DataFrame, pubmed: DataFrame, on: str = "pmid") -> DataFrame:
    """Rows with title and abstract, null where there is no record.

    The records are first cut down to the wanted keys: where those are few they are
    broadcast, and the texts of all other records are never shuffled.
    """
    return df.join(restrict_to(pubmed, df.select(on), on), on, "left")


def apply_mapping(df: DataFrame, mapping: DataFrame, on: str) -> DataFrame:
    """Rows with the columns of their mapping; null where there is none.

    The mapping has one row per value, so rows are neither lost nor multiplied. A
    null value has no mapping, which is what the plain equality gives.
    """
    return df.join(mapping, on, "left")


def top_level_group(
    df: DataFrame,
    groups: DataFrame,
    main_type: str = "Main_Type",
    group_key: str = "mainType",
    group_value: str = "top_group",
    default: str = "Other Cancer",
    alias: str = "Top_Level_Group",
) -> DataFrame:
    """Rows with the top-level group of their main type, or the default."""
    lookup = groups.select(F.col(group_key).alias("_main"), F.col(group_value).alias("_group"))
    return (
        df.join(lookup, df[main_type] == lookup["_main"], "left")
        .withColumn(alias, F.coalesce("_group", F.lit(default)))
        .drop("_main", "_group")
    )


def union_all(*parts: DataFrame) -> DataFrame:
    """Rows of all parts; their columns must agree."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
