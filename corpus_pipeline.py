"""From documents to packed token sequences: five stages, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from litquarry.llm.common import documents
from litquarry.llm.language import keep_identified
from litquarry.llm.line_dedup import dedup_lines
from litquarry.llm.packing import packed_documents
from litquarry.llm.secrets import redact
from litquarry.llm.simhash import near_dedup
from litquarry.session import discard, materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null texts and texts without a letter go."""
    return keep_identified(docs)


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat another line; those left without a word go."""
    return dedup_lines(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: linked SimHash fingerprints, as in op2, or alike shingles."""
    return near_dedup(docs, fingerprints=True)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of at most 2048 tokens."""
    return packed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("line dedup", remove_lines),
    ("near dedup", remove_near_copies),
    ("secret scan", remove_secrets),
    ("packing", pack_sequences),
]

ORACLE_SQL = None
"""No SQL: language, similar lines, tagged secrets and packing are beyond it; tests compare with plain versions."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        given, docs = docs, stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, "stage")
            discard(given)
    return docs
