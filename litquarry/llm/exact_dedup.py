"""Exact deduplication by a tree merge of sorted digest runs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from litquarry.llm.common import SPACE, documents, power_of_two, shuffle_partitions, text_or_empty
from litquarry.llm.registry import query
from litquarry.session import materialize

ROUND_BITS = 3
"""Bits of the partition number settled in a round: runs of 2**3 partitions meet in one merge."""

KEY = ["digest", "size", "check"]
RUN = "digest binary, size long, `check` long, doc_id long, row long, members long, place int"


def keep_smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Collapse a stream sorted by (digest, size, check, id) to one row per text.

    Digest, length and a second, independent hash must all agree before two rows count as one
    text. The last text of a batch is held back until the next one shows where it ends, so a task
    holds one batch, however many copies a text has.
    """
    held: pa.Table | None = None
    schema = None
    for batch in batches:
        schema = batch.schema
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        merged = table.group_by([*KEY, "place"], use_threads=False).aggregate(
            [("doc_id", "first"), ("row", "first"), ("members", "sum")]
        )
        merged = merged.rename_columns(
            [{"doc_id_first": "doc_id", "row_first": "row", "members_sum": "members"}.get(c, c) for c in merged.column_names]
        ).select(schema.names).cast(schema)
        yield from merged.slice(0, merged.num_rows - 1).to_batches()
        held = merged.slice(merged.num_rows - 1)
    if held is not None:
        yield from held.to_batches()


def merge_runs(rows: DataFrame, partitions: int) -> DataFrame:
    """One row per text, from rows of (digest, size, check, doc_id, row).

    ``partitions`` is a power of two. Each partition sorts its rows to a run with one row per text.
    In each round it sends the run on, with the next bits of its own number replaced by those bits
    of the digest; the partitions that differ in these bits only so exchange their runs, and the
    receiver merges them and keeps the smallest id of each text. After the last round a text has
    one partition. No round receives more than one row per text and run, so a text with a third of
    all rows costs no more than any other.
    """
    order = ["digest", "size", "check", F.col("doc_id").asc_nulls_last(), "row"]
    digits = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long")
    run = rows.select(
        *KEY, "doc_id", "row", F.lit(1).cast("long").alias("members"),
        (F.spark_partition_id() % partitions).alias("place"),
    )
    run = run.sortWithinPartitions(*order).mapInArrow(_collapse_by_place, RUN)
    bits = partitions.bit_length() - 1
    for low in range(0, bits, ROUND_BITS):
        high = min(bits, low + ROUND_BITS)
        mask = (1 << high) - (1 << low)
        target = F.col("place").bitwiseAND(F.lit(partitions - 1 - mask)).bitwiseOR(
            digits.bitwiseAND(F.lit(mask)).cast("int")
        )
        run = (
            run.withColumn("place", target.cast("int"))
            .repartitionById(partitions, "place")
            .sortWithinPartitions(*order)
            .mapInArrow(_collapse_by_place, RUN)
        )
    return run


def _collapse_by_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from keep_smallest(b for b in batches if b.num_rows)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Texts are equal when identical after each run of ASCII white space is replaced by one space.
    A null text counts as empty, so null, empty and no other texts form one group. The row with
    the smallest doc_id stays; null ids come last, and of rows with the same id one stays, chosen
    by their order in the digest table. An empty table gives an empty result; other columns are
    not read.
    """
    spark = docs.sparkSession
    normalised = F.regexp_replace(text_or_empty(), SPACE, " ")
    rows = materialize(
        docs.select("doc_id", normalised.alias("normalised")).select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            F.unhex(F.sha2("normalised", 256)).alias("digest"),
            F.octet_length("normalised").cast("long").alias("size"),
            F.xxhash64("normalised").alias("check"),
        ),
        "digests",
    )
    kept = merge_runs(rows, power_of_two(shuffle_partitions(spark))).select(
        *KEY, F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("members").alias("group_size")
    )
    return rows.join(kept, KEY).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query("""
    WITH t AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[ \\t\\n\\v\\f\\r]+', ' ', 'g')) AS text_sha256
        FROM documents
    )
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = min(doc_id) OVER g AS kept, text_sha256
    FROM t WINDOW g AS (PARTITION BY text_sha256)
""")
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))
