"""File streams: incremental ingest of matches, and answers saved as they come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from litquarry import schemas
from litquarry.operators.extraction import extract_batch
from litquarry.operators.filters import literature_filter
from litquarry.session import saved_table

TOTALS = "batch long, files long, rows_in long, rows_kept long"
SAVE_SECONDS = 30


def ingest_new_files(
    spark: SparkSession,
    src: str,
    out: str,
    checkpoint: str,
    schema: T.StructType = schemas.MATCHES,
    pattern: str = "*.parquet",
    files_per_batch: int = 1000,
    transform=literature_filter,
    totals: str | None = None,
) -> DataFrame:
    """Filter the files not yet processed into the table at ``out`` and return that table.

    The checkpoint remembers the processed files, and a batch is committed as a whole,
    so a run that was lost is repeated without gaps or repeats.

    With a path for ``totals``, the files, rows read and rows kept of each batch, as the stream observes
    them, are saved there while it runs; ``ingest_totals`` sums them. Counting the rows read keeps the
    filter above the scan, so without it Parquet can skip more.
    """
    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(src)
    )
    kept = transform(stream) if totals is None else _observed(stream, transform)
    query = (
        kept.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if totals is None:
        query.awaitTermination()
    else:
        while not query.awaitTermination(SAVE_SECONDS):
            _save_totals(spark, query, totals)
        _save_totals(spark, query, totals)
    return spark.read.schema(transform(spark.createDataFrame([], schema)).schema).parquet(out)


def _observed(stream: DataFrame, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The transformed stream, which observes its files (those with a row, by their first one) and rows on its way."""
    place = next(n for n in ("row" + "_" * i for i in range(len(stream.columns) + 1)) if n not in stream.columns)
    read = stream.select("*", F.col("_metadata.row_index").alias(place))
    read = read.observe("read", F.count(F.lit(1)).alias("rows"), F.count_if(F.col(place) == 0).alias("files")).drop(place)
    return transform(read).observe("kept", F.count(F.lit(1)).alias("rows"))


def _save_totals(spark: SparkSession, query: StreamingQuery, path: str) -> None:
    """Append the totals of the batches that have ended and are not saved yet."""
    saved = {row["batch"] for row in saved_table(spark, path, TOTALS).select("batch").collect()}
    rows = {}
    for progress in query.recentProgress:
        seen = progress.observedMetrics
        if progress.batchId not in saved and "read" in seen and progress.numInputRows:
            rows[progress.batchId] = (progress.batchId, seen["read"]["files"], seen["read"]["rows"], seen["kept"]["rows"])
    if rows:
        spark.createDataFrame(list(rows.values()), TOTALS).coalesce(1).write.mode("append").parquet(path)


def ingest_totals(spark: SparkSession, path: str) -> DataFrame:
    """files, rows_in and rows_kept of all runs so far, in one row; zeros before the first batch.

    A batch repeated after a lost run has the same files and counts once. Files without a row are not counted.
    A run that is lost between a batch's end and the next save, at most SAVE_SECONDS, leaves that batch out.
    """
    batches = saved_table(spark, path, TOTALS).dropDuplicates(["batch"])
    return batches.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("files", "rows_in", "rows_kept")])


def answer_new_prompts(
    spark: SparkSession,
    src: str,
    out: str,
    checkpoint: str,
    fn: Callable[[str], str],
    schema: T.StructType,
    prompt: str = "prompt",
    response: str = "response",
    files_per_batch: int = 100,
) -> DataFrame:
    """Answer the prompt files not yet answered into the table at ``out`` and return that table.

    Answers are costly: they are saved after every batch of files, and a run that was
    lost goes on after the last saved batch.
    """
    return ingest_new_files(
        spark, src, out, checkpoint, schema=schema, files_per_batch=files_per_batch,
        transform=lambda prompts: extract_batch(prompts, fn, prompt, response),
    )
