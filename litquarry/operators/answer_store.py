"""Answers kept in an append-only table, so that a lost run goes on where it stopped."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from litquarry.operators.extraction import QUERY_ERROR, extract_batch
from litquarry.session import materialize, saved_table

DIGEST = "prompt_digest"
SCHEMA = f"{DIGEST} string, response string"

ROUND_PROMPTS = 100_000
"""Prompts a task asks before their answers are saved, on average; fewer where all cores would not have a task."""
JOBS = 16
"""Most jobs of a run."""
DIRECT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
"""Files go to their place when their task ends, not when all have."""


def prompt_digest(prompt: Column | str) -> Column:
    return F.sha2(F.col(prompt) if isinstance(prompt, str) else prompt, 256)


def stored_answers(spark: SparkSession, store: str) -> DataFrame:
    """The digest and answer of every prompt asked so far; none where nothing has been stored."""
    return saved_table(spark, store, SCHEMA)


def ask_missing(
    prompted: DataFrame, fn: Callable[[str], str], store: str, prompt: str = "prompt", per_round: int = ROUND_PROMPTS
) -> int:
    """Ask every prompt that the table at ``store`` lacks and append its answer; returns how many it lacked.

    Equal prompts are asked once, null ones never. The missing prompts are written in order of their
    digest and asked in at most JOBS ranges of digests, one after the other, by tasks of ``per_round``
    prompts. A task's answers are in the table as soon as it ends (``DIRECT``; a committer that
    ignores this puts them there with their range), so a lost run leaves behind all but those of the
    tasks that it lost, and the next run asks the rest only. The jobs stay few however many prompts there
    are. A failed call stores nothing, so the next run asks it again. Only a task that Spark
    repeats after losing an executor may ask its prompts a second time; its file has the same name.
    """
    spark = prompted.sparkSession
    wanted = prompted.filter(F.col(prompt).isNotNull()).select(prompt_digest(prompt).alias(DIGEST), F.col(prompt).alias("prompt"))
    missing = wanted.join(stored_answers(spark, store), DIGEST, "left_anti").groupBy(DIGEST).agg(F.first("prompt").alias("prompt"))
    missing = materialize(missing.orderBy(DIGEST), "missing_prompts")
    n = missing.count()
    rounds = math.ceil(n / per_round)
    jobs = min(rounds, JOBS)
    tasks = max(math.ceil(rounds / max(jobs, 1)), min(spark.sparkContext.defaultParallelism, n))
    ends = [f"{(1 << 64) * i // jobs:016x}" for i in range(1, jobs)]
    for low, high in zip([None, *ends], [*ends, None] if n else []):
        batch = missing if low is None else missing.filter(F.col(DIGEST) >= low)
        batch = batch if high is None else batch.filter(F.col(DIGEST) < high)
        answers = extract_batch(batch.repartition(tasks, DIGEST), fn, "prompt", "response").select(DIGEST, "response")
        answers.filter(F.col("response") != QUERY_ERROR).write.mode("append").options(**DIRECT).parquet(store)
    return n


def with_answers(prompted: DataFrame, store: str, prompt: str = "prompt", response: str = "response") -> DataFrame:
    """The rows with the stored answer to their prompt, or the error text where there is none; null for a null prompt."""
    stored = stored_answers(prompted.sparkSession, store).groupBy(F.col(DIGEST).alias("_stored")).agg(F.min("response").alias("_response"))
    joined = prompted.join(stored, prompt_digest(prompt) == F.col("_stored"), "left")
    answer = F.when(F.col(prompt).isNotNull(), F.coalesce("_response", F.lit(QUERY_ERROR)))
    return joined.withColumn(response, answer).drop("_stored", "_response")


def resume_answers(
    prompted: DataFrame, fn: Callable[[str], str], store: str, prompt: str = "prompt", response: str = "response",
    per_round: int = ROUND_PROMPTS,
) -> DataFrame:
    """The rows with the answer to their prompt, asking only what the table at ``store`` lacks."""
    ask_missing(prompted, fn, store, prompt, per_round)
    return with_answers(prompted, store, prompt, response)
