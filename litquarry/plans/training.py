"""From labelled and negative abstracts to the training and validation splits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from litquarry.functions.text import null_to_na, strip
from litquarry.operators.chat import build_chat, repair_chat
from litquarry.operators.extraction import QUERY_ERROR, extract_batch
from litquarry.operators.filters import drop_blank
from litquarry.operators.sampling import SEED, TRAIN_SHARE, mix_corpora, number_copies, train_val_split
from litquarry.operators.synthesis import plan_negatives, render_negative_prompt
from litquarry.session import materialize, saved_table
from litquarry.sources.sinks import replace_lines, write_chat_lines
from litquarry.sources.tables import read_chat_lines

PATIENCE = 5
"""Rounds without any new example after which filling up stops."""


def negative_examples(plan: DataFrame, fn: Callable[[str], str], key: str = "id") -> DataFrame:
    """The plan's abstracts from the caller's function, asked once: key, abstract, disease, genes.

    A failed one is left out, so that a plan over the remaining keys asks for it again.
    """
    prompted = render_negative_prompt(plan).withColumn("prompt", F.element_at("messages", -1)["content"])
    answered = materialize(extract_batch(prompted, fn), "answers")
    return answered.filter(F.col("response") != QUERY_ERROR).select(
        key, strip("response").alias("abstract"), "disease", "genes"
    )


def fill_negatives(
    ids: DataFrame, topics: DataFrame, fn: Callable[[str], str], n: int, store: str, key: str = "id", seed: int | str = SEED,
    patience: int = PATIENCE, **planned,
) -> DataFrame:
    """Negative examples appended to the table at ``store`` until it holds ``n`` of them.

    Each round plans exactly the missing number of untried ids, in seeded order, asks for them and
    appends those that succeeded; the next round replaces the others by further ids. It ends at the
    target, when the ids run out, or after ``patience`` rounds in a row that brought nothing. A
    run that is lost goes on from the saved rounds and tries failed ids again.
    """
    spark = ids.sparkSession
    schema = f"`{key}` {ids.schema[key].dataType.simpleString()}, abstract string, disease string, genes string"
    untried = materialize(ids.select(key).distinct().join(saved_table(spark, store, schema), key, "left_anti"), "untried")
    have, idle = saved_table(spark, store, schema).count(), 0
    while have < n and idle < patience and not untried.isEmpty():
        plan = materialize(plan_negatives(untried, topics, n=n - have, key=key, seed=seed, **planned), "plan")
        negative_examples(plan, fn, key).write.mode("append").parquet(store)
        now = saved_table(spark, store, schema).count()
        have, idle = now, 0 if now > have else idle + 1
        untried = materialize(untried.join(plan, key, "left_anti"), "untried")
    return saved_table(spark, store, schema)


def keyed_examples(df: DataFrame, disease: str, gene: str, origin: str, key: str | None = None) -> DataFrame:
    """Examples with an abstract: key, origin, abstract, disease_name, gene.

    Without a unique ``key`` column the key is a digest of the example and its number
    among equal examples; counting those moves the texts once, so they are written.
    """
    named = drop_blank(df, "abstract").select(
        *([F.concat_ws(":", F.lit(origin), F.col(key).cast("string")).alias("key")] if key else []),
        "abstract",
        null_to_na(disease).alias("disease_name"),
        null_to_na(gene).alias("gene"),
    )
    if not key:
        digest = F.md5(F.concat(F.md5("abstract"), F.md5("disease_name"), F.md5("gene")))
        numbered = number_copies(named).withColumn("key", F.concat_ws(":", F.lit(origin), digest, F.col("copy")))
        named = materialize(numbered.drop("copy"), origin)
    return named.select("key", F.lit(origin).alias("origin"), "abstract", "disease_name", "gene")


def build_training_set(
    labelled: DataFrame,
    negatives: DataFrame,
    template: str,
    n_real: int | None = None,
    n_synth: int | None = None,
    frac: float = TRAIN_SHARE,
    seed: int = SEED,
    real_key: str | None = "pmid",
    synthetic_key: str | None = None,
) -> DataFrame:
    """Mixed, split and repaired chat samples: key, origin, messages, split.

    All examples are used unless ``n_real`` or ``n_synth`` bounds them, as for a costly
    fine-tune. Samples are taken before their texts are rendered, and the mix is written
    once because splitting reads it several times. ``export_splits`` writes the result in
    the seeded order of its keys.
    """
    real = keyed_examples(labelled, "disease_name", "gene", "real", real_key)
    synthetic = keyed_examples(negatives, "disease", "genes", "synthetic", synthetic_key)
    mixed = materialize(mix_corpora(real, synthetic, n_real, n_synth, "key", seed), "mixed")
    split = train_val_split(mixed, "key", frac, f"{seed}:split")
    return repair_chat(build_chat(split, template), "key", seed).select("key", "origin", "messages", "split")


def repair_in_place(spark: SparkSession, path: str, seed: int | str = SEED) -> int:
    """Replace the chat lines at ``path`` by those that are kept, repaired; returns how many these are.

    Calls get their ids from the line's digest. The repaired samples are written before the files
    they come from are touched.
    """
    samples = read_chat_lines(spark, path).withColumn("line_digest", F.sha2("raw", 256)).drop("raw")
    kept = materialize(repair_chat(samples, "line_digest", seed), "repaired")
    rows = kept.count()
    replace_lines(spark, path, lambda new: write_chat_lines(kept, new, "line_digest", seed=seed), rows)
    return rows
