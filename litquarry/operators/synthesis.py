"""Plans for negative examples: abstracts without genes, or without any disease."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from litquarry.functions.hashing import hash_number, seeded_hash
from litquarry.functions.templates import (
    CANCER_PHRASES, GENERAL_PHRASES, GENERAL_TOPICS, NEGATIVE_PROMPT, NEGATIVE_SYSTEM,
)
from litquarry.functions.text import MISSING
from litquarry.operators.joins import union_all
from litquarry.operators.sampling import SEED, global_rank, take_first

# Fixed value: share of general topics.
GENERAL_SHARE = 0.2


def plan_negatives(
    ids: DataFrame,
    topics: DataFrame,
    general: Sequence[str] = tuple(GENERAL_TOPICS),
    n: int | None = None,
    existing: DataFrame | None = None,
    key: str = "id",
    topic: str = "cancer_type",
    seed: int | str = SEED,
) -> DataFrame:
    """A topic for each id: a cancer type for about 80 % of them, a general topic for the others.

    ``n`` takes that many ids; ids in ``existing`` are left out, so a plan is resumed
    where it stopped. The choice depends only on the seed and the id.
    """
    wanted = ids.select(key) if n is None else take_first(ids.select(key), n, key, seed)
    if existing is not None:
        wanted = wanted.join(existing.select(key), key, "left_anti")
    numbered = global_rank(topics.select(topic).distinct(), topic, seed, "_number").withColumn(
        "_number", F.col("_number") - 1
    )
    n_topics = numbered.agg(F.count(F.lit(1))).scalar()
    pick = hash_number(seeded_hash(f"{seed}:topic", key))
    share = hash_number(seeded_hash(f"{seed}:kind", key)) / F.lit(float(2**32))
    general_pick = F.get(F.array(*[F.lit(t) for t in general]), (pick % len(general)).cast("int"))
    planned = wanted.withColumn("is_cancer", share >= GENERAL_SHARE)
    of_cancer = planned.filter("is_cancer").withColumn("_pick", pick % n_topics)
    named = of_cancer.join(numbered, F.col("_pick") == F.col("_number"), "left").select(
        key, "is_cancer", F.col(topic).alias("topic"), F.col(topic).alias("disease")
    )
    others = planned.filter("not is_cancer").select(
        key, "is_cancer", general_pick.alias("topic"), F.lit(MISSING).alias("disease")
    )
    return union_all(named, others).withColumn("genes", F.lit(MISSING))


def negative_prompt(topic: Column | str = "topic", is_cancer: Column | str = "is_cancer") -> Column:
    """The user prompt for a planned topic."""
    topic = F.col(topic) if isinstance(topic, str) else topic
    is_cancer = F.col(is_cancer) if isinstance(is_cancer, str) else is_cancer
    phrases = [F.when(is_cancer, F.lit(c)).otherwise(F.lit(g)) for c, g in zip(CANCER_PHRASES, GENERAL_PHRASES)]
    return F.format_string(NEGATIVE_PROMPT, topic, *phrases)


def render_negative_prompt(plan: DataFrame) -> DataFrame:
    """The plan with the messages to send: a fixed system text and the prompt."""
    turns = [("system", F.lit(NEGATIVE_SYSTEM)), ("user", negative_prompt())]
    messages = F.array(*[F.struct(F.lit(role).alias("role"), text.alias("content")) for role, text in turns])
    return plan.withColumn("messages", messages)
