"""Mapping free-text indications to a tumour-type ontology.

Distinct texts are matched once and the result is joined back to the rows.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from litquarry.functions import fuzzy
from litquarry.functions.text import clean_indication, strip
from litquarry.operators import token_match
from litquarry.operators.joins import apply_mapping, top_level_group
from litquarry.session import materialize

# The scoring code travels with the task, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(fuzzy)

# Similarity threshold, marker of a hit on the main type only.
THRESHOLD = 80
NOT_NAMED = "NA"

# Segments of a name beyond those that edits can touch: so many of its commonest are not looked up.
SPARE_SEGMENTS = 6

# Texts and candidates that one task compares by the weighted ratio, on average.
BLOCK = 1_000


def match_record(kind: Column, tumor: Column) -> Column:
    """The match for a hit on a tumour's name (kind 0) or on its main type (kind 1)."""
    by_name = kind == 0
    return F.struct(
        F.when(by_name, tumor["name"]).otherwise(F.lit(NOT_NAMED)).alias("matched_name"),
        F.when(by_name, tumor["code"]).otherwise(F.lit(NOT_NAMED)).alias("code"),
        tumor["mainType"].alias("mainType"),
    )


def mapped_label(matched_name: Column | str, main_type: Column | str) -> Column:
    """The matched name, or the main type where only that was hit."""
    matched_name = F.col(matched_name) if isinstance(matched_name, str) else matched_name
    main_type = F.col(main_type) if isinstance(main_type, str) else main_type
    return F.when(matched_name != NOT_NAMED, matched_name).when(matched_name.isNotNull(), main_type)


def match_candidates(ontology: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """One row per distinct name or main type, with the match it stands for.

    Of equal texts the first tumour counts, and its name before its main type.
    """
    tumor = F.struct("name", "code", "mainType")
    forms = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("name").alias("text")),
        F.struct(F.lit(1).alias("kind"), F.col("mainType").alias("text")),
    )
    rows = ontology.select("ordinal", tumor.alias("_tumor"), F.explode(forms).alias("_form")).select(
        F.col("ordinal").cast("bigint").alias("ordinal"),
        F.col("_form.kind").alias("kind"),
        (F.lower("_form.text") if case_insensitive else F.col("_form.text")).alias("text"),
        match_record(F.col("_form.kind"), F.col("_tumor")).alias("match"),
    )
    rows = rows.filter(F.col("text").isNotNull()).withColumn("_place", _place())
    first = rows.groupBy(F.col("text").alias("_text")).agg(F.min("_place").alias("_first"))
    chosen = rows.join(first, (F.col("text") == F.col("_text")) & (F.col("_place") == F.col("_first")))
    return chosen.select("text", "ordinal", "kind", "match")


def _place() -> Column:
    """Order of candidates as one number: by tumour, its name before its main type."""
    return F.col("ordinal") * 2 + F.col("kind")


def match_exact(
    indications: DataFrame, ontology: DataFrame, on: str = "cleaned", case_insensitive: bool = False
) -> DataFrame:
    """Indications with the `match` whose text equals theirs, or null."""
    candidates = match_candidates(ontology, case_insensitive).select(F.col("text").alias("_text"), "match")
    usable = (F.col(on) == F.col("_text")) & (F.col(on) != "")
    return indications.join(candidates, usable, "left").drop("_text")


def match_fuzzy(
    indications: DataFrame,
    ontology: DataFrame,
    on: str = "cleaned",
    threshold: int = THRESHOLD,
    method: str = "levenshtein",
) -> DataFrame:
    """Distinct texts with the best `match` scoring above the threshold; the earliest wins a tie.

    Candidates and scores, which are read several times, are written once. ``levenshtein`` finds pairs by an index that misses none. ``tokens`` is for
    texts whose words are in another order or come with others: the better of the token-set score
    and of Levenshtein between the sorted words, each by an index that misses none. ``wratio`` is the weighted ratio of
    difflib; a shared letter pair is all that a score above the threshold implies, so no index
    spares comparisons: every text is compared with every candidate, in blocks. Use it for small
    vocabularies.
    """
    scored, candidates = _scored(indications, ontology, on, threshold, method)
    top = scored.groupBy(F.col(on).alias("_on")).agg(F.max("score").alias("_top"))
    tied = scored.join(top, (F.col(on) == F.col("_on")) & (F.col("score") == F.col("_top")))
    first = tied.groupBy(on, "score").agg(F.min("_place").alias("_first"))
    return first.join(candidates, F.col("_first") == _place()).select(on, "score", "match")


def best_candidates(
    indications: DataFrame, ontology: DataFrame, on: str = "cleaned", k: int = 5, threshold: int = THRESHOLD, method: str = "levenshtein"
) -> DataFrame:
    """The ``k`` best candidates of each distinct text above the threshold: text, rank from 1, score, match.

    Ties go to the earlier candidate. Only k rows of a text leave a task, however many score.
    """
    scored, candidates = _scored(indications, ontology, on, threshold, method)
    order = Window.partitionBy(on).orderBy(F.col("score").desc(), "_place")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    matches = candidates.select(_place().alias("_candidate"), "match")
    return ranked.join(matches, F.col("_place") == F.col("_candidate")).select(on, "rank", "score", "match")


def _scored(indications: DataFrame, ontology: DataFrame, on: str, threshold: int, method: str) -> tuple[DataFrame, DataFrame]:
    """(text, score, _place) of the pairs above the threshold, and the candidates; both written."""
    texts = indications.select(F.col(on)).filter(F.col(on) != "").distinct()
    candidates = materialize(match_candidates(ontology), "candidates")
    scores = {"wratio": _weighted_scores, "levenshtein": _levenshtein_scores, "tokens": _token_scores}[method]
    scored = scores(texts, candidates.select("text", _place().alias("_place")), on, threshold)
    return materialize(scored, "scored"), candidates


def normal_form(text: Column) -> Column:
    """A candidate as indications are cleaned: lower case, without special characters."""
    return strip(F.lower(F.regexp_replace(text, r"(?U)[^a-zA-Z0-9\s\x1c-\x1f]", "")))


def _levenshtein_scores(texts: DataFrame, candidates: DataFrame, on: str, threshold: int) -> DataFrame:
    """Text, score and place of all (text, candidate) pairs above the threshold, found by shared segments.

    A score above t leaves a candidate of length n at most k edits, k being the largest whole
    number below ``n * (100 - t) / t``. Cut into k + 2 + s segments, the candidate has s + 2 that
    no edit touches, which stand unchanged in the text. So its s most frequent segments need not
    be looked up, and two of the others must be found: a common ending such as a word that most
    names share brings no pairs together. An unchanged
    segment is shifted by some edits before it and the rest of the length's difference after
    it, k in all at most. Texts are cut at the places this allows, for each candidate length they
    can match, and an equi-join on (length, number of the segment, segment) finds every pair.
    """
    if not 50 <= threshold < 100:
        raise ValueError("levenshtein matching needs a threshold from 50 to 99")
    miss = 100 - threshold
    size, piece, pieces, edits, length = (F.col(c) for c in ("_size", "_piece", "_pieces", "_edits", "_length"))
    most_edits = F.floor((size * miss + (threshold - 1)) / threshold).cast("int") - 1

    def with_pieces(df: DataFrame) -> DataFrame:
        counted = df.withColumn("_edits", F.greatest(F.lit(0), most_edits))
        counted = counted.withColumn("_pieces", F.least(size, edits + 2 + SPARE_SEGMENTS))
        counted = counted.withColumn("_need", F.least(F.lit(2), pieces - edits))
        return counted.withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))

    start = F.floor(piece * size / pieces).cast("int")
    width = F.floor((piece + 1) * size / pieces).cast("int") - start
    key = ["_size", "_piece", "_segment"]
    names = candidates.withColumn("_name", normal_form(F.col("text"))).filter(F.col("_name") != "")
    named = names.select("_name").distinct().withColumn("_size", F.length("_name"))
    segments = with_pieces(named).withColumn("_segment", F.substring(F.col("_name"), start + 1, width))
    frequent = segments.groupBy(*key).agg(F.count(F.lit(1)).alias("_names"))
    by_count = Window.partitionBy("_name").orderBy("_names", "_piece")
    segments = segments.join(frequent, key).withColumn("_rank", F.row_number().over(by_count))
    segments = segments.filter(F.col("_rank") <= edits + F.col("_need")).select("_name", "_need", *key)

    longest = named.agg(F.max("_size")).scalar()
    near = F.abs(length - size) * 100 < F.greatest(length, size) * miss
    low, high = F.greatest(F.lit(1), F.floor(length * threshold / 100).cast("int")), F.ceil(length * 100 / threshold).cast("int")
    fitting = texts.withColumn("_length", F.length(on)).filter(length * threshold < F.coalesce(longest, F.lit(0)) * 100 + 100)
    sized = fitting.withColumn("_size", F.explode(F.sequence(low, F.greatest(low, F.least(high, longest))))).filter(near)
    sized = sized.join(named.select("_size").distinct(), "_size")
    difference = length - size
    allowed = F.ceil(F.greatest(length, size) * miss / 100).cast("int") - 1  # edits between these two lengths
    slack = F.floor((allowed - F.abs(difference)) / 2).cast("int")
    cuts = (
        with_pieces(sized).filter(F.abs(difference) <= allowed)
        .withColumn("_shift", F.explode(F.sequence(F.least(F.lit(0), difference) - slack, F.greatest(F.lit(0), difference) + slack)))
        .withColumn("_at", start + F.col("_shift")).filter((F.col("_at") >= 0) & (F.col("_at") + width <= length))
        .select(on, "_size", "_piece", F.substring(F.col(on), F.col("_at") + 1, width).alias("_segment")).distinct()
    )
    found = cuts.join(segments, key).groupBy(on, "_name", "_need").agg(F.count(F.lit(1)).alias("_found"))
    pairs = found.filter(F.col("_found") >= F.col("_need")).select(on, "_name")
    scored = pairs.withColumn("score", fuzzy.levenshtein_score(F.col(on), F.col("_name"))).filter(F.col("score") > threshold)
    return scored.join(names, "_name").select(on, "score", "_place")


def _token_scores(texts: DataFrame, candidates: DataFrame, on: str, threshold: int) -> DataFrame:
    """Text, score and place of all pairs whose words are alike as a set or, sorted, by Levenshtein."""
    named = candidates.select(normal_form(F.col("text")).alias("_name"), "_place").filter(F.col("_name") != "")
    sets = token_match.token_set_pairs(texts.select(F.col(on).alias("text")), named.select(F.col("_name").alias("name")), threshold)
    of_sets = sets.join(named, F.col("name") == F.col("_name")).select(F.col("text").alias(on), "score", "_place")
    ordered = materialize(texts.select(on, token_match.in_order(F.col(on)).alias("_ordered")), "ordered_texts")
    names = named.select(token_match.in_order(F.col("_name")).alias("text"), "_place")
    edits = _levenshtein_scores(ordered.select("_ordered").filter("_ordered <> ''").distinct(), names, "_ordered", threshold)
    of_edits = edits.join(ordered, "_ordered").select(on, "score", "_place")
    return of_sets.unionByName(of_edits).groupBy(on, "_place").agg(F.max("score").alias("score"))


def _weighted_scores(texts: DataFrame, candidates: DataFrame, on: str, threshold: int) -> DataFrame:
    """Text, score and place of each text's best candidate in each block of candidates."""
    n_texts = F.greatest(F.lit(1), F.ceil(texts.agg(F.count(F.lit(1))).scalar() / BLOCK))
    n_names = F.greatest(F.lit(1), F.ceil(candidates.agg(F.count(F.lit(1))).scalar() / BLOCK))
    of_text = F.pmod(F.xxhash64(on), n_texts)
    of_name = F.pmod(F.xxhash64("text"), n_names)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    left = texts.select(on, of_text.alias("_text_block"), every(n_names).alias("_name_block"))
    right = candidates.select("text", "_place", of_name.alias("_name_block"), every(n_texts).alias("_text_block"))

    def score(block: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
        names = names.sort_values("_place", ignore_index=True)
        best = fuzzy.Candidates(names["text"].tolist()).best
        hits = [(text, best(text, threshold)) for text in block[on]]
        found = [(text, float(hit[1]), int(names["_place"][hit[0]])) for text, hit in hits if hit]
        return pd.DataFrame(found, columns=[on, "score", "_place"])

    grouped = left.groupBy("_text_block", "_name_block").cogroup(right.groupBy("_text_block", "_name_block"))
    return grouped.applyInPandas(score, f"`{on}` string, score double, _place bigint")


def map_indications(
    df: DataFrame,
    ontology: DataFrame,
    disease: str = "Disease",
    threshold: int = THRESHOLD,
    method: str = "levenshtein",
    case_insensitive: bool = False,
) -> DataFrame:
    """One row per distinct indication: matched_name, code and mainType, null where unmapped.

    ``case_insensitive`` concerns the exact match; the fuzzy one compares normal forms anyway.
    """
    indications = df.select(disease).distinct().withColumn("cleaned", clean_indication(disease))
    exact = match_exact(indications, ontology, "cleaned", case_insensitive)
    near = match_fuzzy(exact.filter(F.col("match").isNull()), ontology, "cleaned", threshold, method)
    matched = exact.join(near.select("cleaned", F.col("match").alias("_near")), "cleaned", "left")
    return matched.select(disease, F.coalesce("match", "_near").alias("match")).select(disease, "match.*")


def map_back(df: DataFrame, mapping: DataFrame, groups: DataFrame, disease: str = "Disease") -> DataFrame:
    """Rows with Mapped_Indication, OncoTree_Code, Main_Type and Top_Level_Group."""
    columns = mapping.select(
        disease,
        mapped_label("matched_name", "mainType").alias("Mapped_Indication"),
        F.col("code").alias("OncoTree_Code"),
        F.col("mainType").alias("Main_Type"),
    )
    return top_level_group(apply_mapping(df, columns, disease), groups)
