"""Scores of texts by their tokens, whatever their order, found through posting lists of rare tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from litquarry.functions.binding import bind
from litquarry.session import materialize


def tokens(text: Column) -> Column:
    """Distinct words of a text in normal form, sorted."""
    return F.array_sort(F.array_distinct(F.array_remove(F.split(text, r"\s+"), "")))


def in_order(text: Column) -> Column:
    """All words of a text in normal form, sorted and joined."""
    return F.array_join(F.array_sort(F.array_remove(F.split(text, r"\s+"), "")), " ")


def letters(words: Column) -> Column:
    return F.aggregate(words, F.lit(0), lambda n, w: n + F.length(w))


def token_set_score(left: Column, right: Column) -> Column:
    """100 for equal sets of words, 0 for none in common: the share of letters that are in common words."""
    return F.lit(200.0) * letters(F.array_intersect(left, right)) / (letters(left) + letters(right))


def token_set_pairs(texts: DataFrame, names: DataFrame, threshold: int) -> DataFrame:
    """(text, name, score) of all pairs of ``texts`` (text) and ``names`` (name) whose token-set score is above the threshold.

    With a score above t, the common words of two sets have more than t / (200 - t) of the letters of each.
    In an order of all words that starts with those in fewest names, the first common word of a
    pair therefore has that many letters at and after it in both sets. So each set is listed under
    the words of which that is true, and pairs meet in a word; a word that many names share is
    last in the order and, unless it is most of a name, in no list.
    """
    if not 0 <= threshold < 100:
        raise ValueError("token matching needs a threshold from 0 to 99")
    wanted = texts.select(F.col("text").alias("key")).distinct().withColumn("words", tokens(F.col("key")))
    listed = materialize(names.select(F.col("name").alias("key")).distinct().withColumn("words", tokens(F.col("key"))), "token_names")
    often = listed.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    often = materialize(often, "token_counts")

    def postings(sets: DataFrame) -> DataFrame:
        one = sets.select("key", F.explode("words").alias("word")).join(often, "word", "left")
        place = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word")
        ordered = one.groupBy("key").agg(F.array_sort(F.collect_list(place)).alias("all"))

        def prefix(every: Column) -> Column:
            size = lambda some: letters(F.transform(some, lambda x: x["word"]))
            least = bind(size(every), lambda whole: whole * threshold / (200 - threshold))
            return bind(least, lambda m: F.filter(every, lambda x, i: size(F.slice(every, i + 1, F.size(every))) > m))

        return ordered.select("key", F.explode(prefix(F.col("all"))).alias("x")).filter("x.n > 0").select("key", "x.word")

    met = postings(wanted).withColumnRenamed("key", "text").join(postings(listed).withColumnRenamed("key", "name"), "word")
    pairs = met.select("text", "name").distinct()
    scored = pairs.withColumn("score", token_set_score(tokens(F.col("text")), tokens(F.col("name"))))
    return scored.filter(F.col("score") > threshold)
