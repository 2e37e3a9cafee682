"""Fuzzy deduplication of lines by MinHash, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from litquarry.functions.binding import bind
from litquarry.llm.alike import BROADCAST_ROWS, alike_links, sized, with_jaccard
from litquarry.llm.common import documents, free_prefix, known_id, text_or_empty
from litquarry.llm.components import components
from litquarry.llm.registry import query
from litquarry.session import TURNS, discard, in_turns, materialize, materialize_all

LEAST_CHARS = 20
"""Characters a line needs, after normalisation, to be compared; shorter lines always stay."""
SHINGLE = 5
"""Characters of a shingle."""
SIMILARITY = 0.8
BANDS = 10
"""Bands of a line: one before and one after each of five points of the hashes' circle."""
BAND_SHINGLES = 6
"""Hashes that make a band."""
MANY_WORDS = 32
"""Words from which on a line is also represented by the shingles at its words alone."""
ENOUGH_WORDS = 48
"""Words from which on a line is represented by these alone; lines in between are comparable with both sides."""

TURN_ROWS = 1_000_000
"""Lines from which on their signatures are shuffled in turns."""

_POINTS = [-(1 << 63) + i * ((1 << 64) // (BANDS // 2)) for i in range(1, BANDS // 2)]


def normalised(line: Column) -> Column:
    """Lower case, with single spaces, and none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), "[ \\x09-\\x0D]{2,}|[\\x09-\\x0D]", " "))


def shingles(line: Column) -> Column:
    """Hashes of all character shingles of a normalised line, an array; the line needs SHINGLE characters."""
    found = F.regexp_extract_all(line, F.lit(f"(?s)(?=(.{{{SHINGLE}}}))"), F.lit(1))
    return F.transform(found, lambda s: F.xxhash64(s))


def word_start_shingles(line: Column) -> Column:
    """Hashes of the character shingles that begin at a word, an array."""
    found = F.regexp_extract_all(F.concat(F.lit(" "), line), F.lit(f"(?s) (?=(.{{{SHINGLE}}}))"), F.lit(1))
    return F.transform(found, lambda s: F.xxhash64(s))


def bands(line: Column) -> Column:
    """The band keys of a normalised line, an array.

    The signature takes the distinct shingles of the line: all of them, or, of a line of many words,
    those that begin at a word, which are a sample of them by content; lines of a medium number of
    words have both kinds of bands. The hashes lie on a circle, and a band is the BAND_SHINGLES
    hashes next to one of five points on it, on one side: the smallest ones under the permutation
    that starts there and runs that way. Two lines share a band with about the sixth power of
    their similarity.
    """
    size = F.lit(BAND_SHINGLES)

    def keys(hashes: Column, kind: int) -> Column:
        def of_sorted(circle: Column) -> Column:
            n = F.size(circle)
            below = F.transform(F.array(*map(F.lit, _POINTS)), lambda point: F.size(F.filter(circle, lambda h: h < point)))
            starts = bind(below, lambda at: F.concat(F.array(F.lit(0), -size), at, F.transform(at, lambda x: x - size)))
            # The circle cut open, its last hashes repeated before the first and its first after the last.
            open_ = F.concat(F.slice(circle, F.greatest(F.lit(1), n - size + 1), size), circle, F.slice(circle, 1, BAND_SHINGLES))
            band = lambda c, at: F.slice(c, F.greatest(F.lit(1), at + size + 1), size)
            return bind(open_, lambda c: F.transform(starts, lambda at, i: F.xxhash64(band(c, at), i, F.lit(kind))))

        return bind(F.sort_array(F.array_distinct(hashes)), of_sorted)

    words = F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    every, sample = keys(shingles(line), 0), keys(word_start_shingles(line), 1)
    return F.when(words < MANY_WORDS, every).when(words >= ENOUGH_WORDS, sample).otherwise(F.concat(every, sample))


def with_similarity(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """``df`` with the Jaccard similarity of the sets of all character shingles of two lines.

    Shingles are compared by their 64-bit hashes; both lines need SHINGLE characters.
    """
    return with_jaccard(df, a, b, shingles, name)


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line_no, h1, h2 and norm of every line that is long enough."""
    return (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
            F.posexplode(F.split(text_or_empty(), "\n", -1)).alias("line_no", "line"),
        )
        .select("doc_id", "text_hash", "line_no", F.explode(F.array(normalised(F.col("line")))).alias("norm"))
        .filter(F.length("norm") >= LEAST_CHARS)
        .withColumn("h1", F.xxhash64("norm")).withColumn("h2", F.xxhash64("norm", F.lit(1)))
    )


def _texts(docs: DataFrame, lines: DataFrame, wanted: DataFrame) -> list[DataFrame]:
    """(h1, norm, times) of the wanted lines, each read from the first document that holds it; in parts if the documents are shuffled."""
    place = F.struct("doc_id", "text_hash", "line_no")
    places = lines.join(sized(wanted), "h1").groupBy("h1").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("times"))
    by_document = places.select("h1", "times", "place.*").groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("line_no", "h1", "times")).alias("places")
    )
    by_document = materialize(by_document.select(F.col("doc_id").alias("w_id"), F.col("text_hash").alias("w_hash"), "places"), "places")
    few = wanted.count() <= BROADCAST_ROWS
    doc_id, text_hash = _document()
    held = docs.select(doc_id.alias("doc_id"), text_hash.alias("text_hash"), "text")

    def of(some: DataFrame, places: DataFrame) -> DataFrame:
        if few:
            places = F.broadcast(places)
        cut = some.join(places, F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash"))).select("places", F.split("text", "\n", -1).alias("lines"))
        found = F.transform("places", lambda p: F.struct(p["h1"].alias("h1"), p["times"].alias("times"), normalised(F.get("lines", p["line_no"])).alias("norm")))
        return cut.select(F.inline(found)).filter(F.xxhash64("norm") == F.col("h1")).groupBy("h1").agg(F.min("norm").alias("norm"), F.max("times").alias("times"))

    turns = 1 if few else TURNS
    parts = zip(in_turns(held, F.col("text_hash"), turns), in_turns(by_document, F.col("w_hash"), turns), strict=True)
    return [of(some, places) for some, places in parts]


def similar_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(a, b) of line hashes; their components are those of all lines that share a band and are SIMILARITY alike."""
    parts = in_turns(lines.select("h1", "bands"), F.col("h1"), min(TURNS, 1 + lines.count() // TURN_ROWS))
    banded = materialize_all([p.dropDuplicates(["h1"]).select("h1", F.explode("bands").alias("band")) for p in parts], "banded")
    return alike_links(banded, lambda wanted: _texts(docs, lines, wanted), shingles, SIMILARITY)


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, numbers and all_numbers of every document that loses a line.

    Of equal and similar lines the one with the smallest doc_id stays (null ids last), then the
    smallest hash of the document's text and the smallest line number; ``numbers`` are those of the
    lines that go. Rows with the same id and text are one document here: the first of them loses
    ``numbers`` and the others ``all_numbers``, every line that is compared.
    """
    lines = materialize(_lines(docs).withColumn("bands", bands(F.col("norm"))).drop("norm"), "lines")
    linked = materialize(components(similar_lines(docs, lines)), "linked")
    place = F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0)).alias("doc"),
        F.col("text_hash").alias("text"), F.col("line_no").alias("line"),
    )
    groups = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("place"))
    groups = groups.join(sized(linked), F.col("h1") == F.col("node"), "left").filter("n > 1 or root is not null")
    groups = materialize(
        groups.select("h1", "h2", F.coalesce("root", "h1").alias("root"), F.when(F.col("root").isNull(), F.col("h2")).otherwise(0).alias("rest"), "place"),
        "line_groups",
    )
    first = materialize(groups.groupBy("root", "rest").agg(F.min("place").alias("stays")), "first")
    kept = materialize(groups.join(sized(first), ["root", "rest"]).select("h1", "h2", "stays"), "stays")
    marked = lines.select("doc_id", "text_hash", "line_no", "h1", "h2", place.alias("place")).join(sized(kept), ["h1", "h2"])
    gone = marked.filter(F.col("place") != F.col("stays")).select("doc_id", "text_hash", "line_no", F.lit(True).alias("goes"))
    doc_id, text_hash = _document()
    repeated = docs.select(doc_id.alias("doc_id"), text_hash.alias("text_hash")).groupBy("doc_id", "text_hash").count().filter("count > 1").select(
        F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash")
    )
    repeated = materialize(repeated, "repeated")
    again = lines.join(
        sized(repeated), F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash")), "left_semi"
    ).select("doc_id", "text_hash", "line_no", F.lit(False).alias("goes"))
    drops = materialize(
        gone.unionByName(again).groupBy("doc_id", "text_hash").agg(
            F.collect_set(F.when(F.col("goes"), F.col("line_no"))).alias("numbers"), F.collect_set("line_no").alias("all_numbers")
        ),
        "drops",
    )
    discard(lines, linked, groups, first, kept, repeated)
    return drops


def _with_drops(rows: DataFrame, docs: DataFrame, own: str) -> DataFrame:
    """``rows``, with ``own`` id and hash of their documents, and the new column ``own`` gone of line numbers, null for none.

    Copies are numbered and joined by the same two columns, so the texts move once.
    """
    key = [own + "id", own + "hash"]
    drops = dropped_lines(docs).select(
        known_id("doc_id").alias(key[0]), F.col("text_hash").alias(key[1]),
        F.col("numbers").alias(own + "numbers"), F.col("all_numbers").alias(own + "all_numbers"),
    )
    copy = Window.partitionBy(*key).orderBy(key[1])
    gone = F.when(F.col(own + "copy") == 1, F.col(own + "numbers")).otherwise(F.col(own + "all_numbers"))
    joined = rows.withColumn(own + "copy", F.row_number().over(copy)).join(drops, key, "left")
    return joined.withColumn(own + "gone", gone).drop(*[own + name for name in ("copy", "numbers", "all_numbers")])


def _document() -> tuple[Column, Column]:
    return F.col("doc_id").cast("long"), F.xxhash64("text")


def decisions(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and dropped_lines, the sorted numbers from 0, of every row.

    Lines are divided by ``\\n`` and compared in lower case with single spaces; a line of fewer than
    LEAST_CHARS characters stays. Lines are alike at a Jaccard similarity of SIMILARITY or more of
    their character shingles, and one line of each component of alike lines stays. A null or empty
    text is one empty line. Of rows that repeat id and text, all but one lose every line that is
    compared. Null ids are compared like others. An empty table gives an empty result; other
    columns are not read.
    """
    text_hash = _document()[1]
    rows = docs.select("doc_id", known_id("doc_id").alias("__id"), text_hash.alias("__hash"), (F.length(text_or_empty()) - F.length(F.replace(text_or_empty(), F.lit("\n"), F.lit(""))) + 1).alias("n_lines"))
    gone = F.coalesce(F.array_sort("__gone"), F.array().cast("array<int>"))
    return _with_drops(rows, docs, "__").select("doc_id", "n_lines", F.size(gone).alias("n_dropped"), gone.alias("dropped_lines"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without the lines that go; a document that has lost lines and has no word left goes too.

    All columns are kept, whatever their names; n_chars, where there is one, follows the text.
    """
    own = free_prefix(docs.columns)
    gone, goes = own + "gone", own + "lost"
    marked = _with_drops(docs.withColumn(own + "id", known_id("doc_id")).withColumn(own + "hash", _document()[1]), docs, own)
    lost = F.size(F.coalesce(gone, F.array().cast("array<int>"))) > 0
    left = F.array_join(F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains(gone, i)), "\n")
    out = marked.withColumn(goes, lost).withColumn("text", F.when(F.col(goes), left).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(goes), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    blank = F.col("text").rlike("^[ \\x09-\\x0D]*$")
    return out.filter(~(F.col(goes) & blank)).select(*[F.col(f"`{c}`") for c in docs.columns])


@query()
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions(documents(spark, sf_dir))
