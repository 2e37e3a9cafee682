"""Near duplicates by SimHash, found through deletion-variant signatures; the pipeline's stage adds MinHash."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from litquarry.functions.binding import bind
from litquarry.llm.alike import BROADCAST_ROWS, alike_links, sized
from litquarry.llm.common import documents, free_prefix, known_id, text_or_empty
from litquarry.llm.components import components
from litquarry.llm.line_dedup import normalised
from litquarry.llm.registry import query
from litquarry.session import TURNS, discard, in_turns, materialize

WORDS = 3
"""Words in a shingle of the query's contract."""
DISTANCE = 3
"""Most differing bits of a link."""
SEED = 42
NEAR_WORDS = 5
"""Words in a shingle of the pipeline's stage."""
NEAR_SIMILARITY = 0.8
"""Least Jaccard similarity of near copies."""
NEAR_POINTS = 5
"""Points of the hashes' circle; a document has one band before and one after each."""
NEAR_BAND = 3
"""Hashes that make a band."""

_HASH = partial(xxhash.xxh64_intdigest, seed=SEED)
_CHUNK = 1 << 15


def fingerprint(text: str, words: int = WORDS) -> int:
    """Signed 64-bit SimHash of the text's word shingles, repeats included; 0 without a word."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) <= words:
        return int(np.uint64(_HASH(b" ".join(found))).astype(np.int64))
    total = np.zeros(64, np.int64)
    for part in _shingle_hashes(found, words):
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * total > len(found) - words + 1).view(">i8")[0])


def _shingle_hashes(found: list[bytes], words: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles of ``words`` words, in parts; fewer words are one shingle."""
    joined = b" ".join(found)
    words = min(words, len(found))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends + 1])[:len(found) - words + 1].tolist()
    ends = ends[words - 1:].tolist()
    for low in range(0, len(starts), _CHUNK):
        yield np.array([_HASH(joined[a:b]) for a, b in zip(starts[low:low + _CHUNK], ends[low:low + _CHUNK])], np.uint64)


def near_bands(norm: str, words: int = NEAR_WORDS) -> list[int]:
    """The band keys of a normalised text: the hashes of its distinct shingles next to each point of their circle, on each side."""
    found = norm.encode("utf-8", "surrogatepass").split(b" ")
    hashes = np.unique(np.concatenate(list(_shingle_hashes(found, words))))
    keys = []
    for i in range(NEAR_POINTS):
        above = int(np.searchsorted(hashes, np.uint64(i * ((1 << 64) // NEAR_POINTS))))
        for places in (above + np.arange(NEAR_BAND), above - 1 - np.arange(NEAR_BAND)):
            keys.append(_HASH(bytes([len(keys)]) + hashes[places % len(hashes)].tobytes()))
    return np.array(keys, np.uint64).astype(np.int64).tolist()


def word_shingles(norm: Column, words: int = NEAR_WORDS) -> Column:
    """Hashes of the shingles of a normalised text, an array; fewer words are one shingle."""

    def hashes(found: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(found) - words + 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(found, i, F.lit(words))))

    return bind(F.split(norm, " "), hashes)


def with_fingerprint(docs: DataFrame, name: str, words: int = WORDS) -> DataFrame:
    """The documents with their fingerprint as a new long column."""

    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return docs.withColumn(name, fingerprints(text_or_empty()))


def links(prints: DataFrame) -> DataFrame:
    """(a, b) of the fingerprints that differ in 1 to 3 bits; ``prints`` has one row per fingerprint, ``fp``."""
    whole = prints.select("fp", F.lit(0).cast("long").alias("same"), F.col("fp").alias("rest"))
    return _meet(whole, 64).distinct()


def _near() -> Column:
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE


def _meet(frame: DataFrame, width: int) -> DataFrame:
    """Links among the fingerprints with equal ``same`` bits, which differ in the ``width`` bits of ``rest`` only.

    ``rest`` is cut into two segments, one of which differs in at most one bit. A segment is indexed
    under each of its one-wildcard variants, on the side of the bit that the wildcard hides:
    segments that differ in one bit meet in exactly one variant, on opposite sides, and are
    verified. Equal segments join ``same``, and the other half is cut in turn, so no key lists all
    pairs of its fingerprints unless 56 of the 64 bits agree, which at most 256 can.
    """
    if width <= 8:
        left, right = frame.select("same", F.col("fp").alias("a")), frame.select("same", F.col("fp").alias("b"))
        return left.join(right, "same").filter("a < b").filter(_near()).select("a", "b")
    half = width // 2
    mask = F.lit((1 << half) - 1)
    low = F.col("rest").bitwiseAND(mask)
    high = F.shiftrightunsigned("rest", half).bitwiseAND(mask)
    cut = frame.select("fp", F.explode(F.array(
        F.struct(F.shiftleft("same", 1).alias("place"), low.alias("bits"), high.alias("other")),
        F.struct((F.shiftleft("same", 1) + 1).alias("place"), high.alias("bits"), low.alias("other")),
    )).alias("s")).select("fp", "s.*")
    variants = cut.select("fp", F.explode(F.array(*[
        F.struct(
            F.shiftleft(F.col("place") * half + i, half)
            .bitwiseOR(F.col("bits").bitwiseAND(F.lit(((1 << half) - 1) ^ (1 << i)))).alias("key"),
            (F.col("bits").bitwiseAND(F.lit(1 << i)) != 0).alias("bit"),
        )
        for i in range(half)
    ])).alias("v")).select("fp", "v.*")
    off = variants.filter("not bit").select("key", F.col("fp").alias("a"))
    on = variants.filter("bit").select("key", F.col("fp").alias("b"))
    # Spark sizes the variants by the table they are made of, which is 32 times smaller, and would broadcast them.
    apart = off.join(on.hint("merge"), "key").filter(_near()).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    equal = cut.select("fp", F.shiftleft("place", half).bitwiseOR(F.col("bits")).alias("same"), F.col("other").alias("rest"))
    shared = equal.groupBy("same").count().filter("count > 1").select("same")
    return apart.unionByName(_meet(materialize(equal.join(shared, "same", "left_semi"), "segments"), half))


def near_components(prints: DataFrame) -> DataFrame:
    """(fp, root, component_id): each fingerprint's component and the smallest doc_id in it, from rows of (doc_id, fp)."""
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    linked = components(links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    rooted = distinct.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "root", "component_id")


def simhash_components(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fingerprint and component_id of every row.

    Texts are lower-cased for A-Z only; a shingle is ``words`` words, fewer words are one shingle,
    and a text without a word, null texts included, has fingerprint zero, linked like any other.
    Repeated rows share a fingerprint. A null id has a fingerprint but never names a component
    unless the component has no other id. An empty table gives an empty result; other columns are
    not read.
    """
    prints = with_fingerprint(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "fp", words)
    prints = materialize(prints.select("doc_id", "fp"), "prints")
    found = near_components(prints)
    return prints.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _of_linked_prints(prints: DataFrame) -> DataFrame:
    """(a, b) of hashes h1: a star over the texts of each component of fingerprints."""
    rooted = prints.select("h1", "fp").distinct().join(near_components(prints.select("doc_id", "fp")), "fp").select("h1", "root")
    rooted = materialize(rooted, "rooted")
    return rooted.join(rooted.groupBy("root").agg(F.min("h1").alias("a")), "root").select("a", F.col("h1").alias("b")).filter("a <> b")


def signed(texts: DataFrame, words: int, fingerprints: bool) -> DataFrame:
    """doc_id, digest, fp, h1 and bands of rows of (doc_id, digest, text, norm); ``fp`` is 0 without ``fingerprints``.

    Both signatures come from one UDF: each one of its own would hold a Python worker for each core,
    and workers live on with what they have learned in later stages.
    """
    kind = "fp long, bands array<long>"

    @F.pandas_udf(kind)
    def of_both(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for given, norms in batches:
            yield pd.DataFrame({"fp": pd.Series([fingerprint(t) for t in given], dtype="int64"), "bands": [near_bands(t, words) for t in norms]})

    @F.pandas_udf(kind)
    def of_norm(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for norms in batches:
            yield pd.DataFrame({"fp": np.zeros(len(norms), np.int64), "bands": [near_bands(t, words) for t in norms]})

    found = of_both("text", "norm") if fingerprints else of_norm("norm")
    signatures = texts.select("doc_id", "digest", F.xxhash64("norm").alias("h1"), found.alias("found"))
    return signatures.select("doc_id", "digest", "found.fp", "h1", "found.bands")


def near_dedup(docs: DataFrame, words: int = NEAR_WORDS, fingerprints: bool = False) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest doc_id stays.

    Documents are near duplicates at a Jaccard similarity of NEAR_SIMILARITY or more of their
    distinct shingles of ``words`` words, in lower case with single spaces; MinHash bands propose
    pairs and the shingles decide. With ``fingerprints``, as in the pipeline, those whose SimHash fingerprints
    ``simhash_components`` links are near duplicates too, and components are those of both kinds of links. Ties, such as repeated rows, go to the smaller digest of the
    text and then to any one row; null ids come last. All columns are kept, whatever their names.
    Rows without a word are one component, so one of them stays.
    """
    digest, known, row = (free_prefix(docs.columns) + name for name in ("text", "id", "row"))
    marked = docs.withColumn(digest, F.xxhash64(text_or_empty())).withColumn(known, known_id("doc_id"))
    norm = normalised(text_or_empty())

    prints = signed(
        marked.select(F.col(known).alias("doc_id"), F.col(digest).alias("digest"), text_or_empty().alias("text"), norm.alias("norm")),
        words, fingerprints,
    )
    prints = materialize(prints, "prints")

    def texts_of(wanted: DataFrame) -> list[DataFrame]:
        place = F.struct("doc_id", "digest")
        places = prints.join(sized(wanted), "h1").groupBy("h1").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("times"))
        places = materialize(places.groupBy("place").agg(F.max("times").alias("times")).select("place.*", "times"), "places")
        few = places.count() <= BROADCAST_ROWS
        rows = marked.select(F.col(known).alias("doc_id"), F.col(digest).alias("digest"), "text")

        def of(some: DataFrame, places: DataFrame) -> DataFrame:
            held = some.join(F.broadcast(places) if few else places, ["doc_id", "digest"]).select(normalised(text_or_empty()).alias("norm"), "times")
            return held.groupBy(F.xxhash64("norm").alias("h1")).agg(F.min("norm").alias("norm"), F.max("times").alias("times"))

        turns = 1 if few else TURNS
        parts = zip(in_turns(rows, F.col("digest"), turns), in_turns(places, F.col("digest"), turns), strict=True)
        return [of(some, of_some) for some, of_some in parts]

    banded = materialize(prints.select("h1", F.explode("bands").alias("band")).distinct(), "banded")
    links_ = alike_links(banded, texts_of, lambda t: word_shingles(t, words), NEAR_SIMILARITY)
    linked = materialize(components(links_.unionByName(_of_linked_prints(prints)) if fingerprints else links_), "linked")
    keep = (
        prints.join(sized(linked), F.col("h1") == F.col("node"), "left").groupBy(F.coalesce("root", "h1").alias("root"))
        .agg(F.min(F.struct("doc_id", "digest")).alias("first"))
        .select(F.col("first.doc_id").alias(known), F.col("first.digest").alias(digest))
    )
    keep = materialize(keep, "kept")
    # Only rows that repeat id and text are numbered, so that all other texts stay where they are.
    repeated = prints.groupBy("doc_id", "digest").count().filter("count > 1").select(F.col("doc_id").alias(known), F.col("digest").alias(digest))
    repeated = sized(materialize(repeated, "repeated"))
    discard(prints, linked)
    first = Window.partitionBy(known, digest).orderBy(digest)
    kept = marked.join(sized(keep), [known, digest], "left_semi")
    again = kept.join(repeated, [known, digest], "left_semi").withColumn(row, F.row_number().over(first)).filter(F.col(row) == 1)
    return kept.join(repeated, [known, digest], "left_anti").unionByName(again.drop(row)).drop(digest, known)


@query()
def op2_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))
