"""Benchmark decontamination by a generalised suffix automaton over the words of the test items."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from litquarry.llm.common import documents, text_or_empty, worker_model
from litquarry.llm.registry import query
from litquarry.session import materialize

WINDOW = 10
"""Words in a window of an item; an item of fewer words is one window."""
GROUP_WORDS = 500_000
"""Most words of items in one automaton; more items make more automata, each of which reads all documents."""
PIECE_WORDS = 1_000
"""Words of the pieces an item is cut into; neighbours share all but one word of a window."""
COVERAGE = 0.5
"""Share of hit words above which a document goes as a whole."""

# What is no word, by the contract, after A-Z are lower-cased.
NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

_NORMAL = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)

Item = tuple[str, list[bytes]]


def normalised(text: str) -> bytes:
    """UTF-8 with A-Z in lower case and a space for every byte that is in no word."""
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL)


class Automaton:
    """Suffix automaton of several word sequences, and the items of their windows.

    A state stands for the sequences that end at the same places of the items; ``link`` leads to
    the longest suffix that ends at more places.
    """

    def __init__(self, items: list[Item], window: int):
        self.window = window
        self.step: list[dict[bytes, int]] = [{}]
        self.longest, self.link = [0], [-1]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.least = min([window, *(len(words) for _, words in items if words)])
        self.full = self._windows()
        self.held: dict[int, set[str]] = {}
        """Items of the windows of ``window`` words, by the state that ``full`` gives."""
        self.short: dict[int, set[str]] = {}
        """Items of fewer words, by the state their last word leads to."""
        for name, words in items:
            state = 0
            for word in words:
                state = self.step[state][word]
                if self.full[state]:
                    self.held.setdefault(self.full[state], set()).add(name)
            if 0 < len(words) < window:
                self.short.setdefault(state, set()).add(name)
        self.inner = self._inner()

    def _state(self, longest: int, link: int, step: dict[bytes, int]) -> int:
        self.longest.append(longest)
        self.link.append(link)
        self.step.append(step)
        return len(self.link) - 1

    def _extend(self, last: int, word: bytes) -> int:
        """The state of the sequence of ``last`` and ``word``, made where no item has had it."""
        known = self.step[last].get(word)
        if known is not None:
            return known if self.longest[known] == self.longest[last] + 1 else self._split(last, word, known)
        new = self._state(self.longest[last] + 1, 0, {})
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = new
            last = self.link[last]
        if last >= 0:
            known = self.step[last][word]
            self.link[new] = known if self.longest[known] == self.longest[last] + 1 else self._split(last, word, known)
        return new

    def _split(self, state: int, word: bytes, known: int) -> int:
        """A state of its own for the sequences that lead from ``state`` to ``known`` and are shorter than its longest."""
        copy = self._state(self.longest[state] + 1, self.link[known], dict(self.step[known]))
        self.link[known] = copy
        while state >= 0 and self.step[state].get(word) == known:
            self.step[state][word] = copy
            state = self.link[state]
        return copy

    def _order(self) -> list[int]:
        return sorted(range(1, len(self.link)), key=self.longest.__getitem__)

    def _windows(self) -> list[int]:
        """For each state, the one that holds the last ``window`` words of its sequences; 0 for shorter ones."""
        found = [0] * len(self.link)
        for state in self._order():
            if self.longest[state] >= self.window:
                found[state] = found[self.link[state]] or state
        return found

    def _inner(self) -> list[int]:
        """For each state, the nearest one on its links, itself first, that is a short item; 0 for none."""
        found = [0] * len(self.link)
        if self.short:
            for state in self._order():
                found[state] = state if state in self.short else found[self.link[state]]
        return found

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of the words inside windows, in order and apart, and the items of these windows.

        ``state`` and ``size`` follow the longest match that ends at each word.
        """
        step, link, longest = self.step, self.link, self.longest
        spans: list[tuple[int, int]] = []
        full: set[int] = set()
        short: set[int] = set()
        state = size = 0
        for i, word in enumerate(words, 1):
            after = step[state].get(word)
            if after is None:
                while state >= 0 and word not in step[state]:
                    state = link[state]
                if state < 0:
                    state = size = 0
                    continue
                size = longest[state]
                after = step[state][word]
            state = after
            size += 1
            if size < self.least:
                continue
            if size >= self.window:
                full.add(self.full[state])
                _join(spans, i - size, i)
            if self.short:
                at = self.inner[state] if longest[state] <= size else self.inner[link[state]]
                if at:
                    short.add(at)
                    _join(spans, i - longest[at], i)
        names: set[str] = set()
        for at in full:
            names |= self.held[at]
        for at in short:
            while at:
                names |= self.short[at]
                at = self.inner[link[at]]
        return spans, names


def _join(spans: list[tuple[int, int]], start: int, end: int) -> None:
    while spans and spans[-1][1] >= start:
        start = min(start, spans.pop()[0])
    spans.append((start, end))


def item_groups(items: DataFrame, window: int = WINDOW) -> list[list[Item]]:
    """Pieces of all items, dealt to groups of at most GROUP_WORDS words by a hash.

    An item longer than PIECE_WORDS is cut into pieces that share ``window - 1`` words, so every
    window is in one of them. Each group is fetched on its own.
    """
    spark = items.sparkSession
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = F.array_remove(F.split(F.translate(text_or_empty(), upper, lower), NO_WORD), "")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)), F.lit(PIECE_WORDS))
    pieces = (
        items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.explode(F.array(found)).alias("words"))
        .filter(F.size("words") > 0)
        .select("item", F.explode(F.transform(starts, lambda at: F.slice("words", at, PIECE_WORDS + window - 1))).alias("words"))
        .distinct()
    )
    pieces = materialize(pieces.withColumn("hash", F.xxhash64("item", "words")), "pieces")
    groups = max(1, -(-(pieces.agg(F.sum(F.size("words"))).first()[0] or 0) // GROUP_WORDS))
    while True:
        dealt = pieces.withColumn("group", F.pmod("hash", F.lit(groups)))
        most = dealt.groupBy("group").agg(F.sum(F.size("words")).alias("n")).agg(F.max("n"), F.count("n")).first()
        if (most[0] or 0) <= GROUP_WORDS or groups > 8 * most[1]:
            break
        groups *= 2
    return [
        [(r["item"], [w.encode() for w in r["words"]]) for r in dealt.filter(F.col("group") == g).select("item", "words").toLocalIterator()]
        for g in range(groups)
    ]


FOUND = "n_words long, spans array<struct<start: long, end: long>>, items array<string>"
"""Words of a text, spans of hit words, their ends excluded, and the sorted items."""


def _found(model: Automaton, text: str) -> tuple[int, list[tuple[int, int]], list[str]]:
    words = normalised(text).split()
    spans, names = model.hits(words)
    return len(words), spans, sorted(names)


def _hits(group: Broadcast, window: int, text: Column) -> Column:
    key = uuid.uuid4().hex

    @F.pandas_udf(FOUND)
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = worker_model(("decontamination", key), lambda: Automaton(group.value, window))
        for texts in batches:
            yield pd.DataFrame([_found(model, t) for t in texts], columns=["n_words", "spans", "items"])

    return hits(text)


def with_hits(docs: DataFrame, items: DataFrame, name: str, window: int = WINDOW) -> DataFrame:
    """The documents with a new struct column FOUND of their words, hit spans and items.

    One automaton is sent to the executors and marks the documents as they are read, without a
    shuffle. Of more than one, each reads the documents in turn and writes what it finds by the
    text's hashes, of texts with hits only; the documents are then joined with the union.
    """
    spark = docs.sparkSession
    groups = [spark.sparkContext.broadcast(g) for g in item_groups(items, window)]
    if len(groups) == 1:
        return docs.withColumn(name, _hits(groups[0], window, text_or_empty()))
    key = [F.xxhash64(text_or_empty()).alias("k1"), F.xxhash64(text_or_empty(), F.lit(1)).alias("k2")]
    parts = []
    for group in groups:
        found = docs.select(*key, _hits(group, window, text_or_empty()).alias("found")).filter(F.size("found.spans") > 0)
        found = found.groupBy("k1", "k2").agg(F.first("found.spans").alias("spans"), F.first("found.items").alias("items"))
        parts.append(materialize(found, "hits"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    every = every.groupBy("k1", "k2").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    every = materialize(every.select("k1", "k2", F.struct(_apart("spans").alias("spans"), "items").alias("found")), "hits")
    none = _hits(spark.sparkContext.broadcast([]), window, text_or_empty())
    wide = docs.select(F.struct("*").alias("row"), none.alias("none"), *key).join(every, ["k1", "k2"], "left")
    found = F.struct(
        F.col("none.n_words").alias("n_words"), F.coalesce("found.spans", "none.spans").alias("spans"), F.coalesce("found.items", "none.items").alias("items"),
    )
    return wide.select("row.*", found.alias(name))


def _apart(spans: str) -> Column:
    """Sorted spans, those that meet or overlap joined."""
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")

    def join(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        meets = (F.size(done) > 0) & F.coalesce(F.try_element_at(done, F.lit(-1))["end"] >= span["start"], F.lit(False))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(meets, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(wider))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, none, join)


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row.

    Null and empty texts have no words. An item without a word has no window; a null item_id counts
    as an empty id, and items that repeat an id are one item with the windows of all. Repeated
    documents and null ids are judged like others; without items nothing is hit. An empty table
    gives an empty result; other columns are not read.
    """
    found = with_hits(docs.select("doc_id", "text"), items, "found", window)
    return found.select(
        "doc_id", "found.n_words", n_hit(F.col("found.spans")).alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("found.spans") > 0).alias("contaminated"),
    )


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given spans of words and what stands between the words of a span."""
    raw = text.encode("utf-8", "surrogatepass")
    starts, ends, inside = [], [], False
    for at, c in enumerate(raw.translate(_NORMAL) + b" "):
        if (c != 0x20) != inside:
            (ends if inside else starts).append(at)
            inside = not inside
    kept, at = [], 0
    for start, end in spans:
        kept.append(raw[at:starts[start]])
        at = ends[end - 1]
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """The documents without their hit spans; those with a share of hit words above ``coverage`` go.

    All columns are kept, whatever their names; n_chars, where there is one, follows the text. Rows
    without a hit stay as they are, null and empty texts among them.
    """
    name = next(n for n in ("found" + "_" * i for i in range(len(docs.columns) + 1)) if n not in docs.columns)
    marked = with_hits(docs, items, name, window)
    spans = F.col(name)["spans"]
    kept = marked.filter(n_hit(spans) <= coverage * F.col(name)["n_words"])

    @F.pandas_udf("string")
    def cut(texts: pd.Series, every: pd.Series) -> pd.Series:
        return pd.Series([
            t if t is None or not len(s) else without_spans(t, [(x["start"], x["end"]) for x in s]) for t, s in zip(texts, every)
        ], dtype=object)

    out = kept.withColumn("text", cut("text", spans))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, length).otherwise(F.col("n_chars")))
    return out.drop(name)


_WORDS = "list_filter(string_split_regex(lower_az, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"


@query(f"""
    WITH d0 AS (
        SELECT row_number() OVER () AS r, doc_id,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az
        FROM documents
    ), d AS (SELECT r, doc_id, {_WORDS} AS words FROM d0),
    i0 AS (
        SELECT CAST(item_id AS VARCHAR) AS item,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az
        FROM benchmark
    ), i AS (SELECT item, {_WORDS} AS words FROM i0),
    windows AS (
        SELECT DISTINCT item, least(len(words), {WINDOW}) AS k, array_to_string(words[low:low + least(len(words), {WINDOW}) - 1], ' ') AS w
        FROM i, unnest(range(1, greatest(len(words) - {WINDOW} + 2, 2))) AS u(low) WHERE len(words) > 0
    ), grams AS (
        SELECT r, low, k, array_to_string(words[low:low + k - 1], ' ') AS w
        FROM d, (SELECT DISTINCT k FROM windows) AS ks, unnest(range(1, greatest(len(words) - k + 2, 1))) AS u(low)
    ), found AS (SELECT r, low, k, item FROM grams JOIN windows USING (k, w)),
    hit AS (
        SELECT r, count(DISTINCT p) AS n_hit
        FROM (SELECT DISTINCT r, low, k FROM found) AS f, unnest(range(low, low + k)) AS u(p) GROUP BY r
    ), named AS (
        SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
""")
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
