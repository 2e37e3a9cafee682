"""Quality scores by attention over passages, learned from document labels."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from litquarry.llm.common import documents, fold, text_or_empty
from litquarry.llm.registry import query
from litquarry.llm.texts import DIGIT, LOWER, MARK, OTHER, SPACE, STOP, SYMBOL, UPPER, character_kinds, code_points, kind_counts, parts

PASSAGE_WORDS = 100
TRAIN_DOCS = 1_500
"""Labelled documents of each label that the model is fitted on, in the order of a hash of the id."""
TRAIN_PASSAGES = 64
"""Passages of such a document that it is fitted on, evenly spread over it."""
WIDTH, GATES = 16, 8
ROUNDS = 400
THRESHOLD = 0.3

FEATURES = 20


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, passages of each text): PASSAGE_WORDS words each, at least one passage a text."""
    joined = " ".join(texts) + " "
    kinds = character_kinds()[code_points(joined)]
    space = kinds == SPACE
    begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    stops = np.cumsum([len(t) + 1 for t in texts])
    words_to = np.searchsorted(begins, stops)
    low_words = np.concatenate([[0], words_to[:-1]])
    counts = np.maximum(1, -(-(words_to - low_words) // PASSAGE_WORDS))
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = low_words[owner] + place * PASSAGE_WORDS
    last = np.minimum(first + PASSAGE_WORDS, words_to[owner])
    edge = np.append(begins, len(joined))
    starts = np.where(first < last, edge[np.minimum(first, len(begins))], stops[owner] - 1)
    ends = np.where(last < words_to[owner], edge[np.minimum(last, len(begins))], stops[owner] - 1)
    per = kind_counts(kinds, starts, ends)
    words = last - first
    all_words = joined.encode("utf-8", "surrogatepass").split()
    distinct = np.array([len(set(all_words[a:b])) for a, b in zip(first.tolist(), last.tolist())])
    pairs = np.array([len(set(zip(all_words[a:b - 1], all_words[a + 1:b]))) for a, b in zip(first.tolist(), last.tolist())])
    ink = np.maximum(per.sum(axis=1) - per[:, SPACE], 1)
    letters = np.maximum(per[:, UPPER] + per[:, LOWER] + per[:, OTHER], 1)
    some = np.maximum(words, 1)
    return np.stack([
        words == 0, np.log1p(words), per[:, UPPER] / letters, per[:, UPPER] / letters > 0.5, per[:, DIGIT] / ink,
        per[:, SYMBOL] / ink, per[:, SYMBOL] / some > 0.3, per[:, MARK] / ink, per[:, MARK] / some > 0.3, per[:, STOP] / ink,
        per[:, STOP] / some, per[:, OTHER] / ink, ink / some, ink / some > 12, distinct / some, distinct / some < 0.5,
        pairs / np.maximum(words - 1, 1), pairs / np.maximum(words - 1, 1) < 0.8, words < 10, per[:, SPACE] / some,
    ], axis=1).astype(np.float64), counts


@dataclass(frozen=True)
class Model:
    """A passage is tanh(x W); its attention is w (tanh(h V) * sigmoid(h U)); a document is their weighted mean."""

    mean: np.ndarray
    spread: np.ndarray
    weights: list[np.ndarray]

    def score(self, rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.forward((rows - self.mean) / self.spread, counts)[0]

    def forward(self, x: np.ndarray, counts: np.ndarray) -> tuple:
        encode, bias, value, gate, weight, out, rest = self.weights
        h = np.tanh(x @ encode + bias)
        t, s = np.tanh(h @ value), _sigmoid(h @ gate)
        e = (t * s) @ weight
        low = np.cumsum(counts) - counts
        bag = np.repeat(np.arange(len(counts)), counts)
        a = np.exp(e - np.maximum.reduceat(e, low)[bag])
        a /= np.add.reduceat(a, low)[bag]
        z = np.add.reduceat(a[:, None] * h, low, axis=0)
        return _sigmoid(z @ out + rest[0]), h, t, s, a, z, low, bag


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: np.ndarray, counts: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    """Cross-entropy by Adam from fixed first weights; the same rows in the same order give the same model."""
    draw = np.random.default_rng(seed)
    mean, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    weights = [
        draw.normal(0, 0.3, (rows.shape[1], WIDTH)), np.zeros(WIDTH), draw.normal(0, 0.3, (WIDTH, GATES)),
        draw.normal(0, 0.3, (WIDTH, GATES)), draw.normal(0, 0.3, GATES), draw.normal(0, 0.3, WIDTH), np.zeros(1),
    ]
    model = Model(mean, spread, weights)
    x = (rows - mean) / spread
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for turn in range(1, ROUNDS + 1):
        encode, _, value, gate, weight, out, _ = weights
        p, h, t, s, a, z, low, bag = model.forward(x, counts)
        slope = (p - labels) / len(labels)
        dz = slope[:, None] * out
        pull = (dz[bag] * h).sum(axis=1)
        de = a * (pull - np.add.reduceat(a * pull, low)[bag])
        both = de[:, None] * weight
        dt, ds = both * s * (1 - t * t), both * t * s * (1 - s)
        dh = (a[:, None] * dz[bag] + dt @ value.T + ds @ gate.T) * (1 - h * h)
        slopes = [x.T @ dh, dh.sum(axis=0), h.T @ dt, h.T @ ds, (t * s).T @ de, z.T @ slope, slope.sum(keepdims=True)]
        for w, g, m, v in zip(weights, slopes, first, second):
            g = g + 1e-5 * w
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            w -= 0.02 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model, fitted on a bounded sample of the labelled rows outside the held-out fold; None without any."""
    judged = labels.filter(F.col("quality").isin(0, 1) & (fold("doc_id", 5) != 0)).select("doc_id", "quality")

    def encoded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            blobs = []
            for text in frame["text"]:
                rows, _ = passages([text])
                if len(rows) > TRAIN_PASSAGES:
                    rows = rows[np.linspace(0, len(rows) - 1, TRAIN_PASSAGES).astype(int)]
                blobs.append(rows.tobytes())
            yield frame[["quality", "order", "doc_id"]].assign(rows=blobs)

    bags = []
    for quality in (0, 1):
        chosen = (
            judged.filter(F.col("quality") == quality).withColumn("order", F.xxhash64("doc_id"))
            .orderBy("order", "doc_id").limit(TRAIN_DOCS)
        )
        sample = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
        schema = f"quality int, `order` long, doc_id {sample.schema['doc_id'].dataType.simpleString()}, rows binary"
        found = sample.mapInPandas(encoded, schema).orderBy("order", "doc_id", "rows").limit(TRAIN_DOCS)
        bags += [(r["quality"], np.frombuffer(bytes(r["rows"])).reshape(-1, FEATURES)) for r in found.collect()]
    if not bags:
        return None
    return fit(np.concatenate([b for _, b in bags]), np.array([len(b) for _, b in bags]), np.array([q for q, _ in bags], float))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    A null or empty text is one passage without a word and scored like others. Without a labelled
    row to learn from every score is 0.5. Repeated rows and null ids are scored like others; an
    empty table gives an empty result; labels, lang, source and doc_id take no part in a score.
    """
    model = train(docs, labels)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [model.score(*passages(part)) if model else np.full(len(part), 0.5) for part in parts(texts.tolist())]
            yield pd.Series(np.concatenate(found) if found else [], dtype="float64")

    found = docs.select("doc_id", scored(text_or_empty()).alias("score"))
    return found.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


@query()
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
