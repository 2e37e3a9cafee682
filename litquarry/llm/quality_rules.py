"""Quality rules: a conditional random field marks lines as content or boilerplate."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from litquarry.llm.common import documents, text_or_empty
from litquarry.llm.crf import Crf, fit
from litquarry.llm.registry import query
from litquarry.llm.texts import BLANK, DIGIT, LOWER, MARK, SPACE, SYMBOL, SYMBOLS, UPPER, character_kinds, code_points, kind_counts, parts

LEAST_WORDS = 10
REPEATED_PERCENT = 20
CONTENT_SHARE = 0.5
"""Share of a document's word characters that content lines must hold for it to be kept."""
TRAIN_DOCS = 1_500
"""Documents of each quality label that the field is fitted on."""
TRAIN_LINES = 40
"""Lines of such a document that it is fitted on, from its first."""
TRAIN_CHARS = 20_000
"""Characters of such a document that it is fitted on."""

BOILERPLATE, CONTENT = 0, 1

# Words of notices.
NOTICE = re.compile(
    r"licen[cs]e|copyright|rights reserved|terms of (?:use|service)|privacy policy|cookie|subscribe|sign up|log ?in|click here|read more",
    re.IGNORECASE,
)

FEATURES = [
    "bias", "no word", "1 or 2 words", "3 to 5 words", "6 or more words", "symbols over 0", "symbols over 2 %", "symbols over 5 %",
    "symbols over 10 %", "upper case over 15 %", "upper case over 40 %", "upper case over 80 %", "marks over 2 %", "marks over 8 %",
    "digits over 10 %", "digits over 30 %", "ends a sentence", "starts upper case", "notice", "repeats an earlier line",
    "long words", "short words",
]
SIGNS = ["no word", "symbols over 2 %", "upper case over 40 %", "marks over 2 %", "digits over 30 %", "repeats an earlier line"]
"""Features that tell the lines of a low-quality document that are no prose."""


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, characters in words, line count of each text) of all lines of the texts, in order."""
    joined = "\n".join(texts) + "\n"
    counts = np.array([t.count("\n") + 1 for t in texts])
    codes = code_points(joined)
    ends = np.flatnonzero(codes == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    kinds = character_kinds()[codes]
    per_line = kind_counts(kinds, starts, ends)
    spaces = np.concatenate([[True], kinds == SPACE])
    word_starts = np.concatenate([[0], np.cumsum(spaces[:-1] & ~spaces[1:])])
    words = word_starts[ends] - word_starts[starts]
    size = ends - starts
    ink = size - per_line[:, SPACE]
    letters = per_line[:, UPPER] + per_line[:, LOWER]
    share = lambda kind: per_line[:, kind] / np.maximum(ink, 1)
    upper = per_line[:, UPPER] / np.maximum(letters, 1)
    last = codes[np.maximum(ends - 1, 0)]
    notice = np.zeros(len(ends), bool)
    for m in NOTICE.finditer(joined):
        notice[np.searchsorted(ends, m.start())] = True
    mean = ink / np.maximum(words, 1)
    rows = np.stack([
        np.ones(len(ends)), words == 0, (words > 0) & (words <= 2), (words > 2) & (words <= 5), words > 5,
        per_line[:, SYMBOL] > 0, share(SYMBOL) > 0.02, share(SYMBOL) > 0.05, share(SYMBOL) > 0.1,
        upper > 0.15, upper > 0.4, upper > 0.8, share(MARK) > 0.02, share(MARK) > 0.08, share(DIGIT) > 0.1, share(DIGIT) > 0.3,
        (size > 0) & np.isin(last, [ord(c) for c in ".!?\"»”"]), kinds[starts] == UPPER, notice, repeated(texts),
        mean > 12, mean < 3,
    ], axis=1).astype(np.float64)
    return rows, ink, counts


def repeated(texts: list[str]) -> np.ndarray:
    """Whether each line of each text has a word and equals an earlier line of the text."""
    out = []
    for text in texts:
        seen: set[str] = set()
        for line in text.split("\n"):
            out.append(line in seen and bool(line.strip(BLANK)))
            seen.add(line)
    return np.array(out, bool)


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words inside a window of ``width`` words that occurs twice or more."""
    windows = list(zip(*(words[i:] for i in range(width))))
    count = Counter(windows)
    if len(count) == len(windows):
        return 0
    total, covered = 0, 0
    for i, window in enumerate(windows):
        if count[window] > 1:
            total += i + width - max(covered, i)
            covered = i + width
    return total


def base_measures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode("utf-8", "surrogatepass").split()
    return (
        len(words), len(text) - sum(map(text.count, BLANK)), sum(map(text.count, SYMBOLS)),
        int(repeated([text]).sum()), repeated_words(words),
    )


def content_shares(texts: list[str], field: Crf) -> list[float]:
    """Share of each text's word characters in lines that the best path marks as content; 0 without a word."""
    rows, ink, counts = line_features(texts)
    scores = field.scores(rows).tolist()
    out, low = [], 0
    for n in counts.tolist():
        marked = np.array(field.decode(scores[low:low + n])) == CONTENT
        chars = ink[low:low + n]
        out.append(float(chars[marked].sum() / max(chars.sum(), 1)))
        low += n
    return out


def train(docs: DataFrame, labels: DataFrame) -> Crf:
    """The field, fitted on the lines of a bounded sample of labelled documents.

    A line is boilerplate if its document's label is 0 and it bears a sign that it is no prose, and
    a notice is boilerplate anywhere. The sample is TRAIN_DOCS documents of each label in the order of a hash of the id, and the first TRAIN_LINES lines and TRAIN_CHARS characters of each.
    """
    judged = labels.filter(F.col("quality").isNotNull()).select("doc_id", "quality")
    chains = []
    for quality in (0, 1):
        chosen = (
            judged.filter(F.col("quality") == quality).withColumn("order", F.xxhash64("doc_id"))
            .orderBy("order", "doc_id").limit(TRAIN_DOCS)
        )
        lines = F.slice(F.split(F.substring(text_or_empty(), 1, TRAIN_CHARS), "\n"), 1, TRAIN_LINES)
        sample = docs.select("doc_id", F.array_join(lines, "\n").alias("text")).join(F.broadcast(chosen), "doc_id")
        texts = [r["text"] for r in sample.orderBy("order", "doc_id", "text").limit(TRAIN_DOCS).collect()]
        if not texts:
            continue
        rows, _, counts = line_features(texts)
        low = 0
        for n in counts.tolist():
            x = rows[low:low + n]
            signs = x[:, [FEATURES.index(f) for f in SIGNS]].any(axis=1) | (x[:, FEATURES.index("ends a sentence")] == 0)
            y = np.where(signs & (quality == 0), BOILERPLATE, CONTENT)
            y[x[:, FEATURES.index("notice")] > 0] = BOILERPLATE
            chains.append((x, y))
            low += n
    return fit(chains, 2, rounds=300, ridge=1e-4) if chains else Crf(np.eye(len(FEATURES), 2, k=1), np.zeros((2, 2)), np.zeros(2))


RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, content_share double"
)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base measures, base_failed, kept and content_share of every row.

    A null or empty text has no words and fails the base rules. Of the others those are kept whose
    content lines hold at least CONTENT_SHARE of their word characters. Without labelled documents
    all lines are content. Repeated rows and null ids are judged like others; an empty table gives
    an empty result; columns of other names are not read.
    """
    field = train(docs, labels)

    @F.pandas_udf(RESULT)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RESULT.split(", ")]
        for texts in batches:
            rows = []
            for part in parts(texts.tolist()):
                for text, share in zip(part, content_shares(part, field)):
                    n, *rest, again = base_measures(text)
                    failed = n < LEAST_WORDS or 100 * again > REPEATED_PERCENT * n
                    rows.append((n, *rest, again, failed, not failed and share >= CONTENT_SHARE, share))
            yield pd.DataFrame(rows, columns=names)

    return docs.select("doc_id", judged(text_or_empty()).alias("found")).select("doc_id", "found.*")


@query()
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
