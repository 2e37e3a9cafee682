"""Secret scans: fixed patterns, and a conditional random field over tokens."""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from litquarry.llm.common import documents, text_or_empty
from litquarry.llm.crf import Crf, fit
from litquarry.llm.registry import query
from litquarry.session import materialize

# The base patterns, their least lengths, and the order of kinds.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ASSIGN_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
KINDS = ["assign", "access", "hex", "crf"]

TRAIN_DOCS = 1_000
"""Documents that may hold a base span, and as many others, that the field is fitted on."""
TRAIN_CHARS = 4_000
"""Characters of such a document that it is fitted on: those around its first possible base span, or marked character."""
CHAIN = 64
"""Tokens of a chain that it is fitted on."""
MAY_MATCH = "(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"
VALUE = string.ascii_letters + string.digits
VALUE_SIZES = (16, 40)
"""Characters, and least and most of them, of the values that stand in for those of base spans in training."""
LEAST_VALUE = 8
"""Characters that a tagged span needs to be reported; it also needs a digit."""

OUTSIDE, BEGIN, INSIDE = 0, 1, 2

_MARK = re.compile(r"[0-9=:/_+@]")
_KEY = re.compile(r"pass(?:wor|wd|phrase)|pwd|secret|token|api_?key|credential|private|bearer|auth", re.IGNORECASE)
_TOKEN = re.compile(r"[^\x20\x09-\x0d]+")
_SPACES = re.compile(r"[\x20\x09-\x0d]*")
_HEXADECIMAL = re.compile("[0-9a-fA-F]+")
_NUMBER = re.compile("[0-9.()+-]+")
_DIGIT = re.compile("[0-9]")
_EDGE = "\"'`()[]{}<>,;:.!?|*#$%&"
_BLANK = " \t\n\x0b\x0c\r"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then kind; ends are exclusive."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _tokens_around(text: str, low: int, high: int) -> list[tuple[int, int]]:
    """The token that holds ``low`` to ``high``, between the tokens before and after it."""
    while low > 0 and text[low - 1] not in _BLANK:
        low -= 1
    high = _TOKEN.match(text, low).end()
    out = [(low, high)]
    before = low
    while before > 0 and text[before - 1] in _BLANK:
        before -= 1
    if before:
        start = before
        while start > 0 and text[start - 1] not in _BLANK:
            start -= 1
        out.insert(0, (start, before))
    after = _TOKEN.search(text, high)
    if after:
        out.append(after.span())
    return out


def chains(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring tokens, (start, end) each: the marked tokens and those next to them.

    Tokens are divided by white space. A token with a digit or one of ``=:/_+@`` is marked. All
    tokens in no chain are plain and have plain neighbours, so they have the features PLAIN.
    """
    spans: dict[tuple[int, int], None] = {}
    end = 0
    for m in _MARK.finditer(text):
        if m.start() >= end:
            around = _tokens_around(text, m.start(), m.end())
            end = next(b for a, b in around if a <= m.start() < b)
            spans.update(dict.fromkeys(around))
    out: list[list[tuple[int, int]]] = []
    follows = -1
    for span in sorted(spans):
        if span[0] == follows:
            out[-1].append(span)
        else:
            out.append([span])
        follows = _SPACES.match(text, span[1]).end()
    return out


SHAPES = [
    "bias", "plain", "digits", "hex", "upper and digits", "mixed case and digits", "lower and digits",
    "length 8", "length 12", "length 16", "length 24", "length 32", "quoted", "symbols only", "letters", "holds assignment",
    "holds at", "holds slash", "dots and digits", "entropy 2.5", "entropy 3.2", "entropy 4", "keyword", "after keyword",
    "after assignment", "keyword two before", "keyword before assignment", "assignment before value",
    "value and file has assignment", "value and file has keyword",
]
"""Features of a token: its shape, its neighbours, and the file. All are 0 or 1."""
PLAIN = np.array([1.0, 1.0] + [0.0] * (len(SHAPES) - 2))


def _entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def features(text: str, chain: list[tuple[int, int]], file_flags: tuple[bool, bool]) -> np.ndarray:
    """One row per token; a row of a plain token with plain neighbours is PLAIN."""
    words = [text[a:b] for a, b in chain]
    cores = [w.strip(_EDGE) for w in words]
    marked = [bool(_MARK.search(w)) for w in words] + [False]
    keys = [bool((marked[i - 1] if i else False) or marked[i] or marked[i + 1]) and bool(_KEY.search(w)) for i, w in enumerate(words)]
    assigns = [m and w[-1] in "=:" for w, m in zip(words, marked)]
    rows = np.zeros((len(words), len(SHAPES)))
    for i, (word, core) in enumerate(zip(words, cores)):
        if not marked[i]:
            rows[i, :2] = 1
            rows[i, 22] = keys[i]
            rows[i, 26] = keys[i] and i + 1 < len(words) and assigns[i + 1]
            continue
        value = core.rpartition("=")[2].strip(_EDGE) if "=" in core.rstrip("=") else core
        digit, letter = any(c.isdigit() for c in value), any(c.isalpha() for c in value)
        upper, lower = any(c.isupper() for c in value), any(c.islower() for c in value)
        size = len(value)
        spread = _entropy(value) if size >= 8 else 0.0
        rows[i] = [
            1, 0, digit and not letter, bool(size >= 8 and _HEXADECIMAL.fullmatch(value)), digit and upper and not lower,
            digit and upper and lower, digit and lower and not upper, size >= 8, size >= 12, size >= 16, size >= 24, size >= 32,
            size > 0 and word[0] in "\"'`", size == 0, letter and not digit, "=" in word or word[-1] == ":", "@" in word, "/" in word,
            bool(_NUMBER.fullmatch(value)) and not value.isdigit(), spread >= 2.5, spread >= 3.2, spread >= 4, keys[i],
            i > 0 and keys[i - 1], i > 0 and assigns[i - 1], i > 1 and keys[i - 2] and assigns[i - 1],
            keys[i] and i + 1 < len(words) and assigns[i + 1], assigns[i] and i + 1 < len(words) and len(cores[i + 1]) >= 8,
            digit and size >= 8 and file_flags[0], digit and size >= 8 and file_flags[1],
        ]
    return rows


def file_features(text: str) -> tuple[bool, bool]:
    """Whether the text has an assignment, and one beside a keyword anywhere."""
    assigned = "=" in text or ":" in text
    return assigned, assigned and bool(_KEY.search(text))


def _framed(rows: np.ndarray, text: str, chain: list[tuple[int, int]]) -> tuple[np.ndarray, int]:
    """The rows with a plain token where the text goes on before or after the chain."""
    before = bool(text[:chain[0][0]].strip(_BLANK)) if chain[0][0] < 64 else True
    after = _SPACES.match(text, chain[-1][1]).end() < len(text)
    return np.concatenate([PLAIN[None][:before], rows, PLAIN[None][:after]]), int(before)


def weak_labels(chain: list[tuple[int, int]], spans: list[tuple[int, int, str]]) -> np.ndarray:
    """Tags of a chain from the base spans: the first token that a span touches begins it."""
    tags = np.zeros(len(chain), np.int64)
    for i, (start, end) in enumerate(chain):
        for low, high, _ in spans:
            if start < high and low < end:
                tags[i] = BEGIN if start <= low else INSIDE
                break
    return tags


def redrawn(text: str, spans: list[tuple[int, int, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with other random values in place of those of the spans, and the spans' new places.

    What stands around a value stays. Of overlapping spans the first is redrawn. The values depend on the text alone.
    """
    draw = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    out, at, moved = "", 0, []
    for start, end, kind in spans:
        if start < at:
            continue
        low = ASSIGN.match(text, start).start(2) if kind == "assign" else start
        begin = len(out) + start - at
        out += text[at:low] + "".join(draw.choices(VALUE, k=draw.randint(*VALUE_SIZES)))
        moved.append((begin, len(out), kind))
        at = end
    return out + text[at:], moved


def examples(text: str, kinds: Sequence[str] = KINDS) -> list[tuple[np.ndarray, np.ndarray]]:
    """The chains of a text with their tags, and again with redrawn values, so that not their patterns are learned alone.

    Chains with a base span of another kind than ``kinds`` are left out.
    """
    known = [s for s in base_spans(text) if s[2] in kinds]
    out = []
    for text, spans in [(text, known)] + [redrawn(text, known)] * bool(known):
        flags = file_features(text)
        hidden = [(a, b) for a, b, kind in base_spans(text) if kind not in kinds]
        for chain in chains(text):
            if any(start < b and a < end for start, end in chain for a, b in hidden):
                continue
            rows, shift = _framed(features(text, chain, flags), text, chain)
            tags = np.zeros(len(rows), np.int64)
            tags[shift:shift + len(chain)] = weak_labels(chain, spans)
            out.append((rows[:CHAIN], tags[:CHAIN]))
    return out


def training_texts(docs: DataFrame) -> list[str]:
    """The bounded sample, the same in every run: windows of TRAIN_CHARS characters of whole texts.

    TRAIN_DOCS documents in which a base pattern may match, wherever in their text, and as many that
    only hold marked tokens, in the order of a hash of the text; of equal texts one counts.
    """
    order, text = F.xxhash64("text"), F.col("text")
    seen = docs.filter(text.rlike(_MARK.pattern)).select(order.alias("order"), text.rlike(MAY_MATCH).alias("hit"))
    seen = materialize(seen, "marked")
    chosen = [seen.filter(F.col("hit") == hit).select("order", "hit").distinct().orderBy("order").limit(TRAIN_DOCS) for hit in (True, False)]
    chosen = materialize(chosen[0].unionByName(chosen[1]), "chosen")
    first = F.regexp_instr(text, F.when(F.col("hit"), F.lit(MAY_MATCH)).otherwise(F.lit(_MARK.pattern)))
    window = F.substring(text, F.greatest(first - TRAIN_CHARS // 2, F.lit(1)), F.lit(TRAIN_CHARS))
    held = docs.select("text", order.alias("order")).join(F.broadcast(chosen), "order")
    windows = held.select("order", "hit", window.alias("window")).groupBy("hit", "order").agg(F.min("window").alias("window"))
    return [row["window"] for row in windows.orderBy(F.desc("hit"), "order").collect()]


def train(docs: DataFrame, kinds: Sequence[str] = KINDS) -> Crf:
    """The field, fitted on a bounded sample that base spans of ``kinds`` label.

    Chains among plain tokens alone stand for the rest of the corpus.
    """
    data = [example for text in training_texts(docs) for example in examples(text, kinds)]
    plain = (PLAIN[None].repeat(4, 0), np.zeros(4, np.int64))
    return fit(data + [plain] * (1 + len(data) // 4), 3)


def scan(text: str, field: Crf) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The base spans, and all spans: those and what the field adds where no base span is.

    Only chains are decoded: a plain token among plain ones is outside in any best path, which is
    checked, so the chains' best paths are those of the whole text. Where the check fails the whole
    text is one chain.
    """
    base = base_spans(text)
    if not len(field.emit):
        return base, base
    cut = field.certain(field.scores(PLAIN), OUTSIDE)
    added = []
    flags = None
    for chain in chains(text) if cut else [[m.span() for m in _TOKEN.finditer(text)]]:
        if not chain:
            continue
        flags = flags or file_features(text)
        rows, shift = _framed(features(text, chain, flags), text, chain)
        tags = field.decode(field.scores(rows).tolist())[shift:shift + len(chain)]
        for i, tag in enumerate(tags):
            if tag != BEGIN:
                continue
            stop = i
            while stop + 1 < len(tags) and tags[stop + 1] == INSIDE:
                stop += 1
            start, end = chain[i][0], chain[stop][1]
            while start < end and text[start] in _EDGE:
                start += 1
            while end > start and text[end - 1] in _EDGE:
                end -= 1
            if end - start >= LEAST_VALUE and _DIGIT.search(text, start, end) and not any(a < end and start < b for a, b, _ in base):
                added.append((start, end, "crf"))
    return base, sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


RESULT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def find_secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, n_assign, n_access, n_hex, base_sha256 and spans of every row.

    Base spans are whole matches of the fixed patterns, of one kind leftmost and not overlapping;
    kinds may overlap each other. ``spans`` lists them and those of the field as kind:start:end in
    code points. A null or empty text has none. Repeated rows and null ids are scanned like others;
    an empty table gives an empty result.
    """
    field = train(docs)

    @F.pandas_udf(RESULT)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                base, spans = scan(text, field)
                count = Counter(kind for _, _, kind in base)
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((count["assign"], count["access"], count["hex"], digest, joined(spans)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(*keep, scanned(text_or_empty()).alias("found")).select(*keep, "found.*")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by ``mark``; overlapping spans are replaced as one.

    All rows and columns are kept; a text without a span, null texts included, stays as it is.
    n_chars, where there is one, follows a text that changes.
    """
    field = train(docs)

    @F.pandas_udf("string")
    def redacted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else replace(t, scan(t, field)[1], mark) for t in texts], dtype="object")

    name = next(n for n in ("redacted" + "_" * i for i in range(len(docs.columns) + 1)) if n not in docs.columns)
    out = docs.withColumn(name, redacted(F.col("text")))
    if "n_chars" in docs.columns:
        length = F.length(name).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(name).eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(length))
    return out.withColumn("text", F.col(name)).drop(name)


def replace(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    parts, at = [], 0
    for start, end, _ in spans:
        if end <= at:
            continue
        if start >= at:
            parts += [text[at:start], mark]
        at = end
    return "".join(parts) + text[at:]


@query()
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir))
