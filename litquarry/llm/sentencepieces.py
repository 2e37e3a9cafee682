"""SentencePiece encoding and decoding by matching all pieces against a suffix array."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from litquarry.llm.common import documents, worker_model
from litquarry.llm.registry import query

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
"""What stands for a space in pieces."""
BATCH_CHARS = 8_000_000
"""Characters of a batch of texts that are indexed together, unless a single text has more."""
UNITS_HELD = 600_000
"""Entries a worker's tables of units and of neighbouring pieces may reach before they start anew."""
DEPTH = 16
"""Characters by which suffixes are ordered: no piece is longer."""

SEPARATOR, UNKNOWN, FIRST_CODE = 1, 2, 3


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """The vocabulary of a byte-pair model with byte fallback, and its index of pieces.

    The model's rule merges the best-scored pair of neighbours, the leftmost of equals, until no
    pair is a piece. A sequence of pieces is what the rule makes of a text if and only if the rule
    leaves each two neighbours in it apart; so the last piece of every prefix is the one edge that
    ends there and stays apart from the last piece of the prefix it starts at. Relaxing the edges
    by position therefore gives the rule's result.
    """

    def __init__(self, path: str):
        import sentencepiece

        vocabulary = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(vocabulary.get_piece_size())
        self.texts = [vocabulary.id_to_piece(i) for i in ids]
        self.bytes = {int(self.texts[i][3:5], 16): i for i in ids if vocabulary.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        usual = [i for i in ids if not (vocabulary.is_byte(i) or vocabulary.is_control(i) or vocabulary.is_unknown(i))]
        self.rank = {self.texts[i]: (-vocabulary.get_score(i), i) for i in usual}
        if any(len(p) > DEPTH for p in self.rank):
            raise ValueError(f"a piece is longer than {DEPTH} characters")
        self.start = re.compile(_UNITS if self._cuts_at_letters() else f"{BLANK}*[^{BLANK}]+|{BLANK}+")
        letters = sorted({c for p in self.rank for c in p})
        self.codes = np.full(0x110000, UNKNOWN, np.uint16)
        self.codes[[ord(c) for c in letters]] = np.arange(FIRST_CODE, FIRST_CODE + len(letters))
        own = [p for p in self.rank if self.merge(p) == [p]]
        self.single = np.zeros(0x110000, bool)
        self.single[[ord(p) for p in own if len(p) == 1]] = True
        self.length_of = np.array([len(t) for t in self.texts])
        self.ids = np.array([self.rank[p][1] for p in own])
        self.lengths = np.array([len(p) for p in own])
        grid = np.zeros((len(own), DEPTH), np.uint16)
        for row, p in zip(grid, own):
            row[:len(p)] = self.codes[[ord(c) for c in p]]
        self.low = _keys(grid)
        grid[np.arange(DEPTH) >= self.lengths[:, None]] = 0xFFFF
        self.high = _keys(grid)
        self.units: dict[str, bytes] = {}
        self.apart: dict[int, bool] = {}

    def _cuts_at_letters(self) -> bool:
        """Whether no piece has a Latin letter beside another character, but for a blank before it."""
        return all(
            a == BLANK or b != BLANK and bool(_LETTER.fullmatch(a)) == bool(_LETTER.fullmatch(b))
            for p in self.rank for a, b in zip(p, p[1:])
        )

    def merge(self, text: str) -> list[str]:
        """The rule itself, for the few characters of one or two pieces."""
        parts = list(text)
        while len(parts) > 1:
            found = min(
                ((self.rank[a + b][0], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank),
                default=None,
            )
            if found is None:
                break
            i = found[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def edges(self, points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, end, token) of every occurrence of a piece in the concatenated units, by position.

        ``points`` are code points, ``bounds`` the places between units. A character that is no
        piece is an edge of its own, its token beyond the vocabulary.
        """
        codes = self.codes[points]
        codes[bounds] = SEPARATOR
        padded = np.zeros(len(codes) + DEPTH, np.uint16)
        padded[:len(codes)] = codes
        grid = np.lib.stride_tricks.sliding_window_view(padded, DEPTH)[:len(codes)]
        columns = [
            np.ascontiguousarray(grid[:, k:k + 4]).astype(np.uint64) @ np.array([1 << 48, 1 << 32, 1 << 16, 1], np.uint64)
            for k in range(0, DEPTH, 4)
        ]
        suffixes = np.lexsort(columns[::-1])
        keys = _keys(grid[suffixes])
        low, high = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
        many = high - low
        piece = np.repeat(np.arange(len(self.low)), many)
        inside = np.arange(len(piece)) - np.repeat(np.cumsum(many) - many, many)
        alone = ~self.single[points]
        alone[bounds] = False
        alone = np.flatnonzero(alone)
        position = np.concatenate([suffixes[np.repeat(low, many) + inside], alone])
        end = position + np.concatenate([self.lengths[piece], np.ones(len(alone), np.int64)])
        token = np.concatenate([self.ids[piece], len(self.texts) + points[alone].astype(np.int64)])
        order = np.argsort(position, kind="stable")
        return position[order], end[order], token[order]

    def name(self, token: int) -> str:
        return self.texts[token] if token < len(self.texts) else chr(token - len(self.texts))

    def apart_from(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether the rule leaves each two tokens apart; distinct pairs are worked out once."""
        pairs, where = np.unique((before << 32) | after, return_inverse=True)
        found = []
        for pair in pairs.tolist():
            known = self.apart.get(pair)
            if known is None:
                a, b = self.name(pair >> 32), self.name(pair & 0xFFFFFFFF)
                known = self.apart[pair] = self.merge(a + b) == [a, b]
            found.append(known)
        return np.array(found, bool)[where]

    def learn(self, units: list[str]) -> None:
        """Encode units that are not in the table yet.

        The edges of all units are relaxed together, from the first characters of the units on;
        ``last`` holds the piece that ends at each position. Then all units are traced back from
        their ends together.
        """
        if not units:
            return
        sizes = np.array([len(u) for u in units])
        points = np.frombuffer("\0".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        bases = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        position, end, token = self.edges(points, bases[1:] - 1)
        offset = position - bases[np.searchsorted(bases, position, "right") - 1]
        order = np.argsort(offset, kind="stable")
        position, end, token, offset = position[order], end[order], token[order], offset[order]
        last = np.full(len(points) + 1, -1, np.int64)
        steps = np.searchsorted(offset, np.arange(int(sizes.max()) + 1))
        for step, (low, high) in enumerate(zip(steps[:-1].tolist(), steps[1:].tolist())):
            ends, tokens = end[low:high], token[low:high]
            if step:
                before = last[position[low:high]]
                open_ = np.flatnonzero((before >= 0) & (last[ends] < 0))
                open_ = open_[self.apart_from(before[open_], tokens[open_])]
                ends, tokens = ends[open_], tokens[open_]
            last[ends] = tokens
        at, unit = bases + sizes, np.arange(len(units))
        found, owners = [], []
        while len(unit):
            tokens = last[at]
            found.append(tokens)
            owners.append(unit)
            at = at - self.token_length(tokens)
            more = at > bases[unit]
            at, unit = at[more], unit[more]
        owner, tokens = np.concatenate(owners)[::-1], np.concatenate(found)[::-1]
        order = np.argsort(owner, kind="stable")
        tokens = tokens[order]
        stops = np.searchsorted(owner[order], np.arange(len(units) + 1))
        odd = set(owner[order][tokens >= len(self.texts)].tolist())
        blob = tokens.astype("<u4").tobytes()
        for i, (unit_text, low, high) in enumerate(zip(units, stops[:-1].tolist(), stops[1:].tolist())):
            if i in odd:
                self.units[unit_text] = np.array([k for t in tokens[low:high].tolist() for k in self.fall_back(t)], "<u4").tobytes()
            else:
                self.units[unit_text] = blob[4 * low:4 * high]

    def token_length(self, tokens: np.ndarray) -> np.ndarray:
        return np.where(tokens < len(self.texts), self.length_of[np.minimum(tokens, len(self.texts) - 1)], 1)

    def fall_back(self, token: int) -> list[int]:
        if token < len(self.texts):
            return [token]
        return [self.bytes[b] for b in self.name(token).encode("utf-8", "surrogatepass")]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for held in (self.units, self.apart):
            if len(held) > UNITS_HELD:
                held.clear()
        split = [self.start.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in texts]
        self.learn(list({u for units in split for u in units if u not in self.units}))
        return [b"".join(map(self.units.__getitem__, units)) for units in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids: runs of bytes as UTF-8, blanks as spaces, without the first blank."""
        out: list[str] = []
        run = bytearray()
        byte_of, texts = self.byte_of, self.texts
        for i in ids.tolist():
            byte = byte_of.get(i)
            if byte is not None:
                run.append(byte)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(texts[i])
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out).replace(BLANK, " ")[1:]


_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_LETTER = re.compile(f"[{_LETTERS}]")
_UNITS = f"{BLANK}*[{_LETTERS}]+|{BLANK}*[^{_LETTERS}{BLANK}]+|{BLANK}+"


def _keys(grid: np.ndarray) -> np.ndarray:
    """Rows of codes as byte strings that sort like them."""
    return np.ascontiguousarray(grid.astype(">u2")).view(f"S{2 * DEPTH}").ravel()


def pieces(path: str) -> Pieces:
    return worker_model(("pieces", path), lambda: Pieces(path))


def _parts(texts: list[str | None]) -> Iterator[list[str | None]]:
    part, size = [], 0
    for text in texts:
        if part and size + len(text or "") > BATCH_CHARS:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text or "")
    if part:
        yield part


def with_ids(docs: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The documents with their ids as a new column of integers; a null text has null ids, an empty one none."""
    path = path or model_path()

    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = pieces(path)
        for texts in batches:
            out = []
            for part in _parts(texts.tolist()):
                found = model.encode_all([t or "" for t in part])
                out += [None if t is None else np.frombuffer(ids, "<i4") for t, ids in zip(part, found)]
            yield pd.Series(out, dtype="object")

    return docs.withColumn(name, encoded("text"))


def with_text(rows: DataFrame, ids: str, name: str, path: str | None = None) -> DataFrame:
    """The rows with the text of a column of ids as a new column; null ids have a null text."""
    path = path or model_path()

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = pieces(path)
        for column in batches:
            yield pd.Series([None if i is None else model.decode(np.asarray(i)) for i in column], dtype="object")

    return rows.withColumn(name, decoded(ids))


RESULT = "n_ids long, ids_crc32 long, round_trip boolean"


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids_crc32 and round_trip of every row: its ids, counted and summed up, and decoded again.

    The sum is the unsigned crc32 of the ids as little-endian unsigned 32-bit numbers. A null text
    counts as empty and has no ids. A text that holds the blank U+2581 itself comes back with
    spaces in its place, as from the model's own library. Repeated rows and null ids are encoded
    like others; an empty table gives an empty result; other columns are not read.
    """
    path = path or model_path()

    @F.pandas_udf(RESULT)
    def summed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = pieces(path)
        for texts in batches:
            rows = []
            for part in _parts([t or "" for t in texts]):
                for text, ids in zip(part, model.encode_all(part)):
                    rows.append((len(ids) // 4, zlib.crc32(ids), model.decode(np.frombuffer(ids, "<u4")) == text))
            yield pd.DataFrame(rows, columns=["n_ids", "ids_crc32", "round_trip"])

    return docs.select("doc_id", summed("text").alias("found")).select("doc_id", "found.*")


@query()
def op10_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
