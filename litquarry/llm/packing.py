"""Best-fit packing of token sequences with bounds that certify it."""

from __future__ import annotations

import functools
import itertools
import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from litquarry.llm.common import documents, text_or_empty, worker_model
from litquarry.llm.registry import query
from litquarry.session import materialize

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
CELL_PIECES = 30_000
"""Pieces packed by one task, on average."""
WORDS_HELD = 300_000
"""Entries a worker's word table may reach before it starts anew."""

_BREAK = re.compile("[\x20\x09-\x0d]+")
_SEPARATORS = "\x1c\x1d\x1e\x1f"
"""Characters that str.split takes for white space and the tokenizer does not."""


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# The rules of the tokenizer file, for words of printable ASCII and Latin-1 letters.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SIMPLE = re.compile(r"[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_UNIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\x20a-z\xdf-\xf6\xf8-\xff0-9]+")


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts from the ids of their words.

    The tokenizer drops white space and none of its rules looks across it, so a text's ids are
    those of its words in order. Each distinct word is encoded once and kept as bytes. A word of
    printable ASCII and Latin-1 letters is lower-cased and split by the tokenizer's rule here, so
    that the tokenizer's model sees each distinct part once; any other word, and every word of a
    file with other rules, goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        rules = json.loads(self.tokenizer.to_str())
        steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.split = (
            [n.get("type") for n in (rules.get("normalizer") or {}).get("normalizers", [])] == NORMALIZERS
            and [n.get("type") for n in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"] == {"Regex": SPLIT}
            and steps[0]["invert"]
            and not steps[1]["add_prefix_space"]
            and not steps[1]["use_regex"]
        )
        self.letters = byte_letters()
        self.words = Learned(self._word)
        self.units = Learned(self._unit)

    def _unit(self, unit: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(unit.encode().decode("latin-1").translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        if self.split and _SIMPLE.fullmatch(word) and "<|" not in word:
            return b"".join(map(self.units.__getitem__, _UNIT.findall(word.lower())))
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the text."""
        for held in (self.words, self.units):
            if len(held) > WORDS_HELD:
                held.clear()
        words = _BREAK.split(text) if any(c in text for c in _SEPARATORS) else text.split()
        return b"".join(map(self.words.__getitem__, words))


class Learned(dict):
    """A table that works a missing entry out once."""

    def __init__(self, work_out: Callable[[str], bytes]):
        self.work_out = work_out

    def __missing__(self, key: str) -> bytes:
        found = self[key] = self.work_out(key)
        return found


def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return worker_model(("encoder", path), lambda: Encoder(path))


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, piece, start, length, ids_crc32: every document's ids, cut where they exceed the capacity."""
    width = 4 * capacity
    end = np.asarray([END_ID], "<u4").tobytes()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for frame in frames:
            at, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(frame["text"]):
                ids = encode.encode(text) + end
                for k, low in enumerate(range(0, len(ids), width)):
                    part = ids[low:low + width]
                    at.append(i)
                    piece.append(k)
                    start.append(low // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            out = frame[list(keep)].iloc[at].reset_index(drop=True)
            yield out.assign(piece=piece, start=start, length=length, ids_crc32=crc)

    source = docs.select(*keep, text_or_empty().alias("text"))
    schema = StructType([source.schema[c] for c in keep]).add("piece", "integer").add("start", "long")
    return source.mapInPandas(cut, schema.add("length", "long").add("ids_crc32", "long"))


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item by best-fit decreasing; lengths are 1 to ``capacity``.

    Bins are kept by the room left in them, so an item finds the fullest bin that takes it by one
    look-up in a bit set of rooms.
    """
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    opened = 0
    for i in order.tolist():
        need = int(lengths[i])
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            where = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, where = capacity, opened
            opened += 1
        bins[i] = where
        left = room - need
        if left:
            if not by_room[left]:
                rooms |= 1 << left
            by_room[left].append(where)
    return bins


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of a family of dual-feasible functions.

    The plain volume; for each threshold the function that counts items beyond capacity less
    threshold as a whole bin and drops those below it; and the rounding functions with 1 to 20
    steps. Each maps lengths so that what fits one bin sums to at most one bin, so the rounded-up
    sum bounds the number of bins.
    """
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    number, volume = np.cumsum(count), np.cumsum(count * size)
    t = np.arange(1, capacity // 2 + 1)
    whole = number[-1] - number[capacity - t]
    middle = volume[capacity - t] - volume[t - 1]
    best = max(best, int((whole + -(-middle // capacity)).max(initial=0)))
    for k in range(1, 21):
        scaled = (k + 1) * size
        steps = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((count * steps).sum()) // (k * capacity)))
    return best


PLAN = "piece_id long, length long, cell long, bin long, loose boolean"


def _pack_cells(pieces: DataFrame, capacity: int) -> DataFrame:
    def one_cell(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("piece_id", ignore_index=True)
        lengths = frame["length"].to_numpy()
        bins = best_fit(lengths, capacity)
        used = np.bincount(bins, weights=lengths).astype(np.int64)
        loose = used < capacity
        if len(used) == lower_bound(lengths, capacity):
            loose &= np.arange(len(used)) == used.argmin()
        return frame.assign(bin=bins, loose=loose[bins])

    return pieces.select("piece_id", "length", "cell").groupBy("cell").applyInPandas(one_cell, PLAN)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(piece_id, sequence_id, offset) of each piece, from (piece_id, length).

    Pieces are dealt by hash to cells, each packed best-fit decreasing and certified when its bins
    are as few as its lower bound. A certified cell keeps all bins but the emptiest one; a cell
    with a gap keeps its full bins. The documents of the other bins are pooled and dealt anew, so
    cells exchange documents, and packed again. This goes on while a round saves bins; the packing
    before the last round stands if that one saved none.
    """
    cells = max(1, -(-pieces.count() // CELL_PIECES))
    todo = pieces.withColumn("cell", F.pmod(F.xxhash64("piece_id"), F.lit(cells)))
    done: list[DataFrame] = []
    pooled, pooled_bins = None, None
    for number in itertools.count():
        packed = materialize(_pack_cells(todo, capacity).withColumn("round", F.lit(number)), "packed")
        if pooled is not None and packed.select("cell", "bin").distinct().count() >= pooled_bins:
            done.append(pooled)
            break
        loose = packed.filter("loose")
        size, loose_cells = loose.agg(F.count(F.lit(1)), F.countDistinct("cell")).first()
        if loose_cells < 2 and cells == 1:
            done.append(packed)
            break
        done.append(packed.filter("not loose"))
        pooled, pooled_bins = loose, loose.select("cell", "bin").distinct().count()
        cells = max(1, -(-size // CELL_PIECES))
        todo = loose.withColumn("cell", F.pmod(F.xxhash64("piece_id", F.lit(number)), F.lit(cells)))
    return _offsets(functools.reduce(DataFrame.unionByName, done))


def _offsets(plan: DataFrame) -> DataFrame:
    """Number the bins and place their pieces one after the other; a bin holds at most ``capacity`` pieces."""
    sequence = F.shiftleft(F.shiftleft(F.col("round").cast("long"), 34) + F.col("cell"), 24) + F.col("bin")
    before = Window.partitionBy("sequence_id").orderBy("piece_id").rowsBetween(Window.unboundedPreceding, -1)
    return plan.select("piece_id", "length", sequence.alias("sequence_id")).select(
        "piece_id", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset")
    )


def packed_documents(docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, piece, start, length, ids_crc32, sequence_id, offset: every piece of every row.

    A null text is empty, and an empty text is its end id alone. A document longer than the
    capacity is cut into full pieces and a rest. Repeated rows and null ids are packed like others:
    pieces are told apart by their place in the piece table. An empty table gives an empty result.
    ``path`` names the tokenizer's file.
    """
    pieces = materialize(
        pieces_of(docs, path or tokenizer_path(), keep=keep).withColumn("piece_id", F.monotonically_increasing_id()),
        "pieces",
    )
    return pieces.join(pack(pieces.select("piece_id", "length")), "piece_id").drop("piece_id")


@query()
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(documents(spark, sf_dir))
