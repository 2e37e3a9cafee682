"""Character kinds of batches of texts, counted by column operations."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np

BATCH_CHARS = 1_000_000
"""Characters of a batch of texts, unless a single one has more."""

# The symbols counted by the quality contract.
SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\x0b\x0c\r"
MARKS = "!?@=+~^_\\"
STOPS = ".,;:"

OTHER, UPPER, LOWER, DIGIT, SYMBOL, MARK, SPACE, STOP = range(8)


@functools.cache
def character_kinds() -> np.ndarray:
    """Kind of every code point; caseless letters and all else are OTHER."""
    kinds = np.zeros(0x110000, np.uint8)
    for i in range(0x3000):
        c = chr(i)
        kinds[i] = UPPER if c.isupper() else LOWER if c.islower() else DIGIT if c.isdigit() else OTHER
    for kind, chars in ((SYMBOL, SYMBOLS), (MARK, MARKS), (STOP, STOPS), (SPACE, BLANK)):
        kinds[[ord(c) for c in chars]] = kind
    return kinds


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def kind_counts(kinds: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Characters of each kind, a column, in each span, a row."""
    out = np.empty((len(starts), 8), np.int64)
    before = np.zeros(len(kinds) + 1, np.int64)
    for kind in range(8):
        np.cumsum(kinds == kind, out=before[1:])
        out[:, kind] = before[ends] - before[starts]
    return out


def parts(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in batches of about BATCH_CHARS characters."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > BATCH_CHARS:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part
