"""Text similarity scores from 0 to 100.

``levenshtein_score`` is a Column function. ``weighted_ratio`` is the best of several
difflib ratios, each with a weight.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import Column, functions as F

# Weights of the forms and the length ratios at which they change.
TOKEN_WEIGHT = 0.95
PARTIAL_WEIGHT = 0.9
LONG_PARTIAL_WEIGHT = 0.6
PARTIAL_FROM = 1.5
LONG_PARTIAL_ABOVE = 8.0

_NOT_WORD = re.compile(r"\W")


def levenshtein_score(left: Column, right: Column) -> Column:
    """100 for equal texts, down to 0 where every character differs."""
    longest = F.greatest(F.length(left), F.length(right))
    return F.lit(100.0) * (F.lit(1.0) - F.levenshtein(left, right) / longest)


def normalise(text: str) -> str:
    """ASCII letters, digits and underscores in lower case; other characters become spaces."""
    ascii_text = text.encode("ascii", "ignore").decode("ascii")
    return _NOT_WORD.sub(" ", ascii_text).lower().strip()


def _percent(a: str, b: str) -> int:
    return 100 if a == b else round(100 * SequenceMatcher(None, a, b).ratio())


def _best_window(a: str, b: str) -> int:
    """Best ratio of the shorter text with a window of its length in the longer one."""
    if a == b:
        return 100
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 0
    best = 0.0
    for in_short, in_long, _ in SequenceMatcher(None, short, long).get_matching_blocks():
        start = max(in_long - in_short, 0)
        best = max(best, SequenceMatcher(None, short, long[start:start + len(short)]).ratio())
    return 100 if best > 0.995 else round(100 * best)


def _token_set(a: set, b: set, compare) -> int:
    """Best comparison among the shared tokens alone and with each side's own tokens."""
    shared = " ".join(sorted(a & b))
    left = f"{shared} {' '.join(sorted(a - b))}".strip()
    right = f"{shared} {' '.join(sorted(b - a))}".strip()
    return max(compare(shared, left), compare(shared, right), compare(left, right))


def weighted_ratio(a: str, b: str) -> int:
    """Score of two texts that ``normalise`` has prepared."""
    if not a or not b:
        return 0
    lengths = max(len(a), len(b)) / min(len(a), len(b))
    compare, weight = _percent, 1.0
    scores = [_percent(a, b)]
    if lengths >= PARTIAL_FROM:
        compare = _best_window
        weight = LONG_PARTIAL_WEIGHT if lengths > LONG_PARTIAL_ABOVE else PARTIAL_WEIGHT
        scores.append(compare(a, b) * weight)
    tokens_a, tokens_b = a.split(), b.split()
    in_order = compare(" ".join(sorted(tokens_a)), " ".join(sorted(tokens_b)))
    as_sets = _token_set(set(tokens_a), set(tokens_b), compare)
    scores += [in_order * TOKEN_WEIGHT * weight, as_sets * TOKEN_WEIGHT * weight]
    return round(max(scores))


def _forms(text: str) -> list[str]:
    """The three texts that the ratios compare: whole, tokens in order, distinct tokens in order."""
    tokens = text.split()
    return [text, " ".join(sorted(tokens)), " ".join(sorted(set(tokens)))]


class Candidates:
    """Candidate texts in order, with letter counts that bound each ratio from above.

    A ratio is at most what the letters common to both texts allow. Candidates are
    scored in the order of their bounds, until no bound reaches the best score.
    """

    def __init__(self, texts: list[str]):
        self.texts = [normalise(t) for t in texts]
        self.letters = {c: i for i, c in enumerate(sorted(set("".join(self.texts))))}
        forms = list(zip(*map(_forms, self.texts)))
        self.counts = [np.stack([self._count(t) for t in form]) for form in forms]
        self.lengths = [np.array([len(t) for t in form], dtype=float) for form in forms]
        self.by_token: dict[str, list[int]] = {}
        for position, text in enumerate(self.texts):
            for token in set(text.split()):
                self.by_token.setdefault(token, []).append(position)

    def _count(self, text: str) -> np.ndarray:
        row = np.zeros(len(self.letters))
        for c in text:
            if c in self.letters:
                row[self.letters[c]] += 1
        return row

    def _bounds(self, text: str) -> np.ndarray:
        """No candidate scores above its bound."""
        whole_text, *_, distinct = _forms(text)
        longer = np.maximum(self.lengths[0], len(whole_text))
        shorter = np.maximum(np.minimum(self.lengths[0], len(whole_text)), 1)
        windows = longer / shorter >= PARTIAL_FROM
        weight = np.where(longer / shorter > LONG_PARTIAL_ABOVE, LONG_PARTIAL_WEIGHT, PARTIAL_WEIGHT)

        whole, window = [], []
        for counts, lengths, form in zip(self.counts, self.lengths, _forms(text)):
            common = np.minimum(counts, self._count(form)).sum(axis=1)
            whole.append(200 * common / np.maximum(lengths + len(form), 1))
            window.append(200 * common / np.maximum(np.minimum(lengths, len(form)) + common, 1))

        shared = np.zeros(len(self.texts))  # length of the shared tokens, joined
        for token in set(text.split()):
            shared[self.by_token.get(token, [])] += len(token) + 1
        shared = np.maximum(shared - 1, 0)
        with_shared = 200 * shared / np.maximum(shared + np.minimum(self.lengths[2], len(distinct)), 1)
        in_whole = np.maximum.reduce([whole[1], whole[2], with_shared]) * TOKEN_WEIGHT
        in_window = np.maximum.reduce([window[1], window[2], np.where(shared > 0, 100, 0)]) * TOKEN_WEIGHT
        bound = np.where(windows, np.maximum(window[0], in_window) * weight, in_whole)
        return np.maximum(bound, whole[0]) + 1  # for the rounding inside each form

    def best(self, text: str, threshold: int) -> tuple[int, int] | None:
        """(position, score) of the earliest best candidate above the threshold."""
        text = normalise(text)
        found = None
        if text and self.texts:
            bounds = self._bounds(text)
            for position in np.argsort(-bounds, kind="stable"):
                if bounds[position] < (found[1] if found else threshold + 1):
                    break
                score = weighted_ratio(text, self.texts[position])
                if score > threshold and (found is None or (-score, position) < (-found[1], found[0])):
                    found = (int(position), score)
        return found
