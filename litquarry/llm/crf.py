"""A linear-chain conditional random field: fitted on a bounded sample, decoded by Viterbi."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Crf:
    """Weights of features per label, of label pairs, and of the first label."""

    emit: np.ndarray
    step: np.ndarray
    first: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return features @ self.emit

    def decode(self, scores: Sequence[Sequence[float]]) -> list[int]:
        """The best label sequence of one chain; equal scores go to the smaller label."""
        if not len(scores):
            return []
        labels = range(len(self.first))
        step = self.step.tolist()
        best = [a + b for a, b in zip(self.first.tolist(), scores[0])]
        back = []
        for row in scores[1:]:
            came, new = [], []
            for y in labels:
                k = max(labels, key=lambda x: best[x] + step[x][y])
                came.append(k)
                new.append(best[k] + step[k][y] + row[y])
            back.append(came)
            best = new
        path = [max(labels, key=best.__getitem__)]
        for came in reversed(back):
            path.append(came[path[-1]])
        return path[::-1]

    def certain(self, scores: np.ndarray, label: int) -> bool:
        """Whether a position with these scores has ``label`` in the best path whatever surrounds it.

        No other label can gain more by its two transitions than the score it lacks. A chain may
        then be cut at such a position without changing the best path.
        """
        others = [y for y in range(len(self.first)) if y != label]
        gain = max(
            max(np.max(self.step[:, y] - self.step[:, label]), self.first[y] - self.first[label])
            + max(0.0, np.max(self.step[y, :] - self.step[label, :])) + scores[y]
            for y in others
        )
        return bool(gain < scores[label])


def fit(chains: list[tuple[np.ndarray, np.ndarray]], labels: int, rounds: int = 120, rate: float = 0.1, ridge: float = 1e-3) -> Crf:
    """Maximum likelihood with a ridge by Adam, from (features, labels) of each chain.

    The same chains in the same order give the same weights. Without a chain all weights are zero.
    """
    chains = [c for c in chains if len(c[1])]
    if not chains:
        return Crf(np.zeros((0, labels)), np.zeros((labels, labels)), np.zeros(labels))
    longest, width = max(len(y) for _, y in chains), chains[0][0].shape[1]
    lengths = np.array([len(y) for _, y in chains])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    x = np.zeros((len(chains), longest, width))
    y = np.zeros((len(chains), longest), np.int64)
    for row, i in enumerate(order):
        x[row, :lengths[row]], y[row, :lengths[row]] = chains[i]
    inside = np.arange(longest) < lengths[:, None]
    active = [int((lengths > t).sum()) for t in range(longest)]
    eye = np.eye(labels)
    seen = eye[y] * inside[..., None]
    total = inside.sum()
    seen_emit = np.einsum("nlf,nlk->fk", x, seen)
    seen_step = np.einsum("nla,nlb->ab", seen[:, :-1], seen[:, 1:])
    seen_first = seen[:, 0].sum(0)
    weights = [np.zeros((width, labels)), np.zeros((labels, labels)), np.zeros(labels)]
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for turn in range(1, rounds + 1):
        emit, step, first = weights
        score = x @ emit
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0] + first
        for t in range(1, longest):
            n = active[t]
            ahead[:n, t] = score[:n, t] + _sum_exp(ahead[:n, t - 1, :, None] + step, 1)
        for t in range(longest - 2, -1, -1):
            n = active[t + 1]
            behind[:n, t] = _sum_exp(step + (score[:n, t + 1] + behind[:n, t + 1])[:, None, :], 2)
        norm = _sum_exp(ahead[np.arange(len(lengths)), lengths - 1], 1)
        here = np.exp(ahead + behind - norm[:, None, None]) * inside[..., None]
        pairs = np.zeros((labels, labels))
        for t in range(1, longest):
            n = active[t]
            joint = ahead[:n, t - 1, :, None] + step + (score[:n, t] + behind[:n, t])[:, None, :] - norm[:n, None, None]
            pairs += np.exp(joint).sum(0)
        slopes = [
            (np.einsum("nlf,nlk->fk", x, here) - seen_emit) / total + ridge * emit,
            (pairs - seen_step) / total + ridge * step,
            (here[:, 0].sum(0) - seen_first) / total + ridge * first,
        ]
        for w, g, m, s in zip(weights, slopes, mean, square):
            m *= 0.9
            m += 0.1 * g
            s *= 0.999
            s += 0.001 * g * g
            w -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(s / (1 - 0.999**turn)) + 1e-8)
    return Crf(*weights)


def _sum_exp(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis=axis)) + top.squeeze(axis)
