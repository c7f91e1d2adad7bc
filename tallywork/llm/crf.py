"""A linear-chain conditional random field with two labels: fitting by gradient steps, decoding by Viterbi."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEPS = 100
RATE = 0.1
DECAY = 1e-3


@dataclass(frozen=True)
class Model:
    """Weights of each feature for label 1 against label 0, of the step from label to label, and of the first label."""

    weights: np.ndarray
    bias: float
    steps: np.ndarray
    first: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Score of label 1 against label 0 at each place, without its neighbours."""
        return features @ self.weights + self.bias


def _padded(values: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences laid side by side, a row for each: the values, and where there are any."""
    ends = np.cumsum(lengths)
    there = np.arange(lengths.max(initial=0))[None, :] < lengths[:, None]
    out = np.zeros(there.shape, values.dtype)
    out[there] = values[: ends[-1] if len(ends) else 0]
    return out, there


def _both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


def _expected(score: np.ndarray, there: np.ndarray, steps: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """By forward and backward sums: chance of label 1 at each place, expected steps, expected first labels, log of all paths."""
    rows, width = score.shape
    unary = np.stack([np.zeros_like(score), score], axis=2)
    forward = np.zeros((rows, width, 2))
    backward = np.zeros((rows, width, 2))
    forward[:, 0] = unary[:, 0] + first
    for t in range(1, width):
        through = _both(forward[:, t - 1, 0, None] + steps[0], forward[:, t - 1, 1, None] + steps[1])
        forward[:, t] = np.where(there[:, t, None], through + unary[:, t], forward[:, t - 1])
    for t in range(width - 2, -1, -1):
        after = unary[:, t + 1] + backward[:, t + 1]
        through = _both(steps[None, :, 0] + after[:, 0, None], steps[None, :, 1] + after[:, 1, None])
        backward[:, t] = np.where(there[:, t + 1, None], through, 0.0)
    total = _both(forward[:, -1, 0], forward[:, -1, 1])
    chance = np.exp(forward[:, :, 1] + backward[:, :, 1] - total[:, None]) * there
    counts = np.zeros((2, 2))
    for a in range(2):
        for b in range(2):
            path = forward[:, :-1, a] + steps[a, b] + unary[:, 1:, b] + backward[:, 1:, b] - total[:, None]
            counts[a, b] = np.exp(path[there[:, 1:]]).sum()
    start = chance[:, 0].sum()
    return chance, counts, np.array([rows - start, start]), float(total.sum())


def fit(features: np.ndarray, labels: np.ndarray, lengths: np.ndarray, steps: int = STEPS) -> Model:
    """The penalised maximum-likelihood field of labelled sequences that stand one after the other; each length is at least 1.

    Adam steps from zero, so that equal rows give an equal model. No sequence: a model that calls everything label 1.
    """
    if not len(lengths):
        return Model(np.zeros(features.shape[1]), 1.0, np.zeros((2, 2)), np.zeros(2))
    width = features.shape[1]
    gold, there = _padded(labels.astype(np.int64), lengths)
    seen = np.zeros((2, 2))
    for a in range(2):
        for b in range(2):
            seen[a, b] = (there[:, 1:] & (gold[:, :-1] == a) & (gold[:, 1:] == b)).sum()
    start = np.array([(gold[:, 0] == 0).sum(), (gold[:, 0] == 1).sum()], float)
    wanted = labels @ features
    place = np.zeros(width + 1 + 4 + 2)
    mean, square = np.zeros_like(place), np.zeros_like(place)
    n = len(labels)
    for step in range(1, steps + 1):
        score, _ = _padded(features @ place[:width] + place[width], lengths)
        chance, counts, begins, _ = _expected(score, there, place[width + 1 : width + 5].reshape(2, 2), place[width + 5 :])
        own = chance[there]
        slope = np.concatenate([wanted - own @ features, [labels.sum() - own.sum()], (seen - counts).ravel(), start - begins]) / n - DECAY * place
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        place = place + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Model(place[:width], float(place[width]), place[width + 1 : width + 5].reshape(2, 2), place[width + 5 :])


def viterbi(score: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """The likeliest labels of sequences that stand one after the other; ties go to label 0.

    Longer sequences come first within, so each step looks only at those that still run.
    """
    out = np.zeros(len(score), np.int8)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    if not len(order):
        return out
    begin = np.concatenate([[0], np.cumsum(lengths)])[:-1][order]
    length = lengths[order]
    back = np.zeros((len(score), 2), np.int8)
    best = np.stack([np.full(len(order), model.first[0]), model.first[1] + score[begin]], axis=1)
    running = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")
    for t in range(1, length[0]):
        live = running[t]
        at = begin[:live] + t
        for label in range(2):
            stay, change = best[:live, 0] + model.steps[0, label], best[:live, 1] + model.steps[1, label]
            back[at, label] = change > stay
        zero = np.where(back[at, 0], best[:live, 1] + model.steps[1, 0], best[:live, 0] + model.steps[0, 0])
        one = np.where(back[at, 1], best[:live, 1] + model.steps[1, 1], best[:live, 0] + model.steps[0, 1]) + score[at]
        best[:live, 0], best[:live, 1] = zero, one
    label = (best[:, 1] > best[:, 0]).astype(np.int8)
    for t in range(length[0] - 1, -1, -1):
        live = running[t]
        at = begin[:live] + t
        out[at] = label[:live]
        label[:live] = back[at, label[:live]]
    return out
