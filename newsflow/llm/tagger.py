"""A linear-chain conditional random field over the tags outside, begin and inside."""

from __future__ import annotations

import numpy as np

OUTSIDE, BEGIN, INSIDE = range(3)
_NEVER = -1e4
#: What no sequence holds: inside at the start or behind outside.
_START = np.array([0.0, 0.0, _NEVER])
_STEP = np.array([[0.0, 0.0, _NEVER], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]])


def _sums(x: np.ndarray, axis: int) -> np.ndarray:
    """log(sum(exp(x))) along an axis."""
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Tagger:
    """Weights of features (slots x tags), of steps between tags, and of the first and last tag."""

    def __init__(self, slots: int) -> None:
        self.features, self.steps = np.zeros((slots, 3)), np.zeros((3, 3))
        self.first, self.last = np.zeros(3), np.zeros(3)

    def emissions(self, slots: np.ndarray) -> np.ndarray:
        """Scores (tokens x tags) of tokens given by the slots of their features."""
        total = np.zeros((len(slots), 3))
        for column in slots.T:
            total += self.features[column]
        return total

    def decode(self, slots: np.ndarray) -> list[int]:
        """The best tags of a sequence (tokens x features), by Viterbi."""
        scores = self.emissions(slots)
        best, back = self.first + _START + scores[0], []
        for row in scores[1:]:
            ways = best[:, None] + self.steps + _STEP
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + row
        tags = [int((best + self.last).argmax())]
        for came in reversed(back):
            tags.append(int(came[tags[-1]]))
        return tags[::-1]

    def likelihood(self, slots: np.ndarray, tags: np.ndarray, lengths: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Sum of log-likelihoods of sequences, and its gradient by features, steps, first and last.

        ``slots`` has a row for each token of all sequences, one behind the
        other; ``tags`` is padded, sequences x tokens.
        """
        n, width = tags.shape
        steps = self.steps + _STEP
        real = np.arange(width)[None, :] < lengths[:, None]
        scores = np.zeros((n, width, 3))
        scores[real] = self.emissions(slots)
        rows, end = np.arange(n), lengths - 1
        forward = np.zeros((n, width, 3))
        forward[:, 0] = self.first + _START + scores[:, 0]
        lasting = [np.flatnonzero(real[:, t]) for t in range(width)]  # short sequences cost nothing behind their end
        for t in range(1, width):
            at = lasting[t]
            forward[at, t] = _sums(forward[at, t - 1, :, None] + steps, 1) + scores[at, t]
        total = _sums(forward[rows, end] + self.last, 1)
        backward = np.zeros((n, width, 3))
        backward[rows, end] = self.last
        for t in range(width - 2, -1, -1):
            at = lasting[t + 1]
            backward[at, t] = _sums(steps[None] + (scores[at, t + 1] + backward[at, t + 1])[:, None, :], 2)
        share = np.zeros_like(scores)
        share[real] = np.exp((forward + backward - total[:, None, None])[real])
        truth = np.eye(3)[tags] * real[..., None]
        missing = truth - share
        by_feature, by_token = np.zeros_like(self.features), missing[real]
        for column in slots.T:
            for k in range(3):
                by_feature[:, k] += np.bincount(column, by_token[:, k], len(by_feature))
        pairs = np.zeros((3, 3))
        value = (scores * truth).sum() + self.first[tags[:, 0]].sum() + self.last[tags[rows, end]].sum() - total.sum()
        for t in range(1, width):
            live = real[:, t]
            if not live.any():
                break
            joint = forward[live, t - 1, :, None] + steps + (scores[live, t] + backward[live, t])[:, None, :] - total[live, None, None]
            pairs -= np.exp(joint).sum(axis=0)
            seen = np.zeros((3, 3))
            np.add.at(seen, (tags[live, t - 1], tags[live, t]), 1)
            pairs += seen
            value += (seen * self.steps).sum()
        last = truth[rows, end].sum(axis=0) - share[rows, end].sum(axis=0)
        return float(value), [by_feature, pairs, missing[:, 0].sum(axis=0), last]


def fit(sequences: list[tuple[np.ndarray, list[int]]], slots: int, rounds: int = 100, decay: float = 0.5, rate: float = 0.3) -> Tagger:
    """Maximise the likelihood of tagged sequences, less ``decay`` times half the squared weights.

    Steps are scaled by each weight's gradients so far. The same sequences in
    the same order give the same weights; no sequences give weights of zero.
    """
    tagger = Tagger(slots)
    if not sequences:
        return tagger
    lengths = np.array([len(tags) for _, tags in sequences])
    x, y = np.concatenate([found for found, _ in sequences]), np.zeros((len(sequences), int(lengths.max())), "int64")
    for i, (_, tags) in enumerate(sequences):
        y[i, : len(tags)] = tags
    weights = [tagger.features, tagger.steps, tagger.first, tagger.last]
    squares = [np.full(w.shape, 1e-6) for w in weights]
    for _ in range(rounds):
        _, gradient = tagger.likelihood(x, y, lengths)
        for w, s, g in zip(weights, squares, gradient):
            g = g - decay * w
            s += g * g
            w += rate * g / np.sqrt(s)
    return tagger
