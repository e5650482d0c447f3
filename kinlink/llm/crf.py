"""A linear-chain conditional random field on hashed features: fitting on the driver, Viterbi in numpy batches.

Feature weights are a table (feature, label), transitions a table (label, label). Fitting descends the negative
log-likelihood of small labelled sequences with the forward-backward sums of all sequences of a batch at once; decoding
runs Viterbi over many sequences in step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _lsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


@dataclass
class Field:
    labels: list[str]
    weights: np.ndarray  # (features, labels)
    moves: np.ndarray  # (from label, to label)
    start: np.ndarray

    def emissions(self, rows: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
        """Scores of ``n`` items by label; (rows, features) names the features that each item has."""
        return np.stack([np.bincount(rows, w[features], n) for w in self.weights.T], 1)

    def decode(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best labels of sequences laid end to end. Sequences run in step, the longest first; ties to the first label."""
        lengths = np.asarray(lengths, np.int64)
        ends = np.cumsum(lengths)
        begins, total = ends - lengths, int(lengths.sum())
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        if not len(order):
            return np.zeros(0, np.int64)
        begins, lengths = begins[order], lengths[order]
        back = np.zeros((total, len(self.labels)), np.int16)
        best = self.start + scores[begins]
        final = np.zeros((len(order), len(self.labels)))
        live = len(order)
        for t in range(1, int(lengths[0])):
            now = int(np.searchsorted(-lengths, -t, side="left"))  # sequences longer than t
            final[now:live], live = best[now:live], now
            paths = best[:now, :, None] + self.moves
            from_label = paths.argmax(1)
            back[begins[:now] + t] = from_label
            best = np.take_along_axis(paths, from_label[:, None, :], 1)[:, 0] + scores[begins[:now] + t]
        final[:live] = best[:live]
        out = np.zeros(total, np.int64)
        label = final.argmax(1)
        for t in range(int(lengths[0]) - 1, -1, -1):
            now = int(np.searchsorted(-lengths, -t, side="left"))
            at = begins[:now] + t
            out[at] = label[:now]
            label[:now] = back[at, label[:now]]
        return out


def fit(labels: list[str], n_features: int, sequences: list[tuple[list[list[int]], list[int]]], steps: int = 90, penalty: float = 1e-4, rate: float = 0.3) -> Field:
    """Fits on ``sequences`` of (features of each item, label of each item) by Adam over the whole small table."""
    sequences = sorted(sequences, key=lambda s: -len(s[1]))  # the first live[t] of them have an item at place t
    k, n = len(labels), len(sequences)
    longest = max((len(y) for _, y in sequences), default=1)
    truth = np.zeros((n, longest), np.int64)
    there = np.zeros((n, longest), bool)
    rows, features = [], []
    for s, (items, y) in enumerate(sequences):
        truth[s, : len(y)], there[s, : len(y)] = y, True
        for t, own in enumerate(items):
            rows += [s * longest + t] * len(own)
            features += own
    rows, features = np.array(rows, np.int64), np.array(features, np.int64)
    used, features = np.unique(features, return_inverse=True)
    w, m, b = np.zeros((len(used), k)), np.zeros((k, k)), np.zeros(k)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, m, b)]
    onehot = np.eye(k)[truth] * there[..., None]
    seen_moves = np.einsum("sti,stj->ij", onehot[:, :-1], onehot[:, 1:])
    items = max(there.sum(), 1)
    live = there.sum(0)
    for step in range(1, steps + 1):
        e = np.stack([np.bincount(rows, w[features, j], n * longest) for j in range(k)], 1).reshape(n, longest, k)
        ahead = np.zeros((n, longest, k))
        ahead[:, 0] = b + e[:, 0]
        for t in range(1, longest):
            ahead[: live[t], t] = _lsum(ahead[: live[t], t - 1, :, None] + m, 1) + e[: live[t], t]
        last = there.sum(1) - 1
        norm = _lsum(ahead[np.arange(n), np.maximum(last, 0)], 1)
        behind = np.full((n, longest, k), -1e30)
        behind[np.arange(n), np.maximum(last, 0)] = 0
        moves = np.zeros((k, k))
        for t in range(longest - 2, -1, -1):
            inside = live[t + 1]
            onward = m[None] + (e[:inside, t + 1] + behind[:inside, t + 1])[:, None, :]
            behind[:inside, t] = _lsum(onward, 2)
            both = ahead[:inside, t][:, :, None] + onward - norm[:inside, None, None]
            moves += np.exp(both).sum(0)
        marginal = np.where(there[..., None], np.exp(np.minimum(ahead + behind - norm[:, None, None], 0)), 0)
        gap = (marginal - onehot).reshape(-1, k)
        slopes = (
            np.stack([np.bincount(features, gap[rows, j], len(used)) for j in range(k)], 1) / items + penalty * w,
            (moves - seen_moves) / items + penalty * m,
            (marginal[:, 0] - onehot[:, 0]).sum(0) / items,
        )
        for x, g, (mean, square) in zip((w, m, b), slopes, state):
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            x -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    full = np.zeros((n_features, k))
    full[used] = w
    return Field(labels, full, m, b)
