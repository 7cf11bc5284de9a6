"""A linear-chain conditional random field in numpy.

Tokens come as classes (strings).  The score of a label is a sum of weights of the classes
at five offsets around the token, each class also by its coarse part (before the first
``:``), plus a weight for each pair of neighbouring labels.  Training is full-batch
gradient ascent on the regularised log-likelihood (Adam), decoding is Viterbi; both run
over padded batches of sequences.
"""

from __future__ import annotations

import numpy as np

OFFSETS = (-2, -1, 0, 1, 2)
NEVER = -1e4

Model = dict  # labels, rows of weights by (offset, class), weights, transitions, first


def _features(classes: list[str], place: int) -> list[tuple[int, str]]:
    out = []
    for offset in OFFSETS:
        at = place + offset
        own = classes[at] if 0 <= at < len(classes) else "edge"
        out += [(offset, own), (offset, own.split(":")[0] + "*")]
    return out


def allowed(labels: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Forbidden transitions and first labels, as large negative scores: ``I-x`` follows ``B-x`` or ``I-x`` only."""
    pairs, first = np.zeros((len(labels), len(labels))), np.zeros(len(labels))
    for place, label in enumerate(labels):
        if label.startswith("I-"):
            first[place] = NEVER
            for before, other in enumerate(labels):
                if other[2:] != label[2:]:
                    pairs[before, place] = NEVER
    return pairs, first


def train(table: list[tuple[list[str], list[str]]], labels: list[str], rounds: int = 150, rate: float = 0.1, penalty: float = 0.02) -> Model:
    """Weights for sequences of ``(classes, labels)``."""
    rows: dict[tuple[int, str], int] = {}
    count, longest, width = len(table), max(len(classes) for classes, _ in table), len(OFFSETS) * 2
    # Row 0 is the padding of unused positions.
    features = np.zeros((count, longest, width), np.int64)
    gold = np.zeros((count, longest), np.int64)
    mask = np.zeros((count, longest), bool)
    place_of = {label: place for place, label in enumerate(labels)}
    for i, (classes, marks) in enumerate(table):
        for t, mark in enumerate(marks):
            features[i, t] = [rows.setdefault(feature, len(rows) + 1) for feature in _features(classes, t)]
            gold[i, t], mask[i, t] = place_of[mark], True
    size = len(labels)
    hard_pairs, hard_first = allowed(labels)
    weights, pairs = np.zeros((len(rows) + 1, size)), np.zeros((size, size))
    moments = [np.zeros_like(x) for x in (weights, weights, pairs, pairs)]
    both = mask[:, 1:] & mask[:, :-1]
    gold_pairs = np.zeros((size, size))
    np.add.at(gold_pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    # Rows of the gradient that a feature owns lie together in this order.
    used = features[mask]
    order = np.argsort(used, axis=None, kind="stable")
    owners, starts = np.unique(used.ravel()[order], return_index=True)
    tokens = order // width
    last = (np.arange(longest) >= (mask.sum(axis=1) - 1)[:, None])[:, :, None]
    for step in range(1, rounds + 1):
        emit = weights[features].sum(axis=2)
        emit = np.where(mask[:, :, None], np.exp(emit - emit.max(axis=2, keepdims=True)), 1.0)
        move = np.exp(pairs + hard_pairs)
        forward, backward = np.empty((count, longest, size)), np.ones((count, longest, size))
        scale = np.empty((count, longest, 1))
        for t in range(longest):
            ahead = emit[:, t] * (forward[:, t - 1] @ move if t else np.exp(hard_first))
            scale[:, t] = ahead.sum(axis=1, keepdims=True)
            forward[:, t] = ahead / scale[:, t]
        for t in range(longest - 2, -1, -1):
            back = (emit[:, t + 1] * backward[:, t + 1] / scale[:, t + 1]) @ move.T
            backward[:, t] = np.where(last[:, t], 1.0, back)
        single = (forward * backward)[mask]
        single[np.arange(len(single)), gold[mask]] -= 1
        slope = np.zeros_like(weights)
        slope[owners] = np.add.reduceat(single[tokens], starts, axis=0)
        later = (emit * backward / scale)[:, 1:][both]
        expected = move * (forward[:, :-1][both].T @ later)
        for own, gradient, first, second in ((weights, slope, 0, 1), (pairs, expected - gold_pairs, 2, 3)):
            gradient = gradient + penalty * own
            moments[first] = 0.9 * moments[first] + 0.1 * gradient
            moments[second] = 0.999 * moments[second] + 0.001 * gradient**2
            own -= rate * (moments[first] / (1 - 0.9**step)) / (np.sqrt(moments[second] / (1 - 0.999**step)) + 1e-8)
    return {"labels": labels, "rows": rows, "weights": weights, "move": pairs + hard_pairs, "first": hard_first}


class Decoder:
    """Viterbi over batches of sequences; the scores of a class are summed once and kept."""

    def __init__(self, model: Model):
        self.model = model
        size = len(model["labels"])
        self.places: dict[str, int] = {}
        self.scores = np.zeros((0, len(OFFSETS), size))
        self.fresh: list[np.ndarray] = []
        self.place("edge")

    def place(self, name: str) -> int:
        """The row of a class in the score table."""
        at = self.places.get(name)
        if at is None:
            at = self.places[name] = len(self.places)
            rows, weights = self.model["rows"], self.model["weights"]
            coarse = name.split(":")[0] + "*"
            self.fresh.append(np.stack([weights[rows.get((o, name), 0)] + weights[rows.get((o, coarse), 0)] for o in OFFSETS]))
        return at

    def decode(self, sequences: list[list[str]]) -> list[list[str]]:
        """The best labels of each sequence."""
        out: list[list[str]] = [[] for _ in sequences]
        order = sorted((i for i, classes in enumerate(sequences) if classes), key=lambda i: len(sequences[i]))
        while order:
            longest = len(sequences[order[-1]])
            share = max(1, (1 << 18) // longest)
            part = [i for i in order[-share:] if 2 * len(sequences[i]) >= longest]
            del order[-len(part) :]
            for i, labels in zip(part, self._decode([sequences[i] for i in part])):
                out[i] = labels
        return out

    def _decode(self, sequences: list[list[str]]) -> list[list[str]]:
        labels, move = self.model["labels"], self.model["move"]
        lengths = np.array([len(classes) for classes in sequences])
        longest, edge = int(lengths.max()), 2
        codes = np.zeros((len(sequences), longest + 2 * edge), np.int64)  # class 0 is the edge
        for row, classes in enumerate(sequences):
            codes[row, edge : edge + len(classes)] = [self.place(name) for name in classes]
        if self.fresh:
            self.scores = np.concatenate([self.scores, np.stack(self.fresh)])
            self.fresh = []
        emit = sum(self.scores[codes[:, edge + o : edge + o + longest], place] for place, o in enumerate(OFFSETS))
        back = np.zeros((longest, len(sequences), len(labels)), np.int8)
        best = emit[:, 0] + self.model["first"]
        ends = np.zeros(len(sequences), np.int64)
        for t in range(longest):
            if t:
                paths = best[:, :, None] + move
                back[t] = paths.argmax(axis=1)
                best = np.take_along_axis(paths, back[t][:, None, :].astype(np.int64), axis=1)[:, 0] + emit[:, t]
            last = lengths == t + 1
            ends[last] = best[last].argmax(axis=1)
        out = []
        for row, length in enumerate(lengths.tolist()):
            at, path = int(ends[row]), []
            for t in range(length - 1, -1, -1):
                path.append(labels[at])
                at = int(back[t, row, at])
            out.append(path[::-1])
        return out
