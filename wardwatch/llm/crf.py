"""Linear-chain conditional random fields: forward-backward over many chains at once.

Chains stand one after another in one array. The array is cut into blocks of equal length;
all blocks advance together, first as products of their step matrices, which give what enters
each block from either side, then as vectors. The result is that of the plain recursion.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 64


def marginals(
    scores: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of each place, and expected numbers of moves between labels.

    ``scores`` (places, labels) and ``start``, ``moves`` are logarithms; ``first`` marks the
    first place of each chain.
    """
    places, labels = scores.shape
    if not places:
        return np.zeros((0, labels)), np.zeros((labels, labels))
    count = -(-places // BLOCK)
    gain = np.ones((count * BLOCK, labels))
    gain[:places] = np.exp(scores - scores.max(axis=1, keepdims=True))
    fresh = np.ones(count * BLOCK, bool)
    fresh[:places] = first
    gain = np.ascontiguousarray(gain.reshape(count, BLOCK, labels).transpose(1, 0, 2))
    fresh = np.ascontiguousarray(fresh.reshape(count, BLOCK).T)
    step, enter = np.exp(moves - moves.max()), np.exp(start - start.max())

    matrix = np.broadcast_to(np.eye(labels), (count, labels, labels)).copy()
    for t in range(BLOCK):
        new = (matrix.reshape(-1, labels) @ step).reshape(count, labels, labels)
        anew = np.flatnonzero(fresh[t])
        if len(anew):
            new[anew] = matrix[anew].sum(axis=2, keepdims=True) * enter
        new *= gain[t][:, None, :]
        new /= new.max(axis=(1, 2), keepdims=True)
        matrix = new

    into = np.ones((count + 1, labels))
    back = np.ones((count + 1, labels))
    for k in range(count):
        row = into[k] @ matrix[k]
        into[k + 1] = row / row.sum()
    for k in range(count - 1, -1, -1):
        row = matrix[k] @ back[k + 1]
        back[k] = row / row.sum()

    ahead = np.empty_like(gain)
    row = into[:-1]
    for t in range(BLOCK):
        new = row @ step
        new[fresh[t]] = enter
        new *= gain[t]
        new /= new.sum(axis=1, keepdims=True)
        ahead[t] = row = new

    moved = np.zeros((labels, labels))
    out = np.empty_like(gain)
    behind = back[1:]
    for t in range(BLOCK - 1, -1, -1):
        both = ahead[t] * behind
        out[t] = both / both.sum(axis=1, keepdims=True)
        reach = gain[t] * behind
        before = ahead[t - 1] if t else into[:-1]
        inside = ~fresh[t]
        if inside.any():
            left, right = before[inside], reach[inside]
            total = ((left @ step) * right).sum(axis=1, keepdims=True)
            moved += step * ((left / total).T @ right)
        behind = reach @ step.T
        behind[fresh[t]] = 1.0
        behind /= behind.sum(axis=1, keepdims=True)
    flat = out.transpose(1, 0, 2).reshape(-1, labels)
    return flat[:places], moved


@dataclass
class Field:
    """Weights of a field: per feature and label, for first labels, and for moves."""

    weights: np.ndarray
    start: np.ndarray
    moves: np.ndarray

    def scores(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Sums of the weights of each thing's features; a thing has at least one."""
        return np.add.reduceat(self.weights[features], bounds[:-1], axis=0)


def fit(
    features: np.ndarray,
    bounds: np.ndarray,
    things: np.ndarray,
    first: np.ndarray,
    labels: np.ndarray,
    n_features: int,
    n_labels: int,
    rounds: int = 40,
    rate: float = 0.1,
    penalty: float = 1e-6,
) -> Field:
    """Maximum likelihood by gradient steps with adaptive rates.

    Distinct things have the features ``features[bounds[i] : bounds[i + 1]]``; the chains
    are places that show a thing and have a label.
    """
    places = len(things)
    field = Field(
        np.zeros((n_features, n_labels), np.float32), np.zeros(n_labels), np.zeros((n_labels,) * 2)
    )
    if not places:
        return field
    sizes = np.diff(bounds)
    truth = np.zeros((places, n_labels))
    truth[np.arange(places), labels] = 1
    seen_start = truth[first].sum(axis=0)
    inner = np.flatnonzero(~first)
    seen_moves = np.zeros((n_labels, n_labels))
    np.add.at(seen_moves, (labels[inner - 1], labels[inner]), 1)
    parts = [field.weights, field.start, field.moves]
    means = [np.zeros_like(p) for p in parts]
    squares = [np.zeros_like(p) for p in parts]
    for turn in range(1, rounds + 1):
        scores = field.scores(features, bounds)[things].astype(np.float64)
        found, moved = marginals(scores, first, field.start, field.moves)
        left = truth - found
        slope = np.empty_like(field.weights)
        for label in range(n_labels):
            by_thing = np.bincount(things, left[:, label], len(sizes))
            slope[:, label] = np.bincount(features, np.repeat(by_thing, sizes), n_features)
        slopes = [
            slope / places - penalty * field.weights,
            (seen_start - found[first].sum(axis=0)) / places,
            (seen_moves - moved) / places,
        ]
        for part, mean, square, slope in zip(parts, means, squares, slopes):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope**2 - square)
            part += rate * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
    return field
