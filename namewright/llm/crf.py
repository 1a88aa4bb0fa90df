"""Linear-chain conditional random fields in numpy, over batches of padded chains.

Shapes: ``scores`` (chains, steps, labels) are the emission scores, ``mask`` (chains, steps) is true where a chain has
a step (a prefix of each row), ``change`` (labels, labels) the transition scores from row to column.
"""

from __future__ import annotations

import numpy as np


def marginals(scores: np.ndarray, mask: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: label probabilities of each step, and expected transitions summed over all chains."""
    n, steps, labels = scores.shape
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    move = np.exp(change - change.max())
    ahead = np.empty_like(local)
    at = np.full((n, labels), 1.0 / labels, local.dtype)
    for t in range(steps):
        now = (at @ move if t else at) * local[:, t]
        now /= now.sum(axis=1, keepdims=True)
        at = np.where(mask[:, t : t + 1], now, at)
        ahead[:, t] = at
    expected = np.zeros((labels, labels))
    behind = np.ones((n, labels), local.dtype)
    out = np.empty_like(local)
    for t in range(steps - 1, -1, -1):
        here = ahead[:, t] * behind
        out[:, t] = here / here.sum(axis=1, keepdims=True)
        into = local[:, t] * behind
        if t:
            both = ahead[:, t - 1]
            weight = mask[:, t : t + 1] / np.maximum(((both @ move) * into).sum(axis=1, keepdims=True), 1e-300)
            expected += move * (both.T @ (into * weight))
        back = into @ move.T
        back /= back.sum(axis=1, keepdims=True)
        behind = np.where(mask[:, t : t + 1], back, behind)
    return out, expected


def chain_marginals(scores: np.ndarray, begin: np.ndarray, change: np.ndarray, steps: int = 64, cells: int = 1 << 19) -> np.ndarray:
    """Label probabilities of the words (words, labels) of whole chains, however long; ``begin`` has each chain's first word (ascending).

    Forward-backward as a scan: chains fall into blocks of ``steps`` words, all blocks yield the matrix that carries a message
    over them, messages pass from block to block through these, and each block is then done by itself between
    the messages at its borders.  ``steps`` and ``cells`` (words at a time) bound memory only.
    """
    n, labels = scores.shape
    size = np.diff(np.append(begin, n))
    blocks = -(-size // steps)
    first = np.cumsum(blocks) - blocks  # a chain's first block
    chain = np.repeat(np.arange(len(begin)), blocks)
    head = begin[chain] + steps * (np.arange(len(chain)) - first[chain])
    count = np.minimum(head + steps, (begin + size)[chain]) - head
    move = np.exp(change - change.max()).astype(scores.dtype)
    starts = np.zeros(len(chain), bool)
    starts[first] = True
    lines = max(1, cells // steps)

    def local(part: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        span = np.arange(count[part].max())
        mask = span < count[part][:, None]
        index = np.minimum(head[part][:, None] + span, n - 1)
        own = scores[index]
        return np.exp(own - own.max(axis=2, keepdims=True)), mask, index

    parts = [slice(a, min(a + lines, len(chain))) for a in range(0, len(chain), lines)]
    into = np.full((len(chain), labels), 1.0 / labels, scores.dtype)  # the message at the word before a block
    back = np.ones((len(chain), labels), scores.dtype)  # and the one that comes back at its last word
    if blocks.max(initial=0) > 1:
        carry = np.empty((len(chain), labels, labels), scores.dtype)
        for part in parts:
            own, mask, _ = local(part)
            at = np.broadcast_to(np.eye(labels, dtype=scores.dtype), (own.shape[0], labels, labels))
            for t in range(own.shape[1]):
                moved = at @ move
                if t == 0:
                    moved = np.where(starts[part][:, None, None], at, moved)
                moved = moved * own[:, t][:, None, :]
                moved = moved / moved.max(axis=(1, 2), keepdims=True)
                at = np.where(mask[:, t][:, None, None], moved, at)
            carry[part] = at
        for k in range(1, int(blocks.max())):
            now = first[blocks > k] + k
            message = np.einsum("na,nab->nb", into[now - 1], carry[now - 1])
            into[now] = message / message.sum(axis=1, keepdims=True)
        for k in range(int(blocks.max()) - 1, 0, -1):
            now = first[blocks > k] + k
            message = np.einsum("nab,nb->na", carry[now], back[now])
            back[now - 1] = message / message.sum(axis=1, keepdims=True)
    out = np.empty_like(scores)
    for part in parts:
        own, mask, index = local(part)
        ahead, at = np.empty_like(own), into[part]
        for t in range(own.shape[1]):
            moved = at @ move
            if t == 0:
                moved = np.where(starts[part][:, None], at, moved)
            now = moved * own[:, t]
            now /= now.sum(axis=1, keepdims=True)
            at = np.where(mask[:, t : t + 1], now, at)
            ahead[:, t] = at
        behind, found = back[part], np.empty_like(own)
        for t in range(own.shape[1] - 1, -1, -1):
            here = ahead[:, t] * behind
            found[:, t] = here / here.sum(axis=1, keepdims=True)
            earlier = (own[:, t] * behind) @ move.T
            earlier /= earlier.sum(axis=1, keepdims=True)
            behind = np.where(mask[:, t : t + 1], earlier, behind)
        out[index[mask]] = found[mask]
    return out


def viterbi(scores: np.ndarray, mask: np.ndarray, change: np.ndarray) -> np.ndarray:
    """The best labels of each chain; ties go to the smaller label.  Steps beyond a chain's end get 0."""
    n, steps, _ = scores.shape
    best = scores[:, 0].copy()
    from_ = np.zeros(scores.shape, np.int16)
    for t in range(1, steps):
        through = best[:, :, None] + change
        from_[:, t] = through.argmax(axis=1)
        best = np.where(mask[:, t : t + 1], through.max(axis=1) + scores[:, t], best)
    out = np.zeros((n, steps), np.int64)
    state = best.argmax(axis=1)
    rows = np.arange(n)
    for t in range(steps - 1, -1, -1):
        live = mask[:, t]
        out[live, t] = state[live]
        state = np.where(live, from_[rows, t, state], state)
    return out


class Trainer:
    """Weights of sparse features by full-batch ascent with per-weight step sizes.

    A token's emission is the sum of ``slots`` rows of the weights: ``features[k]`` gives the first token type's
    feature numbers, flattened, with ``begin[k]`` where each type's begin.
    """

    def __init__(self, n_features: int, labels: int, rate: float = 0.5, decay: float = 1e-4):
        self.weights = np.zeros((n_features, labels))
        self.change = np.zeros((labels, labels))
        self.rate, self.decay = rate, decay
        self._w = np.full_like(self.weights, 1e-6)
        self._c = np.full_like(self.change, 1e-6)

    def step(self, weight_gradient: np.ndarray, change_gradient: np.ndarray) -> None:
        for value, total, gradient in ((self.weights, self._w, weight_gradient), (self.change, self._c, change_gradient)):
            gradient = gradient - self.decay * value
            total += gradient * gradient
            value += self.rate * gradient / np.sqrt(total)


def gathered(weights: np.ndarray, features: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sum of the weights of each type's features; types may have none."""
    out = np.zeros((len(begin) - 1, weights.shape[1]), weights.dtype)
    some = begin[1:] > begin[:-1]
    if some.any():
        out[some] = np.add.reduceat(weights[features], begin[:-1][some], axis=0)
    return out


def scattered(gradient: np.ndarray, features: np.ndarray, begin: np.ndarray, n_features: int) -> np.ndarray:
    """The gradient of the weights, from the gradient of each type's emission."""
    rows = np.repeat(gradient, np.diff(begin), axis=0)
    return np.stack([np.bincount(features, rows[:, k], n_features) for k in range(gradient.shape[1])], axis=1)
