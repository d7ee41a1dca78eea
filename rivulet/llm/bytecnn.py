"""A small convolutional network over bytes, in numpy, for windows of fixed length.

Bytes are embedded, filters of several widths slide over a window, and each filter keeps its largest
response. A head turns the pooled responses into class probabilities: of one window by itself, or of a bag
of windows by the largest and the mean response of each filter over the bag.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

#: Windows that go through the filters at a time.
BLOCK = 256


def windows_of(data: bytes, length: int, stride: int) -> np.ndarray:
    """All windows of ``data``, the last filled up with zero bytes; at least one."""
    n = 1 + max(0, -(-(len(data) - length) // stride))
    padded = np.zeros((n - 1) * stride + length, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return sliding_window_view(padded, length)[::stride]


@dataclass
class ByteConv:
    embedding: np.ndarray
    filters: list[np.ndarray]  # per width: (width x dim, filters)
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray
    classes: list = field(default_factory=list)

    @classmethod
    def fresh(cls, classes: list, widths: tuple[int, ...], each: int, dim: int, bags: bool, seed: int) -> ByteConv:
        rng = np.random.default_rng(seed)
        small = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        features = each * len(widths) * (2 if bags else 1)
        return cls(
            small(256, dim, scale=1.0),
            [small(w * dim, each, scale=(w * dim) ** -0.5) for w in widths],
            np.zeros(each * len(widths), np.float32),
            small(features, len(classes), scale=features**-0.5),
            np.zeros(len(classes), np.float32),
            list(classes),
        )

    def responses(self, windows: np.ndarray, places: bool = False):
        """Pooled responses (windows, filters), and where each was found if asked."""
        dim = self.embedding.shape[1]
        embedded = self.embedding[windows]
        flat = embedded.reshape(len(windows), -1)
        best, found = [], []
        for kernel in self.filters:
            width = len(kernel) // dim
            n = windows.shape[1] - width + 1
            patches = sliding_window_view(flat, width * dim, axis=1)[:, ::dim]
            conv = (np.ascontiguousarray(patches).reshape(-1, width * dim) @ kernel).reshape(len(windows), n, -1)
            if places:
                where = conv.argmax(axis=1)
                found.append((patches, where))
                best.append(np.take_along_axis(conv, where[:, None, :], axis=1)[:, 0])
            else:
                best.append(conv.max(axis=1))
        pooled = np.maximum(np.concatenate(best, axis=1) + self.bias, 0)
        return (pooled, found) if places else pooled

    def head(self, features: np.ndarray) -> np.ndarray:
        logits = features @ self.weights + self.offset
        logits = np.exp(logits - logits.max(axis=1, keepdims=True))
        return logits / logits.sum(axis=1, keepdims=True)

    def window_probabilities(self, windows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.head(self.responses(windows[at : at + BLOCK])) for at in range(0, len(windows), BLOCK)])


def bag_features(responses: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Largest and mean response of each filter over bags of consecutive windows."""
    sizes = np.diff(np.append(starts, len(responses)))[:, None]
    return np.concatenate((np.maximum.reduceat(responses, starts), np.add.reduceat(responses, starts) / sizes), axis=1)


def train(
    model: ByteConv, bags: list[np.ndarray], labels: np.ndarray, pooled_bags: bool, rounds: int, batch: int, rate: float, seed: int, decay: float = 1e-4
) -> ByteConv:
    """Adam on the cross entropy; ``bags`` are arrays of windows, each of one window unless ``pooled_bags``."""
    rng = np.random.default_rng(seed)
    params = [model.embedding, *model.filters, model.bias, model.weights, model.offset]
    means, squares = ([np.zeros_like(p) for p in params] for _ in range(2))
    steps, total = 0, rounds * -(-len(bags) // batch)
    for _ in range(rounds):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            grads = _gradients(model, [bags[i] for i in chosen], labels[chosen], pooled_bags)
            steps += 1
            speed = rate * (1 - 0.9 * steps / total) * np.sqrt(1 - 0.999**steps) / (1 - 0.9**steps)
            for p, g, m, s in zip(params, grads, means, squares):
                g = g + decay * p
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= (speed * m / (np.sqrt(s) + 1e-8)).astype(np.float32)
    return model


def _gradients(model: ByteConv, bags: list[np.ndarray], labels: np.ndarray, pooled_bags: bool) -> list[np.ndarray]:
    windows = np.concatenate(bags)
    pooled, found = model.responses(windows, places=True)
    starts = np.cumsum([0, *[len(b) for b in bags[:-1]]])
    features = bag_features(pooled, starts) if pooled_bags else pooled
    back = model.head(features)
    back[np.arange(len(labels)), labels] -= 1
    back /= len(labels)
    into = back @ model.weights.T
    if pooled_bags:
        n = pooled.shape[1]
        sizes = np.diff(np.append(starts, len(windows)))
        bag = np.repeat(np.arange(len(bags)), sizes)
        grad = into[bag, n:] / sizes[bag, None]
        top = pooled == features[bag, :n]
        first = top & (np.cumsum(top, axis=0) - np.concatenate((np.zeros((1, n), int), np.cumsum(top, axis=0)))[starts[bag]] == 1)
        grad = grad + np.where(first, into[bag, :n], 0)
    else:
        grad = into
    grad = (grad * (pooled > 0)).astype(np.float32)
    dim, d_embedding, d_filters, at = model.embedding.shape[1], np.zeros_like(model.embedding), [], 0
    rows = np.arange(len(windows))[:, None]
    for kernel, (patches, where) in zip(model.filters, found):
        g = grad[:, at : at + kernel.shape[1]]
        at += kernel.shape[1]
        picked = patches[rows, where]  # windows, filters, width x dim
        d_filters.append(np.einsum("bf,bfk->kf", g, picked))
        width = len(kernel) // dim
        spread = (g[:, :, None] * kernel.T[None]).reshape(len(windows), -1, width, dim)
        symbols = windows[rows[:, :, None], where[:, :, None] + np.arange(width)]
        for column in range(dim):
            d_embedding[:, column] += np.bincount(symbols.ravel(), spread[..., column].ravel(), 256)
    return [d_embedding, *d_filters, grad.sum(axis=0), features.T @ back, back.sum(axis=0)]
