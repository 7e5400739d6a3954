"""A small one-dimensional convolutional network in numpy: several filter widths over symbols, max pooling, softmax."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

SYMBOLS = 256


class ConvNet:
    """Classes of fixed-length windows of byte-sized symbols.

    A filter of width ``w`` is ``w`` tables of one weight per symbol (a convolution over one-hot symbols), so a
    convolution is a sum of table rows.  Every filter's largest response over the window goes through a rectifier into
    a softmax.  Symbol 0 is padding.
    """

    def __init__(self, classes: int, widths: Sequence[int] = (2, 3, 4), filters: int = 16, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.widths = tuple(widths)
        self.tables = [rng.normal(0, 0.3 / np.sqrt(w), (w, SYMBOLS, filters)).astype(np.float32) for w in self.widths]
        self.biases = [np.zeros(filters, np.float32) for _ in self.widths]
        self.out = rng.normal(0, 0.1, (filters * len(self.widths), classes)).astype(np.float32)
        self.out_bias = np.zeros(classes, np.float32)
        self.temperature = 1.0
        self._pairs: list[np.ndarray] | None = None

    def _responses(self, x: np.ndarray, where: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
        best, at = [], []
        for w, t in zip(self.widths, self.tables, strict=True):
            length = x.shape[1] - w + 1
            total = t[0][x[:, :length]]
            for j in range(1, w):
                total += t[j][x[:, j:j + length]]
            if where:
                place = total.argmax(1)
                at.append(place)
                best.append(np.take_along_axis(total, place[:, None], 1)[:, 0])
            else:
                best.append(total.max(1))
        return best, at

    def _fast(self, x: np.ndarray) -> np.ndarray:
        """Pooled responses with two neighbouring symbols looked up at a time."""
        if self._pairs is None:
            self._pairs = [[(t[j][:, None] + t[j + 1][None]).reshape(SYMBOLS * SYMBOLS, -1) for j in range(0, len(t) - 1, 2)]
                           for t in self.tables]
        pairs = x[:, :-1].astype(np.int32) * SYMBOLS + x[:, 1:]
        best = []
        for w, t, two in zip(self.widths, self.tables, self._pairs, strict=True):
            length = x.shape[1] - w + 1
            total = two[0].take(pairs[:, :length], 0)
            for j in range(2, w - 1, 2):
                total += two[j // 2].take(pairs[:, j:j + length], 0)
            if w % 2:
                total += t[w - 1].take(x[:, w - 1:w - 1 + length], 0)
            best.append(total.max(1))
        return self._pooled(best)

    def _pooled(self, best: list[np.ndarray]) -> np.ndarray:
        return np.concatenate([np.maximum(b + c, 0) for b, c in zip(best, self.biases, strict=True)], 1)

    def scores(self, x: np.ndarray, batch: int = 256) -> np.ndarray:
        """Logits of every window, divided by the calibrated temperature."""
        parts = [self._fast(x[i:i + batch]) @ self.out + self.out_bias for i in range(0, len(x), batch)]
        return np.concatenate(parts) / self.temperature if parts else np.zeros((0, len(self.out_bias)), np.float32)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.01, decay: float = 1e-4,
            seed: int = 11, least_steps: int = 400) -> ConvNet:
        """Adam on the mean cross entropy; the order of rows follows ``seed`` alone.  A small sample is gone through more
        often, for at least ``least_steps`` steps."""
        rng = np.random.default_rng(seed)
        epochs = max(epochs, -(-least_steps // max(1, -(-len(x) // batch))))
        weights = [*self.tables, *self.biases, self.out, self.out_bias]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        total_steps = max(1, epochs * -(-len(x) // batch))
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                rows = order[i:i + batch]
                xs, ys = x[rows], y[rows]
                best, at = self._responses(xs, True)
                pooled = self._pooled(best)
                p = _softmax(pooled @ self.out + self.out_bias)
                p[np.arange(len(ys)), ys] -= 1
                p /= len(ys)
                back = (p @ self.out.T) * (pooled > 0)
                grads, n = [], 0
                bias_grads = []
                for w, t, place in zip(self.widths, self.tables, at, strict=True):
                    g = back[:, n:n + t.shape[2]]
                    n += t.shape[2]
                    grad = np.zeros_like(t)
                    columns = np.broadcast_to(np.arange(t.shape[2]), g.shape)
                    for j in range(w):
                        np.add.at(grad[j], (np.take_along_axis(xs, place + j, 1), columns), g)
                    grads.append(grad)
                    bias_grads.append(g.sum(0))
                grads += [*bias_grads, pooled.T @ p, p.sum(0)]
                step += 1
                pace = rate * (1 - 0.9 * step / total_steps)
                for w, g, a, b in zip(weights, grads, first, second, strict=True):
                    g = g + decay * w
                    a *= 0.9
                    a += 0.1 * g
                    b *= 0.999
                    b += 0.001 * g * g
                    w -= (pace * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        self._pairs = None
        return self

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> ConvNet:
        """The temperature with the smallest cross entropy on held-out windows."""
        if len(x):
            self.temperature = 1.0
            logits = self.scores(x)
            self.temperature = float(min(np.geomspace(0.25, 8, 31), key=lambda t: -np.log(
                _softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean()))
        return self


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


softmax = _softmax


def windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """``length`` symbols from each start; what lies beyond its end is padding."""
    at = starts[:, None] + np.arange(length)
    inside = at < ends[:, None]
    return np.where(inside, data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else 0, 0).astype(np.uint8)
