"""Feed-forward networks whose rounds run on blocks of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import RDD
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.learn import blocks

# Steps kept for the shape of the loss, as in Spark ML.
MEMORY = 10
# Numbers within a pass; its sums are doubles.
KIND = np.float32
# Trial steps along one direction.
TRIALS = 20


def _layers(weights: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Matrix (inputs by outputs) and offset of every layer, in the order in which Spark ML stores them."""
    found, at = [], 0
    for n, m in zip(sizes, sizes[1:]):
        found.append((weights[at:at + n * m].reshape(n, m), weights[at + n * m:at + n * m + m]))
        at += n * m + m
    return found


def gradient(x: np.ndarray, y: np.ndarray, weights: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """Number of rows, sum of their cross entropies and its derivative by the weights: sigmoid layers, softmax on top."""
    layers, values = _layers(weights, sizes), [x]
    with np.errstate(over="ignore"):  # what is too large for a number has a sigmoid of 0
        for w, offset in layers[:-1]:
            z = values[-1] @ -w
            z -= offset
            np.exp(z, out=z)
            z += 1
            values.append(np.reciprocal(z, out=z))
    w, offset = layers[-1]
    z = values[-1] @ w
    z += offset
    z -= z.max(axis=1, keepdims=True)
    at = (np.arange(len(y)), y.astype(np.int64))
    hit = z[at]
    delta = np.exp(z, out=z)
    total = delta.sum(axis=1)
    loss = float((np.log(total) - hit).sum())
    delta /= total[:, None]
    delta[at] -= 1
    out, ones = [], np.ones(len(y), x.dtype)
    for i in range(len(layers) - 1, -1, -1):
        out += [ones @ delta, (values[i].T @ delta).ravel()]
        if i:
            v = values[i]
            delta = delta @ layers[i][0].T
            delta *= v
            delta *= np.subtract(1, v, out=v)
    return np.concatenate([[len(y), loss], *reversed(out)], dtype=np.float64)


def descend(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], weights: np.ndarray, rounds: int, tolerance: float) -> np.ndarray:
    """L-BFGS with steps that meet the weak Wolfe conditions; ends early as no step, or none above ``tolerance``, is left."""
    value, slope = loss(weights)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        way, used = -slope, []
        for s, g in reversed(past):
            a = s @ way / (s @ g)
            way = way - a * g
            used.append(a)
        if past:
            s, g = past[-1]
            way = way * (s @ g) / (g @ g)
        for (s, g), a in zip(past, reversed(used)):
            way = way + (a - g @ way / (s @ g)) * s
        down = way @ slope
        if not down < 0:
            break
        step, low, high = (1.0 if past else min(1.0, 1 / float(np.linalg.norm(slope)))), 0.0, np.inf
        for _ in range(TRIALS):
            tried = weights + step * way
            now, turned = loss(tried)
            if not now <= value + 1e-4 * step * down:
                high = step
            elif turned @ way < 0.9 * down:
                low = step
            else:
                break
            step = (low + high) / 2 if high < np.inf else 2 * low
        if not now < value:
            break
        change, bent = tried - weights, turned - slope
        if change @ bent > 1e-12 * (bent @ bent):
            past = [*past, (change, bent)][-MEMORY:]
        small = value - now <= tolerance * max(abs(value), abs(now))
        weights, value, slope = tried, now, turned
        if small:
            break
    return weights


class BlockNet(MultilayerPerceptronClassifier):
    """Spark ML's network, first weights and model, whose rounds are passes over blocks of rows with matrix products in numpy."""

    def _model(self, dataset: DataFrame, weights: np.ndarray | None = None) -> MultilayerPerceptronClassificationModel:
        """Spark ML's model after no round: with its first weights, or with those given."""
        one = dataset.sparkSession.createDataFrame([(Vectors.dense([0.0] * self.getLayers()[0]), 0.0)], [self.getFeaturesCol(), self.getLabelCol()])
        bare = MultilayerPerceptronClassifier(layers=self.getLayers(), maxIter=0, seed=self.getSeed(), featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol())
        return (bare if weights is None else bare.setInitialWeights(Vectors.dense(weights))).fit(one)

    def _blocks(self, dataset: DataFrame) -> tuple[RDD, RDD]:
        return blocks.as_blocks(dataset, F.col(self.getFeaturesCol()), F.col(self.getLabelCol()), KIND)

    def _fit_blocks(self, dataset: DataFrame, rows: RDD) -> MultilayerPerceptronClassificationModel:
        sizes = self.getLayers()

        def loss(weights: np.ndarray) -> tuple[float, np.ndarray]:
            given = weights.astype(KIND)
            found = blocks.summed(rows, lambda x, y: gradient(x, y, given, sizes))
            if found is None:
                raise ValueError("no training rows")
            return found[1] / found[0], found[2:] / found[0]

        first = self.getInitialWeights() if self.isDefined("initialWeights") else self._model(dataset).weights
        return self._model(dataset, descend(loss, np.asarray(first.toArray()), self.getMaxIter(), self.getTol()))

    def _fit(self, dataset: DataFrame) -> MultilayerPerceptronClassificationModel:
        stored, rows = self._blocks(dataset)
        try:
            return self._fit_blocks(dataset, rows)
        finally:
            stored.unpersist()

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[Mapping]) -> Iterator[tuple[int, MultilayerPerceptronClassificationModel]]:
        """All settings at a time, on the same stored blocks unless they read other columns."""
        own = [self.copy(p) for p in paramMaps]
        if len({(n.getFeaturesCol(), n.getLabelCol()) for n in own}) != 1:
            return super().fitMultiple(dataset, paramMaps)
        stored, rows = own[0]._blocks(dataset)
        try:
            with ThreadPoolExecutor(len(own)) as pool:
                return iter(enumerate(list(pool.map(lambda n: n._fit_blocks(dataset, rows), own))))
        finally:
            stored.unpersist()
