"""Boosted trees, one ensemble per class against the rest, all grown in the same passes over blocks of binned rows.

A level of the trees of all classes is one pass that sums the residuals per class, node, feature and bin; the driver picks
the splits from these sums.  Loss, leaves, rates and early stop are those of Spark ML's GBTClassifier.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.learn import blocks

# Quantiles are taken to this share of the rows.
ERROR = 0.001


class Tree:
    """Nodes as in a heap: children of ``i`` are ``2 i + 1`` and ``2 i + 2``; a leaf has feature -1."""

    def __init__(self, depth: int, value: float = 0.0) -> None:
        n = 2 ** (depth + 1) - 1
        self.depth, self.feature, self.at, self.value = depth, np.full(n, -1), np.zeros(n), np.full(n, value)

    def place(self, x: np.ndarray) -> np.ndarray:
        """Node that every row ends in."""
        node, each = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            feature = self.feature[node]
            node = np.where(feature < 0, node, 2 * node + 1 + (x[each, feature] > self.at[node]))
        return node


def margins(x: np.ndarray, ensembles: Sequence[Sequence[tuple[float, Tree]]]) -> np.ndarray:
    out = np.zeros((len(x), len(ensembles)))
    for c, trees in enumerate(ensembles):
        for rate, tree in trees:
            out[:, c] += rate * tree.value[tree.place(x)]
    return out


class BoostedModel(Model, HasFeaturesCol, HasPredictionCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Margins of every class as ``rawPrediction`` and the class of the largest one."""

    trees = Param(Params._dummy(), "trees", "per class, pairs of rate and tree, as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", predictionCol: str = "prediction", rawPredictionCol: str = "rawPrediction", trees: str = "[]"):
        super().__init__()
        self._set(**self._input_kwargs)

    @staticmethod
    def dumped(ensembles: Sequence[Sequence[tuple[float, Tree]]]) -> str:
        return json.dumps([[[rate, t.depth, t.feature.tolist(), t.at.tolist(), t.value.tolist()] for rate, t in trees] for trees in ensembles])

    def ensembles(self) -> list[list[tuple[float, Tree]]]:
        def read(rate, depth, feature, at, value):
            tree = Tree(depth)
            tree.feature, tree.at, tree.value = np.array(feature), np.array(at), np.array(value)
            return rate, tree
        return [[read(*t) for t in trees] for trees in json.loads(self.getOrDefault(self.trees))]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ensembles = self.ensembles()

        @F.pandas_udf("array<double>")
        def raw(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in parts:
                yield pd.Series(list(margins(np.stack(x.to_list()), ensembles)) if len(x) else [], dtype=object)
        found = dataset.withColumn("_raw", raw(vector_to_array(self.getFeaturesCol())))
        best = F.array_position("_raw", F.array_max("_raw")).cast("double") - 1
        return found.withColumn(self.getRawPredictionCol(), array_to_vector("_raw")).withColumn(self.getPredictionCol(), best).drop("_raw")


def _distinct(stored: RDD, most: int) -> list[np.ndarray | None]:
    """The values of every feature, None where there are more than ``most``."""
    def some(values: np.ndarray) -> np.ndarray | None:
        found = np.unique(values)
        return found if len(found) <= most else None

    def merged(a, b):
        return [None if v is None or w is None else some(np.concatenate([v, w])) for v, w in zip(a, b)]

    def part(rows):
        total = None
        for x, _ in rows:
            own = [some(x[:, i]) for i in range(x.shape[1])]
            total = own if total is None else merged(total, own)
        if total is not None:
            yield total
    return stored.mapPartitions(part).treeReduce(merged)


def _borders(rows: DataFrame, features: str, values: Sequence[np.ndarray | None], most: int) -> list[np.ndarray]:
    """Per feature the numbers to split at: between all values of a feature of few, else quantiles."""
    many = [i for i, v in enumerate(values) if v is None]
    found: dict[int, np.ndarray] = {}
    if many:
        x = rows.select(vector_to_array(features).alias("x")).select(*[F.col("x")[i].alias(f"x{i}") for i in many])
        cuts = x.approxQuantile([f"x{i}" for i in many], [k / most for k in range(1, most)], ERROR)
        found = {i: np.unique(c) for i, c in zip(many, cuts)}
    return [found[i] if v is None else (v[1:] + v[:-1]) / 2 for i, v in enumerate(values)]


def _targets(y: np.ndarray, c: int, margin: np.ndarray | None) -> np.ndarray:
    """What the next tree of a class is fitted to: its labels, 1 or -1, then what the margin leaves of them."""
    sign = np.where(y == c, 1.0, -1.0)
    return sign if margin is None else 4 * sign / (1 + np.exp(np.minimum(2 * sign * margin, 700)))


def _grow(rows: RDD, classes: Sequence[int], width: int, bins: int, depth: int, leaf: int, gain: float, first: bool) -> dict[int, Tree]:
    """A tree for each of the classes, level by level; ``rows`` are pairs of bins and (label, held out, margins) columns."""
    trees = {c: Tree(depth) for c in classes}
    offsets = np.arange(width) * bins
    for level in range(depth):
        start, nodes = 2**level - 1, 2**level

        def sums(x: np.ndarray, state: np.ndarray) -> np.ndarray:
            own = state[:, 1] == 0
            x, state = x[own], state[own]
            out = np.zeros((len(classes), 2, nodes * width * bins))
            for k, c in enumerate(classes):
                node = trees[c].place(x) - start
                open_ = node >= 0
                cell = ((x[open_] + offsets) + (node[open_] * (width * bins))[:, None]).ravel()
                target = _targets(state[open_, 0], c, None if first else state[open_, 2 + c])
                out[k, 0] = np.bincount(cell, minlength=out.shape[2])
                out[k, 1] = np.bincount(cell, np.repeat(target, width), minlength=out.shape[2])
            return out
        found = blocks.summed(rows, sums).reshape(len(classes), 2, nodes, width, bins)
        for k, c in enumerate(classes):
            tree, split = trees[c], False
            for node in range(nodes):
                n, s = found[k, 0, node], found[k, 1, node]
                total, whole = n[0].sum(), s[0].sum()
                if not total:
                    continue
                if not level:
                    tree.value[0] = whole / total
                n_left, s_left = n.cumsum(axis=1)[:, :-1], s.cumsum(axis=1)[:, :-1]
                n_right, s_right = total - n_left, whole - s_left
                fits = (n_left >= max(leaf, 1)) & (n_right >= max(leaf, 1))
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(fits, (s_left**2 / n_left + s_right**2 / n_right - whole**2 / total) / total, -np.inf)
                best = np.unravel_index(gains.argmax(), gains.shape)
                if gains[best] > 1e-12 and gains[best] >= gain:
                    at = start + node
                    tree.feature[at], tree.at[at] = best
                    tree.value[2 * at + 1], tree.value[2 * at + 2] = s_left[best] / n_left[best], s_right[best] / n_right[best]
                    split = True
            if not split:
                tree.depth = min(tree.depth, level)
        if all(t.depth <= level for t in trees.values()):
            break
    return trees


def fit_boosted(rows: DataFrame, features: str, label: str, held: str, rounds: int, depth: int, rate: float, leaf: int, gain: float, bins: int,
                tolerance: float) -> list[list[tuple[float, Tree]]]:
    """Trees per class 0 to the largest label; with rows ``held`` out, and others, a class stops as Spark ML's boosting does."""
    stored, _ = blocks.as_blocks(rows, F.col(features), 2 * F.col(label) + F.col(held).cast("int"))
    kept = [stored]
    try:
        mixed = stored.map(lambda b: (b[1].max(), (b[1] % 2 == 0).any(), (b[1] % 2 == 1).any())).collect() if not stored.isEmpty() else []
        if not mixed:
            raise ValueError("no training rows")
        size = int(max(m[0] for m in mixed)) // 2 + 1
        inside, outside = any(m[1] for m in mixed), any(m[2] for m in mixed)
        borders = _borders(rows, features, _distinct(stored, bins), bins)
        width = len(borders)

        def binned(b):
            x, y = b
            cells = np.stack([np.searchsorted(t, x[:, i]) for i, t in enumerate(borders)], axis=1).astype(np.int16)
            # where either side is empty, nothing is held out
            state = np.zeros((len(y), 2 + size))
            state[:, 0], state[:, 1] = y // 2, (y % 2) * (inside and outside)
            return cells, state
        now = stored.map(binned).persist(StorageLevel.MEMORY_AND_DISK)
        now.count()
        kept.append(now)
        stored.unpersist()
        ensembles: list[list[tuple[float, Tree]]] = [[] for _ in range(size)]
        best, ends, going = {}, {c: rounds for c in range(size)}, list(range(size))
        for r in range(rounds):
            grown = _grow(now, going, width, bins, depth, leaf, gain, r == 0)
            weight = rate if r else 1.0
            for c, tree in grown.items():
                ensembles[c].append((weight, tree))

            def moved(b, grown=grown, weight=weight):
                x, state = b
                state = state.copy()
                for c, tree in grown.items():
                    state[:, 2 + c] += weight * tree.value[tree.place(x)]
                return x, state
            now = now.map(moved).persist(StorageLevel.MEMORY_AND_DISK)
            kept.append(now)

            def loss(x: np.ndarray, state: np.ndarray) -> np.ndarray:
                out = state[state[:, 1] == 1]
                sign = np.where(out[:, :1] == np.arange(size), 1.0, -1.0)
                return np.concatenate([[len(out)], 2 * np.logaddexp(0, -2 * sign * out[:, 2:]).sum(axis=0)])
            found = blocks.summed(now, loss)
            kept[-2].unpersist()
            if found[0]:
                for c in list(going):
                    error = found[1 + c] / found[0]
                    if r and best[c] - error < tolerance * max(error, 0.01):
                        going.remove(c)
                    else:
                        best[c], ends[c] = error, r + 1
            if not going:
                break
    finally:
        for rdd in kept:
            rdd.unpersist()
    out = [trees[:ends[c]] for c, trees in enumerate(ensembles)]
    for _, tree in (t for trees in out for t in trees):
        tree.at = np.array([borders[f][int(b)] if f >= 0 else 0.0 for f, b in zip(tree.feature, tree.at)])
    return out
