"""A multiway hyperplane tree over vectors: split points, and ranges of their distances to every sibling's subtree."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Relative error allowed for distances in floating point.
SLACK = 1e-9


def lifted(u: np.ndarray, square: float) -> np.ndarray:
    """Vectors with one more component that brings each to the squared length ``square``.

    For a query whose further component is 0, the squared distance to such a vector is its own squared length plus
    ``square`` less twice the inner product: order by score is order by distance, and distances obey the triangle.
    """
    return np.concatenate([u, np.sqrt(np.maximum(square - np.einsum("ij,ij->i", u, u), 0))[:, None]], 1)


def asked(u: np.ndarray) -> np.ndarray:
    return np.concatenate([u, np.zeros((len(u), 1))], 1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


@dataclass
class Split:
    """Split points, the child of each (a node, or ``~leaf``), and for each point and child the range of their distances."""

    points: np.ndarray
    children: list[int]
    low: np.ndarray = field(init=False)
    high: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n = len(self.points)
        self.low, self.high = np.full((n, n), np.inf), np.full((n, n), -np.inf)


class Tree:
    """Built from a sample of lifted vectors; a vector goes to the child of its nearest split point."""

    def __init__(self, sample: np.ndarray, rows: int, leaf_rows: int, arity: int = 16) -> None:
        self.splits: list[Split] = []
        self.leaves = 0
        self._build(sample, rows, leaf_rows, arity)

    def _build(self, sample: np.ndarray, rows: float, leaf_rows: int, arity: int) -> int:
        want = min(arity, int(-(-rows // leaf_rows)))
        points = _spread(sample, want) if want > 1 else sample[:0]
        if len(points) < 2:
            self.leaves += 1
            return ~(self.leaves - 1)
        me = len(self.splits)
        self.splits.append(Split(points, []))
        near = distances(sample, points).argmin(1)
        for j in range(len(points)):
            part = sample[near == j]
            self.splits[me].children.append(self._build(part, rows * len(part) / len(sample), leaf_rows, arity))
        return me

    def route(self, x: np.ndarray, ranges: bool = False) -> np.ndarray:
        """The leaf of each lifted vector; with ``ranges`` each split's ranges grow to hold what passes it."""
        leaf = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))] if self.splits and len(x) else []
        while todo:
            at, rows = todo.pop()
            split = self.splits[at]
            d = distances(x[rows], split.points)
            near = d.argmin(1)
            for j, child in enumerate(split.children):
                own = near == j
                if own.any():
                    if ranges:
                        np.minimum(split.low[:, j], d[own].min(0), out=split.low[:, j])
                        np.maximum(split.high[:, j], d[own].max(0), out=split.high[:, j])
                    if child < 0:
                        leaf[rows[own]] = ~child
                    else:
                        todo.append((child, rows[own]))
        return leaf

    def meeting(self, q: np.ndarray, inner: np.ndarray, outer: np.ndarray, scale: np.ndarray) -> np.ndarray:
        """Which leaves may hold a vector in one of a query's annuli: queries x leaves.

        ``inner`` and ``outer`` are queries x annuli squared distances; ``scale`` is what their error is relative to.
        A subtree whose distances from a split point lie in [low, high] lies within [low - d, d - high] and d + high of
        a query at distance d from the point; it goes if the ranges from all split points meet no annulus.
        """
        near = np.sqrt(np.maximum(inner - SLACK * scale[:, None], 0))
        far = np.sqrt(np.maximum(outer + SLACK * scale[:, None], 0))
        open_ = outer >= inner
        hit = np.zeros((len(q), max(1, self.leaves)), bool)
        if not self.splits:
            hit[:] = open_.any(1)[:, None]
            return hit
        todo = [(0, np.flatnonzero(open_.any(1)))]
        while todo:
            at, rows = todo.pop()
            if not len(rows):
                continue
            split = self.splits[at]
            d = distances(q[rows], split.points)
            error = 1e-7 * np.sqrt(scale[rows])
            for j, child in enumerate(split.children):
                if not np.isfinite(split.low[:, j]).all():
                    continue
                least = np.maximum(split.low[:, j] - d, d - split.high[:, j]).max(1) - error
                most = (split.high[:, j] + d).min(1) + error
                own = rows[((near[rows] <= most[:, None]) & (far[rows] >= least[:, None]) & open_[rows]).any(1)]
                if child < 0:
                    hit[own, ~child] = True
                else:
                    todo.append((child, own))
        return hit


def _spread(sample: np.ndarray, want: int, candidates: int = 512) -> np.ndarray:
    """Up to ``want`` different points far from one another: each next one is farthest from those taken."""
    pool = sample[:candidates]
    if not len(pool):
        return pool
    taken, d = [0], distances(pool, pool[:1])[:, 0]
    reach = float(d.max(initial=0))
    while len(taken) < want:
        at = int(d.argmax())
        if d[at] <= 1e-6 * reach:
            break
        taken.append(at)
        d = np.minimum(d, distances(pool, pool[at:at + 1])[:, 0])
    return pool[taken]
