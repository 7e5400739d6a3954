"""Exact nearest places on a plane: leaves of a k-d tree of medians, reached by radius and compared in blocks.

The tree is drawn from a sample of both sides, so its leaves hold about as many rows each, in dense centres and far away.
A place finds how far its ``k``-th row is at most in its own leaf, goes to the leaves that this radius reaches, and is
compared there with blocks of bounded size in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.operators.metric import BLOCK
from wayfold.session import cut_lineage

#: Rows a leaf is meant to hold, most levels of the tree, sampled rows a leaf.
LEAF, LEVELS, DRAWN = 512, 14, 16


class Leaves:
    """A tree of splits; of each node the box of its rows, their weight, and of leaves the number of blocks."""

    def __init__(self, sample: np.ndarray, want: int) -> None:
        self.depth = min(LEVELS, max(0, want - 1).bit_length())
        size = 2 ** (self.depth + 1) - 1
        self.axis, self.at = np.full(size, -1), np.zeros(size)
        todo = [(0, sample)]
        for node, own in todo:
            if 2 * node + 2 >= size or len(own) < 2:
                continue
            axis = int(np.ptp(own, axis=0).argmax())
            at = float(np.partition(own[:, axis], (len(own) - 1) // 2)[(len(own) - 1) // 2])
            above = own[:, axis] > at
            if above.any():
                self.axis[node], self.at[node] = axis, at
                todo += [(2 * node + 1, own[~above]), (2 * node + 2, own[above])]
        self.low, self.high = np.full((size, 2), np.inf), np.full((size, 2), -np.inf)
        self.weight, self.blocks = np.zeros(size), np.zeros(size, np.int64)

    def place(self, p: np.ndarray) -> np.ndarray:
        node = np.zeros(len(p), np.int64)
        for _ in range(self.depth):
            axis = self.axis[node]
            down = 2 * node + 1 + (p[np.arange(len(p)), np.maximum(axis, 0)] > self.at[node])
            node = np.where(axis >= 0, down, node)
        return node

    def sum_up(self) -> None:
        """Boxes and weights of the inner nodes from those of the leaves."""
        for node in range(len(self.axis) - 1, -1, -1):
            if self.axis[node] >= 0:
                a, b = 2 * node + 1, 2 * node + 2
                self.low[node], self.high[node] = np.minimum(self.low[a], self.low[b]), np.maximum(self.high[a], self.high[b])
                self.weight[node] = self.weight[a] + self.weight[b]

    def radius(self, p: np.ndarray, k: int) -> np.ndarray:
        """A distance within which rows of weight ``k`` lie, infinite where there are too few."""
        heavy = np.flatnonzero(self.weight >= k)
        inner = heavy[self.axis[heavy] >= 0]
        # the smallest nodes that hold enough
        split = inner[(self.weight[2 * inner + 1] >= k) | (self.weight[2 * inner + 2] >= k)]
        least = np.setdiff1d(heavy, split)
        out, own = np.full(len(p), np.inf), self.place(p)
        rich = self.weight[own] >= k
        gap = np.maximum(np.abs(p - self.low[own]), np.abs(p - self.high[own]))[rich]
        out[rich] = np.hypot(gap[:, 0], gap[:, 1])
        poor = np.flatnonzero(~rich)
        for start in range(0, len(poor) if len(least) else 0, 512):
            some = poor[start:start + 512]
            gap = np.maximum(np.abs(p[some, None] - self.low[least]), np.abs(p[some, None] - self.high[least]))
            out[some] = np.hypot(gap[..., 0], gap[..., 1]).min(1)
        return out * (1 + 1e-9) + 2e-9

    def reached(self, p: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the places and the leaves with rows whose box is within the radius."""
        at, node = np.arange(len(p)), np.zeros(len(p), np.int64)
        rows, leaves = [], []
        while len(at):
            gap = np.maximum(np.maximum(self.low[node] - p[at], p[at] - self.high[node]), 0)
            near = (self.weight[node] > 0) & (np.hypot(gap[:, 0], gap[:, 1]) <= radius[at])
            at, node = at[near], node[near]
            leaf = self.axis[node] < 0
            rows.append(at[leaf])
            leaves.append(node[leaf])
            at, node = np.tile(at[~leaf], 2), np.concatenate([2 * node[~leaf] + 1, 2 * node[~leaf] + 2])
        return np.concatenate(rows), np.concatenate(leaves)


def _points(rows: pa.Table | pa.RecordBatch, x: str, y: str) -> np.ndarray:
    return np.column_stack([rows[x].to_numpy(zero_copy_only=False), rows[y].to_numpy(zero_copy_only=False)])


def _sample(rows: DataFrame, x: str, y: str, count: int, most: int) -> np.ndarray:
    drawn = F.pmod(F.xxhash64(x, y), F.lit(-(-count // most) or 1)) == 0
    return _points(rows.where(drawn).select(x, y).limit(2 * most).toArrow().sort_by([(x, "ascending"), (y, "ascending")]), x, y)


def _deal(places: DataFrame, spots: DataFrame) -> tuple[DataFrame, Leaves]:
    """The spots with their leaf ``cell`` and ``block``, and the leaves."""
    counts = [places.count(), spots.count()]
    want = min(2**LEVELS, -(-max(counts) // LEAF))
    drawn = [_sample(rows, x, y, n, want * DRAWN) for rows, x, y, n in ((places, "_x", "_y", counts[0]), (spots, "_sx", "_sy", counts[1]))]
    leaves = Leaves(np.concatenate(drawn), want)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = pa.array(leaves.place(_points(batch, "_sx", "_sy")).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, cell], [*batch.schema.names, "cell"])

    placed = cut_lineage(spots.select("_sx", "_sy", "_n").mapInArrow(place, "_sx double, _sy double, _n long, cell int"))
    ends = [f(c).alias(f"{n}{c}") for c in ("_sx", "_sy") for n, f in (("low", F.min), ("high", F.max))]
    for r in placed.groupBy("cell").agg(*ends, F.sum("_n").alias("n"), F.count("*").alias("rows")).collect():
        c = r["cell"]
        leaves.low[c], leaves.high[c] = (r["low_sx"], r["low_sy"]), (r["high_sx"], r["high_sy"])
        leaves.weight[c], leaves.blocks[c] = r["n"], -(-r["rows"] // BLOCK)
    leaves.sum_up()
    many = {c: int(leaves.blocks[c]) for c in np.flatnonzero(leaves.blocks > 1).tolist()}
    return placed.withColumn("block", F.pmod(F.xxhash64("_sx", "_sy"), _blocks(many)).cast("int")), leaves


def _blocks(many: dict[int, int]) -> Column:
    if not many:
        return F.lit(1)
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for e in many.items() for v in e]), "cell"), F.lit(1))


def nearest_places(places: DataFrame, spots: DataFrame, k: int) -> DataFrame:
    """``(_x, _y, _sx, _sy, _n)``: for every place ``(_x, _y)`` the spots ``(_sx, _sy, _n)`` among which its ``k`` nearest rows are.

    All spots as far away as the last row are there, and some that are a little farther; with fewer rows than ``k`` all.
    """
    places, spots = cut_lineage(places.select("_x", "_y")), cut_lineage(spots.select("_sx", "_sy", F.col("_n").cast("long").alias("_n")))
    placed, leaves = _deal(places, spots)

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _points(batch, "_x", "_y")
            columns = [*batch.columns, pa.array(leaves.radius(p, k)), pa.array(leaves.place(p).astype(np.int32)), pa.array(np.zeros(len(p), np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["_x", "_y", "_r", "cell", "block"])

    def bound(left: pa.Table, right: pa.Table) -> pa.Table:
        radius = right["_r"].to_numpy().copy()
        if left.num_rows:
            n = left["_n"].to_numpy()
            for start, far in _distances(left, right):
                order = np.argsort(far, axis=1)
                enough = np.cumsum(n[order], axis=1) >= k
                at = order[np.arange(len(far)), enough.argmax(1)]
                found = np.where(enough.any(1), far[np.arange(len(far)), at] * (1 + 1e-9) + 2e-9, np.inf)
                radius[start:start + len(far)] = np.minimum(radius[start:start + len(far)], found)
        return pa.table([right["_x"], right["_y"], pa.array(radius)], ["_x", "_y", "_r"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                rows, cell = leaves.reached(_points(part, "_x", "_y"), part["_r"].to_numpy())
                times = leaves.blocks[cell]
                block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                sent = part.take(pa.array(np.repeat(rows, times)))
                yield pa.RecordBatch.from_arrays([*sent.columns, pa.array(np.repeat(cell, times).astype(np.int32)), pa.array(block.astype(np.int32))],
                                                 ["_x", "_y", "_r", "cell", "block"])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table([np.zeros(0)] * 4 + [np.zeros(0, np.int64)], ["_x", "_y", "_sx", "_sy", "_n"])
        own, other = [], []
        for start, far in _distances(left, right):
            a, b = np.nonzero(far <= right["_r"].to_numpy()[start:start + len(far), None])
            own.append(a + start)
            other.append(b)
        a, b = right.take(pa.array(np.concatenate(own))), left.take(pa.array(np.concatenate(other)))
        return pa.table([a["_x"], a["_y"], b["_sx"], b["_sy"], b["_n"]], ["_x", "_y", "_sx", "_sy", "_n"])

    sent = "_x double, _y double, _r double, cell int, block int"
    homes = places.mapInArrow(home, sent).groupBy("cell", "block")
    blocks = placed.groupBy("cell", "block")
    bounded = cut_lineage(blocks.cogroup(homes).applyInArrow(bound, "_x double, _y double, _r double"))
    return blocks.cogroup(bounded.mapInArrow(send, sent).groupBy("cell", "block")).applyInArrow(
        compare, "_x double, _y double, _sx double, _sy double, _n long")


def _distances(left: pa.Table, right: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Some places of ``right`` at a time: the number of the first and their distances to the spots of ``left``."""
    spots, places = _points(left, "_sx", "_sy"), _points(right, "_x", "_y")
    for start in range(0, len(places), 512):
        gap = places[start:start + 512, None] - spots[None]
        yield start, np.sqrt(gap[..., 0] * gap[..., 0] + gap[..., 1] * gap[..., 1])
