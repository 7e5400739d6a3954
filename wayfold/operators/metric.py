"""Exact nearest rows in many dimensions: cells around pivots, left out by the triangle inequality, compared in blocks.

Rows are ``(id, x, n)``: a vector of doubles and how many times it counts.  Every row belongs to the cell of its nearest
pivot; a cell knows the range of its rows' distances to the pivot.  A query at distance ``d`` from the pivot is at least
``max(d - high, low - d)`` from all of them, so it is sent only to cells that its radius reaches, and compared there with
blocks of bounded size in numpy.  No pair of rows is written or shuffled: a block returns each query's best rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.session import cut_lineage

#: Rows a cell is meant to hold, rows compared at a time, most cells, rows that the pivots are drawn from.
CELL, BLOCK, CELLS, SAMPLE = 512, 4096, 1024, 4096
#: With more cells than the first, a cell holds up to the second number of rows: every query travels once a cell it reaches.
SPREAD, FULL = 48, 4096
DIGITS = 9


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def squares(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances, added up from the first dimension to the last as SQL would.

    Sums of small whole numbers are exact in any order, so these are one matrix product.
    """
    if whole(q) and whole(c):
        return rough_squares(q, c)
    total = np.zeros((len(q), len(c)))
    for a, b in zip(q.T, c.T, strict=True):
        part = a[:, None] - b[None]
        total += part * part
    return total


def whole(x: np.ndarray) -> bool:
    return bool(x.size and (np.abs(x) < 1 << 20).all() and (x == np.rint(x)).all()) and x.shape[1] < 1 << 10


def rough_squares(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances by one matrix product; see :func:`rough_error`."""
    out = q @ c.T
    out *= -2
    out += np.einsum("ij,ij->i", q, q)[:, None]
    out += np.einsum("ij,ij->i", c, c)[None]
    return np.maximum(out, 0, out=out)


def rough_error(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """How far each row of :func:`rough_squares` is off at most, many times over."""
    most = np.einsum("ij,ij->i", c, c).max(initial=0.0)
    return 1e-14 * (q.shape[1] + 8) * (np.einsum("ij,ij->i", q, q) + most)


def spread_points(sample: np.ndarray, want: int) -> np.ndarray:
    """Up to ``want`` different rows of a sample, each next one farthest from those taken."""
    taken, far = [0], squares(sample, sample[:1])[:, 0]
    while len(taken) < want and far.max() > 0:
        at = int(far.argmax())
        taken.append(at)
        far = np.minimum(far, squares(sample, sample[at:at + 1])[:, 0])
    return sample[taken]


@dataclass
class Cells:
    """Pivots, and of each cell the distance range, the rows' count and weight, and its number of blocks."""

    points: np.ndarray
    low: np.ndarray = field(init=False)
    high: np.ndarray = field(init=False)
    weight: np.ndarray = field(init=False)
    blocks: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        n = len(self.points)
        self.low, self.high = np.full(n, np.inf), np.full(n, -np.inf)
        self.weight, self.blocks = np.zeros(n), np.zeros(n, np.int64)

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(squares(x, self.points))

    def least(self, d: np.ndarray) -> np.ndarray:
        """Below what distance no row of a cell lies, given distances to the pivots; rounding is allowed for."""
        return np.maximum(np.maximum(d - self.high, self.low - d), 0) * (1 - 1e-9) - 1e-9

    def radius(self, d: np.ndarray, weight: float) -> np.ndarray:
        """A distance within which rows of at least ``weight`` lie, infinite where there are too few."""
        far = np.where(self.blocks > 0, d + self.high, np.inf)
        order = np.argsort(far, axis=1)
        enough = np.cumsum(self.weight[order], axis=1) >= weight
        first = np.where(enough.any(1), enough.argmax(1), len(self.points) - 1)
        rows = np.arange(len(d))
        return np.where(enough.any(1), far[rows, order[rows, first]] * (1 + 1e-9) + 1e-9, np.inf)


def deal(rows: DataFrame) -> tuple[DataFrame, Cells]:
    """The rows ``(id, x, n, ...)`` with their ``cell`` and ``block``, and the cells."""
    count = rows.count()
    want = min(CELLS, -(-count // CELL), max(SPREAD, -(-count // FULL)))
    drawn = F.pmod(F.xxhash64("id"), F.lit(-(-count // SAMPLE) or 1)) == 0
    sample = rows.where(drawn).select("id", "x").limit(2 * SAMPLE).toArrow().sort_by("id")
    if not sample.num_rows:
        sample = rows.select("id", "x").limit(1).toArrow()
    cells = Cells(spread_points(matrix(sample["x"]), want) if count else np.zeros((0, 1)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = cells.distances(matrix(batch["x"]))
                near = d.argmin(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])],
                                                 [*batch.schema.names, "cell", "d"])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = cut_lineage(rows.mapInArrow(place, f"{names}, cell int, d double"))
    for r in placed.groupBy("cell").agg(F.min("d").alias("low"), F.max("d").alias("high"), F.sum("n").alias("n"), F.count("*").alias("rows")).collect():
        c = r["cell"]
        cells.low[c], cells.high[c], cells.weight[c], cells.blocks[c] = r["low"], r["high"], r["n"], -(-r["rows"] // BLOCK)
    blocks = F.element_at(F.array(*[F.lit(int(b) or 1) for b in cells.blocks]), F.col("cell") + 1) if count else F.lit(1)
    return placed.drop("d").withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")), cells


def search(queries: DataFrame, placed: DataFrame, cells: Cells, radius: Callable[[pa.Table, np.ndarray], np.ndarray],
           compare: Callable[[pa.Table, pa.Table], pa.Table], out: str) -> DataFrame:
    """What ``compare`` makes of every block and the queries that reach its cell.

    ``radius`` gives each query's radius from its columns and its distances to the pivots.
    """
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in queries.schema.fields)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = cells.distances(matrix(batch["x"]))
            reached = (cells.least(d) <= radius(pa.Table.from_batches([batch]), d)[:, None]) & (cells.blocks > 0)[None]
            for cell in np.flatnonzero(reached.any(0)).tolist():
                part = batch.filter(pa.array(reached[:, cell]))
                for block in range(int(cells.blocks[cell])):
                    where = [pa.array(np.full(part.num_rows, v, np.int32)) for v in (cell, block)]
                    yield pa.RecordBatch.from_arrays([*part.columns, *where], [*part.schema.names, "cell", "block"])

    def unit(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return compare(left.slice(0, 0), right.slice(0, 0))
        left = left.sort_by("id")
        parts = [compare(left, right.slice(at, 256)) for at in range(0, right.num_rows, 256)]
        return pa.concat_tables(parts)

    sent = queries.mapInArrow(send, f"{names}, cell int, block int")
    return placed.groupBy("cell", "block").cogroup(sent.groupBy("cell", "block")).applyInArrow(unit, out)


def last_distances(queries: DataFrame, placed: DataFrame, cells: Cells, weight: int) -> DataFrame:
    """``(query, last, n)``: the distance within which rows of a total count of ``weight`` lie, or all, and their count.

    A block gives a query the counts at its own nearest distances, not the rows.
    """
    schema = pa.schema([("query", pa.int64()), ("dist", pa.float64()), ("n", pa.int64())])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        n, q = left["n"].to_numpy(), right["id"].to_numpy()
        far = squares(matrix(right["x"]), matrix(left["x"]))
        # every row counts at least once, so no more rows than these are needed
        most = np.partition(far, min(weight, len(n)) - 1, axis=1)[:, min(weight, len(n)) - 1]
        row, col = np.nonzero(far <= (most * (1 + 1e-8) + 1e-18)[:, None])
        dist = np.round(np.sqrt(far[row, col]), DIGITS)
        order = np.lexsort((dist, row))
        row, dist, count = row[order], dist[order], n[col[order]]
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (dist[1:] != dist[:-1])])
        count, row, dist = np.add.reduceat(count, first), row[first], dist[first]
        # the counts nearer than a distance already suffice: it is not needed
        before = np.cumsum(count) - count
        start = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        needed = before - np.repeat(before[start], np.diff(np.r_[start, len(row)])) < weight
        return pa.table([q[row[needed]], dist[needed], count[needed]], schema=schema)

    found = search(queries.select("id", "x"), placed, cells, lambda _, d: cells.radius(d, weight), compare, "query long, dist double, n long")
    steps = found.groupBy("query", "dist").agg(F.sum("n").alias("n")).groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct("dist", "n"))).alias("steps"))
    last = F.aggregate("steps", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1.0).alias("dist")), lambda a, s: F.when(a["n"] >= weight, a).otherwise(
        F.struct((a["n"] + s["n"]).alias("n"), s["dist"].alias("dist"))))
    return steps.select("query", last.alias("_last")).select("query", F.col("_last.dist").alias("last"), F.col("_last.n").alias("n"))


def nearest_weight(queries: DataFrame, rows: DataFrame, weight: int) -> DataFrame:
    """``(query, id, dist, n)``: of each query ``(id, x)`` the nearest rows ``(id, x, n)`` up to a total count of ``weight``.

    Distances are rounded to nine digits; all rows as far away as the last one needed are there.  A query that is itself a
    row finds itself.  With fewer rows than asked for, all are there.  The last distance is found first, so that no block
    returns rows beyond it.
    """
    placed, cells = deal(rows)
    schema = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("dist", pa.float64()), ("n", pa.int64())])
    last = last_distances(queries, placed, cells, weight).select(F.col("query").alias("id"), "last")
    asking = cut_lineage(queries.select("id", "x").join(last, "id"))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        most = right["last"].to_numpy()
        far = squares(matrix(right["x"]), matrix(left["x"]))
        row, col = np.nonzero(far <= ((most + 1e-9) ** 2 * (1 + 1e-8))[:, None])
        dist = np.round(np.sqrt(far[row, col]), DIGITS)
        near = dist <= most[row]
        row, col, dist = row[near], col[near], dist[near]
        return pa.table([right["id"].to_numpy()[row], left["id"].to_numpy()[col], dist, left["n"].to_numpy()[col]], schema=schema)

    return search(asking, placed, cells, lambda t, _: t["last"].to_numpy() * (1 + 1e-9) + 2e-9, compare, "query long, id long, dist double, n long")
