"""Exact positions in a sorted order without sorting everything in one place.

A global ``row_number`` would send all rows to a single task.  Instead:

* :func:`cut_points` finds the rows at given ranks with a few histogram passes, each a
  ``groupBy(bucket)`` with map-side combine; the data itself is never shuffled.
* :func:`dense_index` numbers rows in digest order through even buckets and bucket offsets.
* :func:`running_totals` sums in key order through key ranges and block offsets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfold.functions.digest import BITS
from wayfold.session import cut_lineage

BUCKETS = 4096          # histogram cells per open interval and pass
SMALL = 100_000         # an interval of at most this many rows is read value by value


def micros(column: str | Column) -> Column:
    """A zone-free timestamp as microseconds since 1970."""
    column = F.col(column) if isinstance(column, str) else column
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), column)


def _cell(low, high) -> Column:
    """Number of the histogram cell of ``v`` between two values; infinities get cells of their own.

    Halves keep the width of the interval within a double, whole numbers beyond 2^53 are counted from the low end.
    """
    v = F.col("v")
    if isinstance(low, int):
        share = (v.cast("decimal(38,0)") - F.lit(low)).cast("double") / F.lit(float(high - low))
    elif math.isinf(low) or math.isinf(high):
        return F.when(v == float("-inf"), 0).when(v == float("inf"), 2).otherwise(1)
    else:
        share = (v.cast("double") / 2 - F.lit(float(low) / 2)) / F.lit(float(high) / 2 - float(low) / 2)
    # the ends always fall apart, so every pass narrows the interval
    return F.when(v == F.lit(high), BUCKETS - 1).otherwise(F.least(F.floor(share * BUCKETS).cast("int"), F.lit(BUCKETS - 2)))


def _order_statistics(df: DataFrame, column: str, ranks: Sequence[int] | Callable[[int], Sequence[int]],
                      small: int = SMALL) -> dict[int, tuple]:
    """For each 0-based rank: (value there, rows below that value, rows with that value).

    ``ranks`` may be a function of the number of rows.  Nulls and NaN are not counted.  The driver only sees histogram
    cells and at most ``small`` distinct values per open interval.
    """
    value = F.col(column)
    if df.schema[column].dataType.typeName() in ("double", "float"):
        value = F.when(~F.isnan(value), value)
    df = df.select(value.alias("v"))
    n, low, high = df.agg(F.count("v"), F.min("v"), F.max("v")).first()
    ranks = ranks(n) if callable(ranks) else ranks
    for rank in ranks:
        if not 0 <= rank < n:
            raise ValueError(f"rank {rank} outside 0..{n - 1}")
    # interval of each rank: lowest value, highest value, rows below it, rows in it
    where = {rank: (low, high, 0, n) for rank in ranks}
    while True:
        wide = sorted({i for i in where.values() if i[0] != i[1] and i[3] > small})
        if not wide:
            break
        cell = F.lit(None).cast("int")
        which = F.lit(None).cast("int")
        for number, (lo, hi, _, _) in enumerate(wide):
            inside = F.col("v").between(F.lit(lo), F.lit(hi))
            at = _cell(lo, hi)
            cell, which = F.when(inside, at).otherwise(cell), F.when(inside, F.lit(number)).otherwise(which)
        # rows outside fall into one null cell; a filter would be pushed below the projection and
        # compute the column once more for every comparison in it
        cells = (df.select("v", which.alias("which"), cell.alias("cell"))
                 .groupBy("which", "cell").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                 .collect())
        narrowed = {}
        for number, interval in enumerate(wide):
            below, parts = interval[2], []
            if sum(c["which"] == number for c in cells) < 2:
                raise ValueError(f"no cut between {interval[0]} and {interval[1]}")
            for c in sorted((c for c in cells if c["which"] == number), key=lambda c: c["cell"]):
                parts.append((c["lo"], c["hi"], below, c["n"]))
                below += c["n"]
            narrowed[interval] = parts
        for rank, interval in where.items():
            if interval in narrowed:
                where[rank] = next(p for p in narrowed[interval] if p[2] <= rank < p[2] + p[3])
    found = {rank: (i[0], i[2], i[3]) for rank, i in where.items() if i[0] == i[1]}
    narrow = sorted({i for rank, i in where.items() if rank not in found})
    if narrow:
        inside = reduce(lambda a, b: a | b, [F.col("v").between(F.lit(i[0]), F.lit(i[1])) for i in narrow])
        counted = df.select(F.when(inside, F.col("v")).alias("v")).groupBy("v").agg(F.count("v").alias("n")).collect()
        counts = sorted((r["v"], r["n"]) for r in counted if r["v"] is not None)
        for interval in narrow:
            below = interval[2]
            steps = []
            for value, count in counts:
                if interval[0] <= value <= interval[1]:
                    steps.append((value, below, count))
                    below += count
            for rank, i in where.items():
                if i == interval:
                    found[rank] = next(s for s in steps if s[1] <= rank < s[1] + s[2])
    return found


def cut_points(df: DataFrame, columns: Sequence[str], ranks: Sequence[int], small: int = SMALL) -> dict[int, tuple]:
    """The rows at the given 0-based ranks in the order of ``columns`` (numeric, not null).

    Later columns are only looked at where the earlier ones tie.
    """
    first, rest = columns[0], list(columns[1:])
    found = _order_statistics(df, first, ranks, small)
    out = {}
    for value in {v for v, _, _ in found.values()}:
        here = {rank: below for rank, (v, below, _) in found.items() if v == value}
        ties = next(same for v, _, same in found.values() if v == value)
        if not rest:
            out.update({rank: (value,) for rank in here})
            continue
        inner = df.where(F.col(first) == F.lit(value))
        if ties == 1:
            tail = tuple(inner.select(*rest).first())
            out.update({rank: (value, *tail) for rank in here})
        else:
            sub = cut_points(inner, rest, sorted({rank - below for rank, below in here.items()}), small)
            out.update({rank: (value, *sub[rank - below]) for rank, below in here.items()})
    return out


def at_or_above(columns: Sequence[str], point: Sequence) -> Column:
    """``(columns) >= point`` in lexicographic order."""
    condition = F.lit(True)
    for name, value in reversed(list(zip(columns, point))):
        c = F.col(name)
        condition = (c > F.lit(value)) | ((c == F.lit(value)) & condition)
    return condition


def quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """Exact quantiles, linear between neighbours; null without values."""
    sizes = []

    def neighbours(n: int) -> list[int]:
        sizes.append(n)
        return sorted({r for s in shares for r in (math.floor((n - 1) * s), math.ceil((n - 1) * s))}) if n else []

    values = {rank: v for rank, (v, _, _) in _order_statistics(df, column, neighbours).items()}
    if not values:
        return [None] * len(shares)
    out = []
    for p in ((sizes[0] - 1) * s for s in shares):
        low, high = values[math.floor(p)], values[math.ceil(p)]
        out.append(float(low + (high - low) * (p - math.floor(p))))
    return out


def fill_median(df: DataFrame, column: str, store: bool = False, basis: DataFrame | None = None) -> DataFrame:
    """Null becomes the exact global median, of ``basis`` where a cheaper table with the same values is given.

    ``store`` writes the one column to the checkpoint folder first; use it where the values are costly
    to compute, as the median takes a few passes.
    """
    values = (df if basis is None else basis).select(column)
    (median,) = quantiles(cut_lineage(values) if store else values, column, [0.5])
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), F.lit(median)))


def dense_index(df: DataFrame, digest: str, ties: Sequence[str], by: Sequence[str] = (), total: int | None = None,
                per_bucket: int = 250_000, name: str = "idx") -> DataFrame:
    """0-based row number in digest order, within each ``by`` group.

    Digests spread evenly, so the buckets do as well, however large one ``by`` group is.
    Offsets are at most 65,536 per group.
    """
    total = df.count() if total is None else total
    bits = min(16, max(0, math.ceil(math.log2(max(1, total / per_bucket)))))
    order = [F.col(digest), *[F.col(t) for t in ties]]
    if bits == 0:
        window = Window.partitionBy(*by).orderBy(*order) if by else Window.partitionBy(F.lit(0)).orderBy(*order)
        return df.withColumn(name, F.row_number().over(window).cast("bigint") - 1)
    marked = df.withColumn("_bucket", F.shiftright(F.col(digest), BITS - bits))
    keys = [*by, "_bucket"]
    sizes = marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    joined = marked.join(offsets, keys)
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return joined.withColumn(name, F.col("_offset") + inside - 1).drop("_bucket", "_offset")


def running_totals(df: DataFrame, key: str, value: str, name: str = "total", per_block: int = 250_000) -> DataFrame:
    """Sum of ``value`` over all smaller or equal keys; ``key`` is unique and may be of any spread.

    The rows are dealt by ranges of the key into blocks of about ``per_block`` rows and stored, so that the blocks stay
    what they are; a window works inside one block, and the block sums are one row per block.
    """
    blocks = -(-df.count() // per_block) or 1
    placed = cut_lineage(df.repartitionByRange(blocks, key).withColumn("_block", F.spark_partition_id()))
    sums = placed.groupBy("_block").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(F.lit(0)).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    upto = Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    return (placed.join(offsets, "_block")
            .withColumn(name, F.col("_offset") + F.sum(value).over(upto))
            .drop("_block", "_offset"))


def split_by_time(df: DataFrame, share: float = 0.8, time: str = "req_time", ties: Sequence[str] = ("sid",),
                  basis: DataFrame | None = None) -> DataFrame:
    """``split``: "train" for the first ``share`` of the rows in time order, else "test"; no time sorts last.

    The cut is looked up in ``basis``, a cheaper table with the same times and ties, where one is given.
    """
    clock = F.coalesce(micros(time), F.lit(2**62)).alias("_t")
    keyed = df.select("*", clock)
    columns = ["_t", *ties]
    slim = (df if basis is None else basis).select(clock, *ties)
    limit = int(share * slim.count())
    if limit == 0:
        return df.withColumn("split", F.lit("test"))
    # the last training row, so that share = 1 needs no row beyond the end
    point = cut_points(slim, columns, [limit - 1])[limit - 1]
    late = at_or_above(columns, point)
    same = reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in zip(columns, point)])
    return keyed.withColumn("split", F.when(late & ~same, "test").otherwise("train")).drop("_t")


def split_sessions_by_time(df: DataFrame, share: float = 0.8, time: str = "req_time", session: str = "sid",
                           one_time: bool = True) -> DataFrame:
    """As :func:`split_by_time`, but on sessions: a session's rows stay together at its earliest time.

    ``one_time`` states that all rows of a session carry the same time, as after a join with the
    sessions; the rows are then marked in place.  Otherwise the marks come back by a join.
    """
    keyed = df.withColumn("_t", F.coalesce(micros(time), F.lit(2**62)))
    sessions = keyed.groupBy(session).agg(F.min("_t").alias("_t"))
    limit = int(share * sessions.count())
    if limit == 0:
        return df.withColumn("split", F.lit("test"))
    columns = ["_t", session]
    point = cut_points(sessions, columns, [limit - 1])[limit - 1]
    late = at_or_above(columns, point) & ~((F.col("_t") == F.lit(point[0])) & (F.col(session) == F.lit(point[1])))
    part = F.when(late, "test").otherwise("train").alias("split")
    if one_time:
        return keyed.select("*", part).drop("_t")
    return df.join(sessions.select(session, part), session)


def split_at(df: DataFrame, moment: str, time: str = "req_time") -> DataFrame:
    """"test" from ``moment`` on, else "train"."""
    late = F.col(time) >= F.lit(moment).cast("timestamp_ntz")
    return df.withColumn("split", F.when(late, "test").otherwise("train"))


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """First row per key in the given order, ties broken by the other columns.

    A minimum over structs combines on the map side, so a key with any number of rows sends
    one row per task, where a window would send them all to one task.
    """
    rest = [c for c in (columns or df.columns) if c not in keys and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in [*order, *rest]])
