"""Exact class sampling: the same rows for the same seed under any partitioning.

Without replacement, the k rows with the smallest digests are kept; the k-th digest comes from
:func:`wayfold.operators.ranks.cut_points`, so nothing is sorted or shuffled.  With replacement,
numbered draws pick row numbers; equal draws are counted before they meet the rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.functions.digest import digest60
from wayfold.operators.ranks import at_or_above, cut_points, dense_index


def class_sizes(df: DataFrame, label: str, most: int = 10_000) -> dict:
    rows = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{label} has more than {most} classes")
    return {r[0]: r["n"] for r in rows}


def _outside(label: str, classes) -> Column:
    return F.col(label).isNull() | ~F.col(label).isin(*classes)


def keep_exactly(df: DataFrame, label: str, quotas: Mapping[int, int], ids: Sequence[str] = ("sid",), seed: int = 0) -> DataFrame:
    """Of each class in ``quotas`` exactly that many rows, without replacement; other classes whole."""
    sizes = class_sizes(df, label)
    marked = df.withColumn("_h", digest60(*ids, seed=seed))
    keep = _outside(label, quotas)
    order = ["_h", *ids]
    for value, quota in quotas.items():
        n = sizes.get(value, 0)
        if quota > n:
            raise ValueError(f"class {value} has {n} rows, {quota} wanted without replacement")
        of_class = F.col(label) == F.lit(value)
        if quota == n:
            keep = keep | of_class
        elif quota > 0:
            first_out = cut_points(marked.where(of_class).select(*order), order, [quota])[quota]
            keep = keep | (of_class & ~at_or_above(order, first_out))
    return marked.where(keep).drop("_h")


def draw_exactly(df: DataFrame, label: str, targets: Mapping[int, int], ids: Sequence[str] = ("sid",), seed: int = 0) -> DataFrame:
    """Of each class in ``targets`` that many draws with replacement; other classes whole."""
    spark = df.sparkSession
    sizes = class_sizes(df, label)
    empty = [v for v in targets if not sizes.get(v)]
    if empty:
        raise ValueError(f"classes without rows cannot be drawn from: {empty}")
    draws = []
    for value, target in targets.items():
        number = F.pmod(digest60(F.lit(value), F.col("id"), seed=seed), F.lit(sizes[value]))
        draws.append(spark.range(target).select(F.lit(value).alias("_class"), number.alias("idx")))
    hits = reduce(DataFrame.unionByName, draws).groupBy("_class", "idx").agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    pool = df.where(F.col(label).isin(*targets)).withColumn("_h", digest60(*ids, seed=seed))
    numbered = dense_index(pool, "_h", ids, by=[label], total=sum(sizes[v] for v in targets))
    taken = numbered.withColumn("_class", F.col(label)).join(hits, ["_class", "idx"])
    copies = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return df.where(_outside(label, targets)).unionByName(copies.select(*df.columns))


def sample_percentage(df: DataFrame, mode: int, percentage: float, label: str = "click_mode", **how) -> DataFrame:
    """Class ``mode`` resampled to that percentage of its size, plus one row."""
    n = class_sizes(df, label).get(mode, 0)
    return draw_exactly(df, label, {mode: int(percentage * 0.01 * n) + 1}, **how)


def sample_amount(df: DataFrame, mode: int, amount: int, label: str = "click_mode", **how) -> DataFrame:
    return draw_exactly(df, label, {mode: amount}, **how)


def sample_like(df: DataFrame, mode: int, other: int, label: str = "click_mode", **how) -> DataFrame:
    """Class ``mode`` brought to the size of class ``other``: down without, up with replacement."""
    sizes = class_sizes(df, label)
    target = sizes.get(other, 0)
    pick = keep_exactly if target <= sizes.get(mode, 0) else draw_exactly
    return pick(df, label, {mode: target}, **how)


def sample_half(df: DataFrame, mode: int, label: str = "click_mode", **how) -> DataFrame:
    return keep_exactly(df, label, {mode: class_sizes(df, label).get(mode, 0) // 2}, **how)


def sample_down(df: DataFrame, mode: int, share: float, label: str = "click_mode", **how) -> DataFrame:
    return keep_exactly(df, label, {mode: math.floor(class_sizes(df, label).get(mode, 0) * share)}, **how)


def sample_double(df: DataFrame, mode: int, label: str = "click_mode", **how) -> DataFrame:
    return draw_exactly(df, label, {mode: 2 * class_sizes(df, label).get(mode, 0)}, **how)


def sample_up(df: DataFrame, mode: int, share: float, label: str = "click_mode", **how) -> DataFrame:
    n = class_sizes(df, label).get(mode, 0)
    return draw_exactly(df, label, {mode: n + math.floor(n * share)}, **how)


# Class sizes of the multiclass training set after rebalancing.
REBALANCED = {2: 70000, 4: 20000, 5: 20000, 8: 3000, 10: 20000}


def rebalance(df: DataFrame, targets: Mapping[int, int] = REBALANCED, label: str = "click_mode", **how) -> DataFrame:
    """All classes of ``targets`` resampled in one pass."""
    return draw_exactly(df, label, targets, **how)


def sample_n(df: DataFrame, n: int, ids: Sequence[str] = ("sid",), seed: int = 0) -> DataFrame:
    """``n`` rows for a look at the data; the top-n runs per partition first."""
    return df.withColumn("_h", digest60(*ids, seed=seed)).orderBy("_h", *ids).limit(n).drop("_h")
