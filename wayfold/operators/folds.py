"""Reproducible folds and random splits, decided row by row from a seeded digest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.functions.digest import BITS, digest60
from wayfold.operators.ranks import at_or_above, cut_points, dense_index
from wayfold.session import cut_lineage


def _cut_folds(df: DataFrame, sizes: Sequence[int], ids: Sequence[str], seed: int, basis: DataFrame | None = None) -> DataFrame:
    """Folds of exactly the given sizes, in digest order."""
    marked = df.withColumn("_h", digest60(*ids, seed=seed))
    basis = marked if basis is None else basis
    order = ["_h", *ids]
    starts, at = [], 0
    for size in sizes[:-1]:
        at += size
        starts.append(at)
    fold = F.lit(0)
    n = sum(sizes)
    inner = [s for s in starts if s < n]
    if inner:
        points = cut_points(basis.select(*order), order, sorted(set(inner)))
        for start in inner:
            fold = fold + at_or_above(order, points[start]).cast("int")
    return marked.withColumn("fold", fold).drop("_h")


def folds_equal(df: DataFrame, k: int, ids: Sequence[str] = ("sid",), seed: int = 9001) -> DataFrame:
    """``fold`` 0..k-1 of exactly equal size; an error where k does not divide the rows."""
    n = df.count()
    if n % k:
        raise ValueError(f"{n} rows do not divide into {k} equal folds")
    return _cut_folds(df, [n // k] * k, ids, seed)


def folds_shuffled(df: DataFrame, k: int, ids: Sequence[str] = ("sid",), seed: int = 0, basis: DataFrame | None = None) -> DataFrame:
    """Shuffled folds whose sizes differ by at most one, the larger ones first.

    The cuts are looked up in ``basis``, a cheaper table with the ids of the same rows, where one is given; its digests are
    stored once, as the search takes several passes over them.
    """
    if basis is not None:
        basis = cut_lineage(basis.select(digest60(*ids, seed=seed).alias("_h"), *ids))
    n = (df if basis is None else basis).count()
    return _cut_folds(df, [n // k + (1 if i < n % k else 0) for i in range(k)], ids, seed, basis)


def folds_stratified(df: DataFrame, k: int, label: str, ids: Sequence[str] = ("sid",), seed: int = 0) -> DataFrame:
    """Folds that hold every class in equal parts, up to one row."""
    marked = df.withColumn("_h", digest60(*ids, seed=seed))
    numbered = dense_index(marked, "_h", ids, by=[label])
    return numbered.withColumn("fold", (F.col("idx") % k).cast("int")).drop("_h", "idx")


def split_random(df: DataFrame, share: float = 0.75, ids: Sequence[str] = ("sid",), seed: int = 0) -> DataFrame:
    """About ``share`` of the rows are "train"; the same rows on every read."""
    border = int(share * 2**BITS)
    return df.withColumn("split", F.when(digest60(*ids, seed=seed) < border, "train").otherwise("test"))
