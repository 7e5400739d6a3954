"""Checks of tables, joins and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The table itself, or an error naming the columns it lacks; runs no job."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    return df


def check_same_schema(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left``, or an error if names, order or types differ."""
    a, b = left.dtypes, right.dtypes
    if a != b:
        raise ValueError(f"schemas differ: {[x for x in a if x not in b]} / {[x for x in b if x not in a]}")
    return left


def columns_found(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``(column, found)`` of every required column."""
    rows = [(c, c in df.columns) for c in required]
    return df.sparkSession.createDataFrame(rows, "column string, found boolean")


def schema_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(place, left, right)``: places from 0 where the two tables differ in name or type; null beyond the shorter one's end."""
    said = [[f"{name} {kind}" for name, kind in df.dtypes] for df in (left, right)]
    size = max(map(len, said))
    a, b = (own + [None] * (size - len(own)) for own in said)
    rows = [(i, x, y) for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y]
    return left.sparkSession.createDataFrame(rows, "place int, left string, right string")


def rows_with_null(df: DataFrame) -> DataFrame:
    """Number of rows with any null, and of columns with any null, in one pass."""
    some = F.lit(False)
    for c in df.columns:
        some = some | F.col(c).isNull()
    row = df.agg(F.count_if(some).alias("rows_with_null"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in df.columns])
    holed = sum(((F.col(f"_{c}") > 0).cast("int") for c in df.columns), F.lit(0))
    return row.select("rows_with_null", holed.alias("columns_with_null"))


def check_row_count(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before and after a join, and whether it kept the number."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("side"), "n")
    both = count(before, "before").unionByName(count(after, "after"))
    pick = lambda side: F.max(F.when(F.col("side") == side, F.col("n")))
    row = both.agg(pick("before").alias("before"), pick("after").alias("after"))
    return row.withColumn("same", F.col("before") == F.col("after"))


def check_folds(df: DataFrame, sids: DataFrame) -> DataFrame:
    """Do the folds partition the sids: every sid once, none missing, sizes per table."""
    marked = df.select("sid", "fold").unionByName(sids.select("sid", F.lit(-1).alias("fold")))
    per = marked.groupBy("sid").agg(F.count_if(F.col("fold") >= 0).alias("times"), F.count_if(F.col("fold") < 0).alias("listed"))
    row = per.agg(F.count_if(F.col("times") > 1).alias("repeated"), F.count_if(F.col("times") == 0).alias("missing"),
                  F.count_if(F.col("listed") == 0).alias("unknown"))
    return row.withColumn("ok", (F.col("repeated") + F.col("missing") + F.col("unknown")) == 0)
