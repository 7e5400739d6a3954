"""Stacking, sentinels, differences of id sets and of schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_rows(*tables: DataFrame, fill: bool = False) -> DataFrame:
    out = tables[0]
    for df in tables[1:]:
        out = out.unionByName(df, allowMissingColumns=fill)
    return out


def add_sentinel(profiles: DataFrame, pid: int = -1, value: int = -1) -> DataFrame:
    """Profile table plus one row for the anonymous user."""
    types = dict(profiles.dtypes)
    row = {c: F.lit(pid if c == "pid" else value).cast(types[c]).alias(c) for c in profiles.columns}
    one = profiles.sparkSession.range(1).select(*row.values())
    return profiles.unionByName(one)


def sid_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Sids in both, only left, only right: counts from a single grouping of both sets."""
    marked = left.select("sid", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select("sid", F.lit(0).alias("l"), F.lit(1).alias("r")))
    per = marked.groupBy("sid").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return per.agg(F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("both"),
                   F.count_if(F.col("r") == 0).alias("only_left"), F.count_if(F.col("l") == 0).alias("only_right"))


def shared_sids(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("sid").intersect(right.select("sid"))


def missing_sids(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("sid").exceptAll(right.select("sid"))


def schema_diff(left: DataFrame, right: DataFrame) -> Mapping[str, list[str]]:
    """Column names found in only one of two tables."""
    a, b = set(left.columns), set(right.columns)
    return {"only_left": sorted(a - b), "only_right": sorted(b - a)}
