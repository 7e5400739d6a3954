"""Counts, distributions and column profiles.

All group keys combine on the map side.  Distributions over many groups are reduced to
(value, frequency) pairs before a percentile is taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.functions.clock import part_of_day
from wayfold.operators.ranks import quantiles

MOST_TYPES = 1000


def counts(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def activity(df: DataFrame, user: str = "pid", few: int = 5) -> DataFrame:
    """Distribution of rows per user, one row; users with fewer than ``few`` rows."""
    per_user = df.where(F.col(user).isNotNull()).groupBy(user).agg(F.count(F.lit(1)).alias("n"))
    sizes = per_user.groupBy("n").agg(F.count(F.lit(1)).alias("users"))
    total, heads = F.sum(F.col("n") * F.col("users")), F.sum("users")
    squares = F.sum(F.col("n").cast("double") * F.col("n") * F.col("users"))
    q = F.percentile("n", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("users"))
    row = sizes.agg(heads.alias("users"), total.alias("rows"), squares.alias("_sq"), F.min("n").alias("min"),
                    F.max("n").alias("max"), q.alias("_q"),
                    F.coalesce(F.sum(F.when(F.col("n") < few, F.col("users"))), F.lit(0)).alias("few"))
    mean = F.try_divide("rows", "users")
    # null for one user or none; rounding must not take the sum of squares below zero
    spread = F.sqrt(F.try_divide(F.greatest(F.col("_sq") - F.col("rows") * mean, F.lit(0.0)), F.col("users") - 1))
    return row.select("users", "rows", mean.alias("mean"), spread.alias("std"), "min",
                      *[F.col("_q")[i].alias(c) for i, c in enumerate(("q25", "q50", "q75"))], "max", "few")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum, one row per column."""
    parts = []
    for c in columns:
        v = F.col(c).cast("double")
        parts += [F.count(v), F.avg(v), F.stddev_samp(v), F.min(v), F.max(v)]
    flat = df.agg(*[p.alias(f"a{i}") for i, p in enumerate(parts)]).first()
    rows = []
    for i, c in enumerate(columns):
        n, mean, std, low, high = flat[5 * i: 5 * i + 5]
        rows.append((c, n, mean, std, low, *quantiles(df, c, [0.25, 0.5, 0.75]), high))
    return df.sparkSession.createDataFrame(
        rows, "`column` string, n bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double")


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column, as a count and as a percentage."""
    missing = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])
    return missing.select("_rows", F.inline(pairs)).select(
        "column", "nulls", (F.col("nulls") * 100.0 / F.col("_rows")).alias("percent"))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Number of distinct values per column, as one row per column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    row = df.agg(*[count(c).alias(c) for c in columns])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("n_unique")) for c in columns])))


def user_mode_counts(clicks: DataFrame, modes: Sequence[int]) -> DataFrame:
    """Clicks per user and mode, wide; the anonymous row (-1) holds -1."""
    user = F.coalesce("pid", F.lit(-1)).alias("pid")
    per = clicks.groupBy(user).agg(*[F.count_if(F.col("click_mode") == m).alias(f"click_mode_{m}") for m in modes])
    return per.withColumns({f"click_mode_{m}": F.when(F.col("pid") == -1, F.lit(-1)).otherwise(F.col(f"click_mode_{m}"))
                            for m in modes})


def demand_by_day(df: DataFrame, time: str = "req_time") -> DataFrame:
    return df.groupBy(F.to_date(time).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def demand_by_weekday(df: DataFrame, time: str = "req_time") -> DataFrame:
    """Mean sessions per day, by weekday (Monday = 0)."""
    return demand_by_day(df, time).groupBy(F.weekday("day").alias("weekday")).agg(F.avg("n").alias("mean"))


def demand_by_part(df: DataFrame, time: str = "req_time") -> DataFrame:
    """Sessions per weekday, per hour and per part of the day, from one pass over the rows."""
    cells = df.groupBy(F.date_format(time, "EEEE").alias("weekday"), F.hour(time).alias("hour")).agg(
        F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("part", part_of_day(F.col("hour")))
    grouped = cells.groupingSets([["weekday"], ["hour"], ["part"]], "weekday", "hour", "part").agg(F.sum("n").alias("n"))
    kind = F.when(F.col("weekday").isNotNull(), "weekday").when(F.col("hour").isNotNull(), "hour").otherwise("part")
    return grouped.select(kind.alias("kind"), F.coalesce("weekday", F.col("hour").cast("string"), "part").alias("value"), "n")


def mode_by_district(df: DataFrame, totals: bool = False) -> DataFrame:
    """Clicks per mode, origin and destination district; ``totals`` adds every subtotal."""
    keys = ["click_mode", "o_district", "d_district"]
    cells = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return cells.cube(*keys).agg(F.sum("n").alias("n")) if totals else cells


def cluster_members(df: DataFrame, cluster: str = "cluster", key: str = "pid", block: int = 1000) -> DataFrame:
    """Members per cluster, in sorted arrays of keys from the same block of ``block`` keys.

    A cluster may hold any share of the users; the blocks bound each array by ``block`` keys.
    """
    return (df.groupBy(cluster, F.floor(F.col(key) / F.lit(block)).alias("block"))
            .agg(F.sort_array(F.collect_list(key)).alias("members")))


def score_by_model(runs: DataFrame) -> DataFrame:
    """Exact quartiles of the score per model type, by histogram passes for each of the few types (checked)."""
    sizes = runs.where(F.col("score").isNotNull()).groupBy("model_type").count().limit(MOST_TYPES + 1).collect()
    if len(sizes) > MOST_TYPES:
        raise ValueError(f"more than {MOST_TYPES} model types")
    rows = [(r["model_type"], r["count"], *quantiles(runs.where(F.col("model_type").eqNullSafe(F.lit(r["model_type"]))), "score",
                                                    [0.0, 0.25, 0.5, 0.75, 1.0])) for r in sizes]
    return runs.sparkSession.createDataFrame(
        rows, "model_type string, runs bigint, min double, q25 double, q50 double, q75 double, max double")


def best_row(df: DataFrame, score: str, value: str) -> DataFrame:
    """Value with the largest score; the smallest value on ties."""
    best = F.min(F.struct((-F.col(score)).alias("s"), F.col(value).alias("v"))).alias("b")
    return df.agg(best).select(F.col("b.v").alias(value), (-F.col("b.s")).alias(score))


def top_users(df: DataFrame, k: int = 50, user: str = "pid") -> DataFrame:
    """The ``k`` users with the most rows; smaller ids first on ties."""
    return counts(df.where(F.col(user).isNotNull()), user).orderBy(F.desc("n"), user).limit(k)


def session_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("sid").agg(F.count(F.lit(1)).alias("n"))


def label_per_session(rows: DataFrame) -> DataFrame:
    return rows.groupBy("sid").agg(F.min("click_mode").alias("click_mode"))
