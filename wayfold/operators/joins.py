"""Joins of sessions, plans, clicks and profiles, all equi-joins on ``sid`` or ``pid``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENTINEL = -1


def _spread(key: str, by: str) -> Column:
    """The key, or, where it is null, one of 2^40 negative numbers no profile has.

    About a third of the sessions are anonymous.  Under an outer join their null keys would all
    meet in one task; spread keys match nothing either, but share the work.
    """
    return F.coalesce(F.col(key), F.lit(-2) - F.pmod(F.xxhash64(by), F.lit(2**40)))


def join_profiles(sessions: DataFrame, profiles: DataFrame, columns: Sequence[str] | None = None,
                  unknown: str = "keep", anonymous: Mapping[str, float] | None = None) -> DataFrame:
    """Profile attributes by ``pid``; anonymous sessions get pid and attributes -1, or those of ``anonymous``.

    A pid without profile keeps its row with null attributes (``unknown="keep"``) or loses it ("drop").
    """
    if unknown not in ("keep", "drop"):
        raise ValueError(f"unknown must be keep or drop, not {unknown!r}")
    columns = [c for c in (columns or profiles.columns) if c != "pid"]
    side = profiles.select(F.col("pid").alias("_key"), *columns, F.lit(True).alias("_found"))
    joined = sessions.withColumn("_key", _spread("pid", "sid")).join(side, "_key", "left")
    if unknown == "drop":
        joined = joined.where(F.col("pid").isNull() | F.col("_found"))
    given = anonymous or {}
    filled = {c: F.when(F.col("pid").isNull(), F.lit(given.get(c, SENTINEL))).otherwise(F.col(c)) for c in columns}
    return joined.withColumns(filled).withColumn("pid", F.coalesce("pid", F.lit(SENTINEL))).drop("_key", "_found")


def join_clicks_full(sessions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Every session and every click, also those without partner."""
    return sessions.join(clicks, "sid", "full")


def join_plans_full(sessions: DataFrame, plans: DataFrame) -> DataFrame:
    return sessions.join(plans, "sid", "full")


def join_profiles_full(sessions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Full join on pid, then only rows with coordinates.

    Unmatched profiles have none, so this is the left join of the located sessions; anonymous
    pids stay null.
    """
    located = sessions.where(F.col("o_long").isNotNull())
    side = profiles.withColumnRenamed("pid", "_key")
    return located.withColumn("_key", _spread("pid", "sid")).join(side, "_key", "left").drop("_key")


def join_row_layout(rows: DataFrame, sessions: DataFrame, clicks: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row per shown plan with its session, click (0 without) and profile.

    Plans without session and clicks without plan have no pid, so the profile join would drop
    them anyway; they are left out at the last join.
    """
    labelled = sessions.join(clicks, "sid", "left").withColumn("click_mode", F.coalesce("click_mode", F.lit(0)))
    # sessions are a fraction of the plans, so the wide profile crosses its shuffle once a session and meets the plans last
    return rows.join(join_profiles(labelled, profiles, unknown="drop"), "sid")


def join_on_session(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Natural join keyed on ``sid``; other shared columns are taken from the left."""
    shared = [c for c in right.columns if c in left.columns and c != "sid"]
    return left.join(right.drop(*shared), "sid", how)


def bind_columns(*tables: DataFrame, key: str = "sid") -> DataFrame:
    """Tables side by side, aligned on ``key``, as there is no row number to align on."""
    return reduce(lambda a, b: a.join(b, key), tables)


def join_many(tables: Mapping[str, DataFrame], key: str = "sid", how: str = "inner") -> DataFrame:
    """Any number of tables on ``key``; each one's columns get its name as suffix."""
    renamed = [df.select(key, *[F.col(c).alias(f"{c}_{name}") for c in df.columns if c != key])
               for name, df in tables.items()]
    return reduce(lambda a, b: a.join(b, key, how), renamed)


def only_sessions(df: DataFrame, sids: DataFrame) -> DataFrame:
    return df.join(sids, "sid", "left_semi")


def without_sessions(df: DataFrame, sids: DataFrame) -> DataFrame:
    return df.join(sids, "sid", "left_anti")


def listed_sessions(sids: DataFrame, df: DataFrame) -> DataFrame:
    """Every listed sid, with its data where there is any."""
    return sids.join(df, "sid", "left")


def outside_fold(df: DataFrame, fold: int) -> DataFrame:
    return df.where(F.col("fold") != fold)


def inside_fold(df: DataFrame, fold: int) -> DataFrame:
    return df.where(F.col("fold") == fold)


def patch_predictions(base: DataFrame, other: DataFrame, column: str = "prediction") -> DataFrame:
    """Predictions equal to 0 are replaced by the other model's for the same sid."""
    side = other.select("sid", F.col(column).alias("_other"))
    better = F.when(F.col(column) == 0, F.coalesce("_other", F.col(column))).otherwise(F.col(column))
    return base.join(side, "sid", "left").withColumn(column, better).drop("_other")


def of_mode(df: DataFrame, modes: Iterable[int], column: str = "click_mode") -> DataFrame:
    return df.where(F.col(column).isin(*modes))


def not_of_mode(df: DataFrame, modes: Iterable[int], column: str = "click_mode") -> DataFrame:
    return df.where(~F.col(column).isin(*modes))


def identified(df: DataFrame) -> DataFrame:
    return df.where(F.col("pid").isNotNull())
