"""Calendar and clock features of a timestamp column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def weekday_hour(df: DataFrame, column: str = "req_time") -> DataFrame:
    """``weekday`` (Monday = 0) and ``hour``."""
    return df.withColumns({"weekday": F.weekday(column), "hour": F.hour(column)})


def clock_features(df: DataFrame, kind: str = "req", weekend_days: Sequence[int] = (4, 5)) -> DataFrame:
    """Date, hour, weekend, night, day and evening of ``<kind>_time``.

    Friday and Saturday are the default weekend; hour 18 belongs to no part of the day.
    """
    if kind not in ("req", "click", "plan"):
        raise ValueError(f"kind must be req, click or plan, not {kind!r}")
    time = F.col(f"{kind}_time")
    hour = F.hour(time)
    return df.withColumns({
        f"{kind}_date": F.date_format(time, "MM-dd"),
        f"{kind}_hour": hour,
        f"{kind}_weekend": F.weekday(time).isin(*weekend_days).cast("int"),
        f"{kind}_night": (hour <= 7).cast("int"),
        f"{kind}_day": hour.between(8, 17).cast("int"),
        f"{kind}_evening": (hour > 18).cast("int"),
    })


def part_of_day(hour: Column) -> Column:
    """Label of an hour; unlike the flags, hour 18 counts as evening."""
    return F.when(hour <= 7, "night").when(hour < 18, "day").otherwise("evening")


def day_number(date_text: Column, first_month: int) -> Column:
    """Running day of a ``yyyy-MM-dd`` text when every month counts 30 days."""
    pick = lambda group: F.regexp_extract(date_text, r"^\d{4}-(\d{2})-(\d{2})", group).try_cast("int")
    return pick(2) + F.lit(30) * (pick(1) - F.lit(first_month))


def daytime_request(time: Column) -> Column:
    return F.hour(time).between(6, 21)
