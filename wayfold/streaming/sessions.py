"""Features of arriving sessions and plan lists.

The column functions keep no state, so they run unchanged on ``readStream`` frames; the day tables
stay static sides.  Nothing here needs a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.functions import clock, coords, planlists
from wayfold.operators import context
from wayfold.plans.features import plan_features


def session_stream(queries: DataFrame, holidays: DataFrame, calendar: DataFrame, districts: DataFrame) -> DataFrame:
    """Coordinates, clock, holiday, weather and districts of each arriving session."""
    df = clock.clock_features(coords.split_coords(queries), "req")
    df = context.add_weather(context.add_holiday(df, holidays), calendar)
    return context.add_districts(df, districts)


def plan_stream(plans: DataFrame, keep: str = "last") -> DataFrame:
    """Plan features of each arriving list."""
    parsed = plans.withColumn("plans", planlists.parse_plans(F.col("plans")))
    return plan_features(parsed, keep=keep).drop("plans")
