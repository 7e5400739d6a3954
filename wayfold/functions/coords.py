"""Coordinates: text split and distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_KM = 6371.0088


def split_coords(df: DataFrame) -> DataFrame:
    """Texts ``o`` and ``d`` ("long,lat") become four doubles; unreadable parts become null."""
    parts = {}
    for end in ("o", "d"):
        pieces = F.split(F.col(end), ",", 2)
        parts[f"{end}_long"] = F.get(pieces, F.lit(0)).try_cast("double")
        parts[f"{end}_lat"] = F.get(pieces, F.lit(1)).try_cast("double")
    return df.withColumns(parts).drop("o", "d")


def planar(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def great_circle_km(long1: Column, lat1: Column, long2: Column, lat2: Column) -> Column:
    """Haversine on the mean Earth radius."""
    dlat, dlong = F.radians(lat2 - lat1), F.radians(long2 - long1)
    half = (F.pow(F.sin(dlat / 2), F.lit(2))
            + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlong / 2), F.lit(2)))
    return F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(half)))
