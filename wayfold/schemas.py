"""Declared types of the trip-log tables; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

# Mode codes (0 = no plan / no click) and profile attribute names.
MODES = list(range(12))
PROFILE_COLUMNS = [f"p{i}" for i in range(66)]
# Weather vocabulary, in the order of the one-hot columns.
WEATHER = ["dy", "dyq", "q", "qdy", "xq", "xydy"]

PLAN = T.StructType([
    T.StructField("distance", T.IntegerType()),
    T.StructField("price", T.StringType()),
    T.StructField("eta", T.IntegerType()),
    T.StructField("transport_mode", T.IntegerType()),
])
PLAN_LIST = T.ArrayType(PLAN)

QUERIES = T.StructType([
    T.StructField("sid", T.LongType()),
    T.StructField("pid", T.LongType()),
    T.StructField("req_time", T.TimestampNTZType()),
    T.StructField("o", T.StringType()),
    T.StructField("d", T.StringType()),
])
PLANS = T.StructType([
    T.StructField("sid", T.LongType()),
    T.StructField("plan_time", T.TimestampNTZType()),
    T.StructField("plans", T.StringType()),
])
CLICKS = T.StructType([
    T.StructField("sid", T.LongType()),
    T.StructField("click_time", T.TimestampNTZType()),
    T.StructField("click_mode", T.IntegerType()),
])
PROFILES = T.StructType(
    [T.StructField("pid", T.LongType())]
    + [T.StructField(c, T.IntegerType()) for c in PROFILE_COLUMNS]
)
STATIONS = T.StructType([
    T.StructField("subway_name", T.StringType()),
    T.StructField("o_lat", T.DoubleType()),
    T.StructField("o_long", T.DoubleType()),
])
DISTRICTS = T.StructType([
    T.StructField("District", T.StringType()),
    T.StructField("o_lat", T.DoubleType()),
    T.StructField("o_long", T.DoubleType()),
])
DAY = T.StructType([
    T.StructField("max_temp", T.StringType()),
    T.StructField("min_temp", T.StringType()),
    T.StructField("weather", T.StringType()),
    T.StructField("wind", T.StringType()),
])
CALENDAR = T.MapType(T.StringType(), DAY)
