"""Hand-made rows for the edge cases of plan lists, joins and the clock."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from wayfold.functions import clock, coords, encode, planlists
from wayfold.operators import context, joins, setops
from wayfold.plans import features


def plan(mode, distance=100, eta=10, price=5):
    return {"distance": distance, "price": price, "eta": eta, "transport_mode": mode}


def lists(spark, *texts):
    df = spark.createDataFrame([(i, t if t is None or isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)],
                               "sid long, plans string")
    return df.withColumn("plans", planlists.parse_plans(F.col("plans")))


def rows(df, key="sid"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_no_plans(spark):
    table = rows(features.plan_features(lists(spark, None, "[]", "oops", ""), keep="last"))
    assert len(table) == 4
    for r in table.values():
        assert [r[f"mode_{m}_available"] for m in range(12)] == [1] + [0] * 11
        assert r["first_mode"] == 0 and r["max_dist"] == r["std_eta"] == r["min_price_mode"] == -1
        assert r["dist_3"] == r["price_3"] == r["eta_3"] == 0
    words = lists(spark, None).select(F.array_join(planlists.mode_words(F.col("plans")), " ")).first()[0]
    assert words == "word_null"


@pytest.mark.parametrize("price", ["", 0, "0"])
def test_missing_price(spark, price):
    df = lists(spark, [plan(3, price=price)])
    assert features.plan_features(df).first()["max_price"] == 0
    assert planlists.wide(df, keep="last", missing_price=700).first()["price_3"] == 700
    assert planlists.wide(df, keep="first", missing_price=99999).first()["price_3"] == 99999
    assert planlists.wide(df, keep="first", missing_price=None, absent=None).first()["price_3"] is None


def test_repeated_mode(spark):
    df = lists(spark, [plan(3, distance=7), plan(3, distance=9)])
    assert planlists.wide(df, keep="last").first()["dist_3"] == 9
    assert planlists.wide(df, keep="first").first()["dist_3"] == 7


def test_ties_take_first_smallest_and_last_largest(spark):
    df = lists(spark, [plan(1, distance=5), plan(2, distance=3), plan(4, distance=3), plan(5, distance=5)])
    r = planlists.summarize(df).first()
    assert (r["min_dist_mode"], r["max_dist_mode"]) == (2, 5)
    assert r["mean_dist"] == 4.0 and r["std_dist"] == 1.0


def test_unfold_keeps_display_order(spark):
    df = planlists.unfold(lists(spark, [plan(3), plan(1, price="")], None), missing_price=-1)
    assert [(r["pos"], r["transport_mode"], r["price"]) for r in df.orderBy("pos").collect()] == [(0, 3, 5), (1, 1, -1)]


def test_wide_refuses_unknown_rule(spark):
    with pytest.raises(ValueError):
        planlists.wide(lists(spark, None), keep="middle")


@pytest.mark.parametrize("hour,flags,label", [(7, (1, 0, 0), "night"), (8, (0, 1, 0), "day"), (17, (0, 1, 0), "day"),
                                              (18, (0, 0, 0), "evening"), (19, (0, 0, 1), "evening")])
def test_parts_of_day(spark, hour, flags, label):
    df = spark.sql(f"SELECT TIMESTAMP_NTZ'2018-10-18 {hour:02d}:00:00' AS req_time")
    r = clock.clock_features(df).withColumn("label", clock.part_of_day(F.hour("req_time"))).first()
    assert (r["req_night"], r["req_day"], r["req_evening"]) == flags and r["label"] == label


@pytest.mark.parametrize("day,weekend,weekday", [("2018-10-18", 0, 3), ("2018-10-19", 1, 4), ("2018-10-20", 1, 5), ("2018-10-21", 0, 6)])
def test_weekend_is_friday_and_saturday(spark, day, weekend, weekday):
    df = spark.sql(f"SELECT TIMESTAMP_NTZ'{day} 12:00:00' AS req_time")
    r = clock.weekday_hour(clock.clock_features(df)).first()
    assert (r["req_weekend"], r["weekday"]) == (weekend, weekday)


def test_clock_refuses_unknown_kind(spark):
    with pytest.raises(ValueError):
        clock.clock_features(spark.range(1), "stop")


def test_bad_coordinates_become_null(spark):
    df = spark.createDataFrame([("116.3,39.9", "x"), ("", None)], "o string, d string")
    a, b = coords.split_coords(df).collect()
    assert (a["o_long"], a["o_lat"], a["d_long"], a["d_lat"]) == (116.3, 39.9, None, None)
    assert set(b) == {None}


def _tables(spark):
    queries = spark.sql("""SELECT * FROM VALUES (1L, 10L, TIMESTAMP_NTZ'2018-10-18 08:00:00', '116.3,39.9', '116.4,39.8'),
        (2L, NULL, TIMESTAMP_NTZ'2018-10-19 08:00:00', '116.3,39.9', '116.4,39.8'),
        (3L, 99L, TIMESTAMP_NTZ'2018-10-20 08:00:00', '116.3,39.9', '116.4,39.8') AS t(sid, pid, req_time, o, d)""")
    plans = spark.createDataFrame([(s, json.dumps([plan(3), plan(1, price="")])) for s in (1, 2, 3, 7)], "sid long, plans string")
    plans = plans.select("sid", F.lit(None).cast("timestamp_ntz").alias("plan_time"), "plans")
    clicks = spark.sql("SELECT * FROM VALUES (1L, TIMESTAMP_NTZ'2018-10-18 08:01:00', 3), (8L, TIMESTAMP_NTZ'2018-10-18 08:01:00', 1) "
                       "AS t(sid, click_time, click_mode)")
    profiles = spark.range(10, 11).select(F.col("id").alias("pid"), *[F.lit(i % 2).alias(f"p{i}") for i in range(66)])
    return queries, plans, clicks, profiles


def test_col_layout_keeps_orphan_lists_and_drops_orphan_clicks(spark):
    table = rows(features.features_col(*_tables(spark)))
    assert sorted(table) == [1, 2, 3, 7]
    assert table[7]["o_long"] is None and table[7]["Response"] == 0 and table[7]["mode_3_available"] == 1
    assert (table[1]["pid"], table[1]["p1"], table[1]["click_mode"]) == (10, 1, 3)
    assert (table[2]["pid"], table[2]["p1"], table[2]["p65"]) == (-1, -1, -1)
    assert (table[3]["pid"], table[3]["p1"]) == (99, None)


def test_row_layout_drops_orphans_and_unknown_profiles(spark):
    table = features.features_row(*_tables(spark)).select("sid", "transport_mode", "price", "click_mode").collect()
    assert sorted((r["sid"], r["transport_mode"]) for r in table) == [(1, 1), (1, 3), (2, 1), (2, 3)]
    assert {r["price"] for r in table} == {5.0}


def test_weather_of_unknown_date_is_an_error(spark):
    df = spark.createDataFrame([("13-01",)], "req_date string")
    calendar = spark.createDataFrame([("01-01", "3", "1", "q", "2")], "md string, max_temp string, min_temp string, weather string, wind string")
    with pytest.raises(Exception, match="no weather for date"):
        context.add_weather(df, calendar).collect()


def test_district_ties_take_the_first(spark):
    places = [(0, 1.0, 0.0), (1, -1.0, 0.0)]
    df = spark.createDataFrame([(0.0, 0.0), (-0.5, 0.0), (None, 0.0)], "x double, y double")
    got = [r[0] for r in df.select(context.district_of(F.col("x"), F.col("y"), places)).collect()]
    assert got == [0, 1, None]


def test_district_code_reads_both_spellings(spark):
    df = spark.createDataFrame([("o_district_7",), ("d_district12",), ("none",), (None,)], "t string")
    assert [r[0] for r in df.select(encode.district_code(F.col("t"))).collect()] == [7, 12, None, None]


def test_join_on_session_keeps_shared_columns_once(spark):
    a = spark.createDataFrame([(1, 2.0)], "sid long, x double")
    b = spark.createDataFrame([(1, 2.0000001, 5)], "sid long, x double, y int")
    assert joins.join_on_session(a, b).columns == ["sid", "x", "y"]


def test_schema_diff(spark):
    left, right = spark.range(1).select(F.col("id").alias("a"), F.lit(1).alias("b")), spark.range(1).select(F.col("id").alias("b"))
    assert setops.schema_diff(left, right) == {"only_left": ["a"], "only_right": []}
