"""Filters, joins and context look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfold import bindings as B
from wayfold.bindings import oracle
from wayfold.catalog import register
from wayfold.catalog.scalars import coords_of, rounded
from wayfold.functions import clock, encode
from wayfold.operators import context, joins
from wayfold.schemas import PROFILE_COLUMNS, WEATHER

FOLD = "sid % 5"


def _with_clicks(spark, d):
    sessions = B.queries_table(spark, d).select("sid", "pid")
    return sessions.join(B.clicks_table(spark, d).select("sid", "click_mode"), "sid")


@register("filter_mode", oracle("t_clicks", body="""SELECT sid, click_mode, 'is' AS kind FROM t_clicks WHERE click_mode = 3
    UNION ALL SELECT sid, click_mode, 'not' FROM t_clicks WHERE click_mode <> 3"""))
def _(spark, d):
    clicks = B.clicks_table(spark, d).drop("click_time")
    return joins.of_mode(clicks, [3]).withColumn("kind", F.lit("is")).unionByName(
        joins.not_of_mode(clicks, [3]).withColumn("kind", F.lit("not")))


@register("filter_identified", oracle("t_queries", body="SELECT sid, pid FROM t_queries WHERE pid IS NOT NULL"))
def _(spark, d):
    return joins.identified(B.queries_table(spark, d).select("sid", "pid"))


@register("semi_sids", oracle("t_rows", "t_clicks", body="""SELECT sid, pos, transport_mode, distance FROM t_rows
    WHERE sid IN (SELECT sid FROM t_clicks)"""))
def _(spark, d):
    rows = B.plan_rows_table(spark, d).select("sid", "pos", "transport_mode", "distance")
    return joins.only_sessions(rows, B.clicks_table(spark, d).select("sid"))


@register("anti_fold", oracle("t_rows", "t_queries", body=f"""SELECT sid, pos, transport_mode, 'fold' AS kind FROM t_rows
    WHERE {FOLD} <> 2 UNION ALL SELECT r.sid, pos, transport_mode, 'anti' FROM t_rows r
    WHERE NOT EXISTS (SELECT 1 FROM t_queries q WHERE q.sid = r.sid)"""))
def _(spark, d):
    rows = B.plan_rows_table(spark, d).select("sid", "pos", "transport_mode")
    folded = joins.outside_fold(rows.withColumn("fold", F.expr(FOLD)), 2).drop("fold")
    left_out = joins.without_sessions(rows, B.queries_table(spark, d).select("sid"))
    return folded.withColumn("kind", F.lit("fold")).unionByName(left_out.withColumn("kind", F.lit("anti")))


@register("join_clicks_full", oracle("t_queries", "t_clicks", body="""SELECT coalesce(q.sid, c.sid) AS sid, pid, req_time,
    click_time, click_mode FROM t_queries q FULL JOIN t_clicks c ON q.sid = c.sid"""))
def _(spark, d):
    return joins.join_clicks_full(B.queries_table(spark, d).drop("o", "d"), B.clicks_table(spark, d))


@register("join_profiles_full", oracle("t_coords", "t_profiles", body=f"""SELECT c.sid, c.pid, c.o_long,
    {', '.join('p.' + c for c in PROFILE_COLUMNS)}
    FROM t_coords c FULL JOIN t_profiles p ON c.pid = p.pid WHERE c.o_long IS NOT NULL"""))
def _(spark, d):
    profiles = B.profiles_table(spark, d)
    return joins.join_profiles_full(coords_of(spark, d).select("sid", "pid", "o_long"), profiles)


@register("join_plans_full", oracle("t_queries", "t_sessions", body="""SELECT coalesce(q.sid, s.sid) AS sid, pid, plan_time
    FROM t_queries q FULL JOIN t_sessions s ON q.sid = s.sid"""))
def _(spark, d):
    return joins.join_plans_full(B.queries_table(spark, d).select("sid", "pid"), B.plans_table(spark, d).drop("plans"))


@register("join_plans_left", oracle("t_rows", "t_coords", body="""SELECT r.sid, pos, transport_mode, distance, pid, o_long, o_lat
    FROM t_rows r LEFT JOIN t_coords c ON r.sid = c.sid"""))
def _(spark, d):
    rows = B.plan_rows_table(spark, d).drop("eta", "price")
    return rows.join(coords_of(spark, d).select("sid", "pid", "o_long", "o_lat"), "sid", "left")


@register("join_queries_left_plans", oracle("t_queries", "t_sessions", body="""SELECT q.sid, pid, plan_time FROM t_queries q
    LEFT JOIN t_sessions s ON q.sid = s.sid"""))
def _(spark, d):
    return B.queries_table(spark, d).select("sid", "pid").join(B.plans_table(spark, d).drop("plans"), "sid", "left")


_PROFILE_OR_NONE = ", ".join(f"CASE WHEN q.pid IS NULL THEN -1 ELSE p.{c} END AS {c}" for c in PROFILE_COLUMNS)


@register("join_row_layout", oracle("t_rows", "t_coords", "t_clicks", "t_profiles", body=f"""
    SELECT r.sid, pos, transport_mode, distance, eta, price, o_long, o_lat, d_long, d_lat, coalesce(q.pid, -1) AS pid,
    coalesce(click_mode, 0) AS click_mode, {_PROFILE_OR_NONE}
    FROM t_rows r JOIN t_coords q ON r.sid = q.sid LEFT JOIN t_clicks c ON r.sid = c.sid
    LEFT JOIN t_profiles p ON q.pid = p.pid WHERE q.pid IS NULL OR p.pid IS NOT NULL"""))
def _(spark, d):
    return joins.join_row_layout(
        B.plan_rows_table(spark, d), coords_of(spark, d).select("sid", "pid", "o_long", "o_lat", "d_long", "d_lat"),
        B.clicks_table(spark, d).select("sid", "click_mode"), B.profiles_table(spark, d))


@register("join_pid_inner", oracle("t_queries", "t_profiles", body=f"""SELECT sid, q.pid, {', '.join(PROFILE_COLUMNS)} FROM t_queries q
    JOIN t_profiles p ON q.pid = p.pid"""))
def _(spark, d):
    return joins.identified(B.queries_table(spark, d).select("sid", "pid")).join(B.profiles_table(spark, d), "pid")


@register("join_pid_left", oracle("t_queries", "t_profiles", body=f"""SELECT sid, coalesce(q.pid, -1) AS pid, {_PROFILE_OR_NONE}
    FROM t_queries q LEFT JOIN t_profiles p ON q.pid = p.pid"""))
def _(spark, d):
    return joins.join_profiles(B.queries_table(spark, d).select("sid", "pid"), B.profiles_table(spark, d), PROFILE_COLUMNS)


@register("join_natural", oracle("t_coords", "t_clicks", body="""SELECT a.sid, a.o_long, a.o_lat, CAST(hour(req_time) AS INT) AS hour,
    click_mode FROM t_coords a JOIN t_clicks c ON a.sid = c.sid"""))
def _(spark, d):
    left = coords_of(spark, d).select("sid", "o_long", "o_lat", F.hour("req_time").alias("hour"))
    right = coords_of(spark, d).select("sid", "o_long", "o_lat").join(
        B.clicks_table(spark, d).select("sid", "click_mode"), "sid")
    return joins.join_on_session(left, right)


@register("lookup_calendar", oracle("t_queries", "t_calendar", body="SELECT sid, CAST(max_temp AS INT) AS max_temp, "
    "CAST(min_temp AS INT) AS min_temp, CAST(wind AS INT) AS wind, "
    + ", ".join(f"CASE WHEN weather = '{w}' THEN 1 ELSE 0 END AS weather_{w}" for w in WEATHER)
    + " FROM t_queries JOIN t_calendar ON md = strftime(req_time, '%m-%d')"))
def _(spark, d):
    dated = clock.clock_features(B.queries_table(spark, d)).select("sid", "req_date")
    return context.add_weather(dated, B.calendar_table(spark, d)).drop("req_date")


@register("lookup_holiday", oracle("t_queries", body="""SELECT sid, CASE WHEN month(req_time) = 10 AND day(req_time) <= 7
    THEN 1 ELSE 0 END AS is_holiday FROM t_queries"""))
def _(spark, d):
    dated = clock.clock_features(B.queries_table(spark, d)).select("sid", "req_date")
    return context.add_holiday(dated, B.holidays_table(spark, d)).drop("req_date")


NEAREST_SQL = """places AS (SELECT DISTINCT o_long, o_lat FROM t_coords),
    near AS (SELECT p.o_long, p.o_lat, min(sqrt((p.o_long - round(s.o_long, 2)) * (p.o_long - round(s.o_long, 2))
    + (p.o_lat - round(s.o_lat, 2)) * (p.o_lat - round(s.o_lat, 2)))) AS dist
    FROM places p CROSS JOIN (SELECT DISTINCT o_long, o_lat FROM t_stations) s GROUP BY p.o_long, p.o_lat)"""


@register("nearest_station", oracle("t_coords", "t_stations", body=f"""WITH {NEAREST_SQL}
    SELECT sid, round(dist * 10.0, 3) AS dist_nearest_sub FROM t_coords JOIN near USING (o_long, o_lat)"""))
def _(spark, d):
    found = context.add_nearest_station(coords_of(spark, d).select("sid", "o_long", "o_lat"), B.stations_table(spark, d))
    return found.select("sid", "dist_nearest_sub")


@register("nearest_district", oracle("t_coords", "t_districts", body="""WITH pairs AS (
    SELECT sid, idx, sqrt((c.o_long - t.o_long) * (c.o_long - t.o_long) + (c.o_lat - t.o_lat) * (c.o_lat - t.o_lat)) AS od,
    sqrt((d_long - t.o_long) * (d_long - t.o_long) + (d_lat - t.o_lat) * (d_lat - t.o_lat)) AS dd
    FROM t_coords c CROSS JOIN t_districts t)
    SELECT sid, 'o_district_' || CAST(min(idx) FILTER (WHERE od = mo) AS VARCHAR) AS o_district,
    'd_district_' || CAST(min(idx) FILTER (WHERE dd = mdd) AS VARCHAR) AS d_district
    FROM (SELECT *, min(od) OVER (PARTITION BY sid) AS mo, min(dd) OVER (PARTITION BY sid) AS mdd FROM pairs) GROUP BY sid"""))
def _(spark, d):
    return context.add_districts(coords_of(spark, d), B.districts_table(spark, d)).select("sid", "o_district", "d_district")


@register("district_code", oracle("t_coords", "t_districts", body="""WITH pairs AS (
    SELECT sid, idx, sqrt((c.o_long - t.o_long) * (c.o_long - t.o_long) + (c.o_lat - t.o_lat) * (c.o_lat - t.o_lat)) AS od
    FROM t_coords c CROSS JOIN t_districts t)
    SELECT sid, CAST(min(idx) FILTER (WHERE od = mo) AS INT) AS code, CAST(NULL AS INT) AS none
    FROM (SELECT *, min(od) OVER (PARTITION BY sid) AS mo FROM pairs) GROUP BY sid"""))
def _(spark, d):
    labelled = context.add_districts(coords_of(spark, d), B.districts_table(spark, d))
    return labelled.select("sid", encode.district_code(F.col("o_district")).alias("code"), encode.district_code(F.lit("unknown")).alias("none"))


@register("district_distances", oracle("t_coords", "t_districts", body="SELECT sid, " + ", ".join(
    f"round(max(CASE WHEN idx = {i} THEN sqrt((c.o_long - t.o_long) * (c.o_long - t.o_long) "
    f"+ (c.o_lat - t.o_lat) * (c.o_lat - t.o_lat)) END), 6) AS o_distance_{i}" for i in range(16))
    + " FROM t_coords c CROSS JOIN t_districts t GROUP BY sid"))
def _(spark, d):
    places = context.centres(B.districts_table(spark, d))
    cols = context.district_distances(F.col("o_long"), F.col("o_lat"), places)
    return rounded(coords_of(spark, d).withColumns(cols).select("sid", *cols), cols)


@register("bind_columns", oracle("t_coords", body="""SELECT sid, o_long, CAST(hour(req_time) AS INT) AS hour,
    CAST(month(req_time) AS INT) AS month FROM t_coords"""))
def _(spark, d):
    base = coords_of(spark, d)
    return joins.bind_columns(base.select("sid", "o_long"), base.select("sid", F.hour("req_time").alias("hour")),
                              base.select("sid", F.month("req_time").alias("month")))


@register("join_many_on_sid", oracle("t_queries", "t_clicks", "t_sessions", body="""SELECT q.sid, (q.sid * 7) % 11 AS prob_a,
    CAST(click_mode AS BIGINT) AS prob_b, (q.sid * 5) % 13 AS prob_c FROM t_queries q JOIN t_clicks USING (sid)
    JOIN t_sessions USING (sid)"""))
def _(spark, d):
    return joins.join_many({
        "a": B.queries_table(spark, d).selectExpr("sid", "(sid * 7) % 11 AS prob"),
        "b": B.clicks_table(spark, d).selectExpr("sid", "CAST(click_mode AS BIGINT) AS prob"),
        "c": B.plans_table(spark, d).selectExpr("sid", "(sid * 5) % 13 AS prob"),
    })


@register("join_sid_list", oracle("t_clicks", "t_rows", body="""SELECT c.sid, pos, transport_mode FROM t_clicks c
    LEFT JOIN t_rows r ON c.sid = r.sid"""))
def _(spark, d):
    rows = B.plan_rows_table(spark, d).select("sid", "pos", "transport_mode")
    return joins.listed_sessions(B.clicks_table(spark, d).select("sid"), rows)


@register("patch_from_other", oracle("t_queries", "t_clicks", body="""SELECT q.sid, CASE WHEN q.sid % 4 = 0
    THEN CAST(coalesce(click_mode, 0) AS BIGINT) ELSE q.sid % 4 END AS prediction FROM t_queries q LEFT JOIN t_clicks c USING (sid)"""))
def _(spark, d):
    base = B.queries_table(spark, d).selectExpr("sid", "sid % 4 AS prediction")
    other = B.clicks_table(spark, d).selectExpr("sid", "CAST(click_mode AS BIGINT) AS prediction")
    return joins.patch_predictions(base, other)
