"""Counts, distributions, profiles of columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfold import bindings as B
from wayfold.bindings import oracle
from wayfold.catalog import register
from wayfold.catalog.joining import _with_clicks
from wayfold.catalog.scalars import coords_of, rounded
from wayfold.operators import context, summaries
from wayfold.schemas import MODES


@register("count_by_mode", oracle("t_clicks", body="SELECT click_mode, count(*) AS n FROM t_clicks GROUP BY click_mode"))
def _(spark, d):
    return summaries.counts(B.clicks_table(spark, d), "click_mode")


@register("user_activity", oracle("t_queries", body="""SELECT count(*) AS users, CAST(sum(n) AS BIGINT) AS rows,
    round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std, min(n) AS min, quantile_cont(n, 0.25) AS q25,
    quantile_cont(n, 0.5) AS q50, quantile_cont(n, 0.75) AS q75, max(n) AS max,
    CAST(count(*) FILTER (WHERE n < 5) AS BIGINT) AS few FROM (
    SELECT pid, count(*) AS n FROM t_queries WHERE pid IS NOT NULL GROUP BY pid)"""))
def _(spark, d):
    return rounded(summaries.activity(B.queries_table(spark, d)), ["mean", "std"])


_DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount"]


@register("describe_numeric", " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean,
    round(stddev_samp({c}), 6) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
    round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS max FROM lineitem"""
    for c in _DESCRIBED))
def _(spark, d):
    return rounded(summaries.describe(B.table(spark, d, "lineitem"), _DESCRIBED), ["mean", "std", "q25", "q50", "q75"])


@register("null_profile", oracle("t_queries", "t_clicks", body=" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls,
    round((count(*) - count({c})) * 100.0 / count(*), 6) AS percent FROM (SELECT q.sid, pid, req_time, click_mode
    FROM t_queries q LEFT JOIN t_clicks USING (sid))""" for c in ("sid", "pid", "req_time", "click_mode"))))
def _(spark, d):
    joined = B.queries_table(spark, d).select("sid", "pid", "req_time").join(
        B.clicks_table(spark, d).select("sid", "click_mode"), "sid", "left")
    return rounded(summaries.null_profile(joined), ["percent"])


@register("distinct_counts", oracle("t_rows", body=" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_unique FROM t_rows""" for c in ("sid", "transport_mode", "distance"))))
def _(spark, d):
    return summaries.distinct_counts(B.plan_rows_table(spark, d), ["sid", "transport_mode", "distance"])


@register("user_mode_counts", oracle("t_queries", "t_clicks", body="SELECT coalesce(pid, -1) AS pid, " + ", ".join(
    f"CASE WHEN pid IS NULL THEN -1 ELSE count(*) FILTER (WHERE click_mode = {m}) END AS click_mode_{m}" for m in MODES[1:])
    + " FROM t_queries JOIN t_clicks USING (sid) GROUP BY pid"))
def _(spark, d):
    return summaries.user_mode_counts(_with_clicks(spark, d), MODES[1:])


@register("demand_by_day", oracle("t_queries", body="""SELECT CAST(req_time AS DATE) AS day, count(*) AS n FROM t_queries
    GROUP BY 1"""))
def _(spark, d):
    return summaries.demand_by_day(B.queries_table(spark, d))


@register("demand_by_weekday", oracle("t_queries", body="""SELECT CAST(isodow(day) - 1 AS INT) AS weekday, round(avg(n), 6) AS mean
    FROM (SELECT CAST(req_time AS DATE) AS day, count(*) AS n FROM t_queries GROUP BY 1) GROUP BY 1"""))
def _(spark, d):
    return rounded(summaries.demand_by_weekday(B.queries_table(spark, d)), ["mean"])


@register("demand_by_part", oracle("t_queries", body="""SELECT 'weekday' AS kind, dayname(req_time) AS value, count(*) AS n
    FROM t_queries GROUP BY 2 UNION ALL SELECT 'hour', CAST(hour(req_time) AS VARCHAR), count(*) FROM t_queries GROUP BY 2
    UNION ALL SELECT 'part', CASE WHEN hour(req_time) <= 7 THEN 'night' WHEN hour(req_time) <= 17 THEN 'day' ELSE 'evening' END,
    count(*) FROM t_queries GROUP BY 2"""))
def _(spark, d):
    return summaries.demand_by_part(B.queries_table(spark, d))


@register("group_sizes", oracle("t_rows", body="SELECT sid, count(*) AS n FROM t_rows GROUP BY sid"))
def _(spark, d):
    return summaries.session_sizes(B.plan_rows_table(spark, d))


@register("label_per_session", oracle("t_rows", "t_clicks", body="""SELECT DISTINCT sid, click_mode FROM t_rows
    JOIN t_clicks USING (sid)"""))
def _(spark, d):
    rows = B.plan_rows_table(spark, d).select("sid")
    return summaries.label_per_session(rows.join(B.clicks_table(spark, d).select("sid", "click_mode"), "sid"))


_DISTRICTS_SQL = """pairs AS (SELECT sid, idx, sqrt((c.o_long - t.o_long) * (c.o_long - t.o_long)
    + (c.o_lat - t.o_lat) * (c.o_lat - t.o_lat)) AS od,
    sqrt((d_long - t.o_long) * (d_long - t.o_long) + (d_lat - t.o_lat) * (d_lat - t.o_lat)) AS dd
    FROM t_coords c CROSS JOIN t_districts t),
    best AS (SELECT *, min(od) OVER (PARTITION BY sid) AS mo, min(dd) OVER (PARTITION BY sid) AS mdd FROM pairs),
    placed AS (SELECT sid, min(idx) FILTER (WHERE od = mo) AS o_district, min(idx) FILTER (WHERE dd = mdd) AS d_district
    FROM best GROUP BY sid)"""


@register("mode_by_district", oracle("t_coords", "t_districts", "t_clicks", body=f"""WITH {_DISTRICTS_SQL}
    SELECT click_mode, 'o_district_' || CAST(o_district AS VARCHAR) AS o_district,
    'd_district_' || CAST(d_district AS VARCHAR) AS d_district, CAST(count(*) AS BIGINT) AS n
    FROM placed JOIN t_clicks USING (sid) GROUP BY CUBE (click_mode, o_district, d_district)"""))
def _(spark, d):
    placed = context.add_districts(coords_of(spark, d), B.districts_table(spark, d)).select("sid", "o_district", "d_district")
    clicks = B.clicks_table(spark, d).select("sid", "click_mode")
    return summaries.mode_by_district(placed.join(clicks, "sid"), totals=True)


@register("category_freq", oracle("t_calendar", body="""SELECT weather, wind, count(*) AS n FROM t_calendar
    GROUP BY weather, wind"""))
def _(spark, d):
    return summaries.counts(B.calendar_table(spark, d), "weather", "wind")


@register("cluster_members", oracle("t_profiles", body="""SELECT pid % 3 AS cluster, CAST(floor(pid / 1000) AS BIGINT) AS block,
    string_agg(CAST(pid AS VARCHAR), ',' ORDER BY pid) AS members FROM t_profiles GROUP BY 1, 2"""))
def _(spark, d):
    labelled = B.profiles_table(spark, d).selectExpr("pid", "pid % 3 AS cluster")
    found = summaries.cluster_members(labelled)
    return found.withColumn("members", F.array_join(F.col("members").cast("array<string>"), ","))


_RUNS = """SELECT l_returnflag || l_linestatus AS model_type, 0.5 + l_tax + l_discount / 10 AS score FROM lineitem"""


@register("score_by_model", f"""SELECT model_type, count(*) AS runs, round(min(score), 9) AS min, round(quantile_cont(score, 0.25), 6) AS q25,
    round(quantile_cont(score, 0.5), 6) AS q50, round(quantile_cont(score, 0.75), 6) AS q75, round(max(score), 9) AS max
    FROM ({_RUNS}) GROUP BY model_type""")
def _(spark, d):
    runs = B.table(spark, d, "lineitem").selectExpr(
        "concat(l_returnflag, l_linestatus) AS model_type", "0.5D + l_tax + l_discount / 10 AS score")
    found = rounded(summaries.score_by_model(runs), ["q25", "q50", "q75"])
    return found.withColumns({c: F.round(c, 9) for c in ("min", "max")})
