"""The composed feature tables."""

from __future__ import annotations

from wayfold import bindings as B
from wayfold.bindings import oracle
from wayfold.catalog import register
from wayfold.catalog.joining import NEAREST_SQL
from wayfold.catalog.scalars import ARGS_SQL, FLAGS_SQL, STATS_SQL, rounded, wide_sql
from wayfold.plans import features
from wayfold.schemas import PROFILE_COLUMNS, WEATHER

_MEANS = [f"{f}_{k}" for f in ("mean", "std") for k in ("dist", "price", "eta")]
_LISTS = f"""per AS (SELECT a.sid, {STATS_SQL}, {ARGS_SQL}, coalesce(arg_min(transport_mode, pos), 0) AS first_mode, {FLAGS_SQL},
    %s FROM (SELECT sid FROM t_queries UNION SELECT sid FROM t_sessions) a LEFT JOIN t_listed l ON a.sid = l.sid GROUP BY a.sid)"""
_PROFILE = ", ".join(f"CASE WHEN c.sid IS NULL THEN NULL WHEN c.pid IS NULL THEN -1 ELSE p.{c} END AS {c}" for c in PROFILE_COLUMNS)


def col_sql(keep: str) -> str:
    wide = wide_sql("arg_max", "700") if keep == "last" else wide_sql("arg_min", "99999")
    return oracle("t_coords", "t_sessions", "t_listed", "t_clicks", "t_profiles", body=f"""WITH {_LISTS % wide}
        SELECT per.*, CASE WHEN c.sid IS NOT NULL THEN coalesce(c.pid, -1) END AS pid, c.req_time, c.o_long, c.o_lat, c.d_long,
        c.d_lat, CAST(isodow(c.req_time) - 1 AS INT) AS weekday, CAST(hour(c.req_time) AS INT) AS hour, s.plan_time,
        CASE WHEN c.sid IS NOT NULL THEN k.click_time END AS click_time,
        CASE WHEN c.sid IS NOT NULL THEN coalesce(k.click_mode, 0) ELSE 0 END AS click_mode,
        CASE WHEN c.sid IS NOT NULL THEN coalesce(k.click_mode, 0) ELSE 0 END AS "Response", {_PROFILE}
        FROM per LEFT JOIN t_coords c ON per.sid = c.sid LEFT JOIN t_sessions s ON per.sid = s.sid
        LEFT JOIN t_clicks k ON per.sid = k.sid LEFT JOIN t_profiles p ON c.pid = p.pid""")


def _raw(spark, d):
    return B.queries_table(spark, d), B.plans_table(spark, d), B.clicks_table(spark, d), B.profiles_table(spark, d)


@register("features_col", col_sql("last"))
def _(spark, d):
    return rounded(features.features_col(*_raw(spark, d)), _MEANS)


@register("features_col_first", col_sql("first"))
def _(spark, d):
    return rounded(features.features_col(*_raw(spark, d), keep="first"), _MEANS)


@register("features_row", oracle("t_coords", "t_sessions", "t_listed", "t_clicks", "t_profiles", body=f"""
    WITH {_LISTS % '1 AS one'}, rows AS (SELECT per.* EXCLUDE (one), coalesce(c.pid, -1) AS pid, c.req_time, c.o_long, c.o_lat, c.d_long, c.d_lat,
    CAST(isodow(c.req_time) - 1 AS INT) AS weekday, CAST(hour(c.req_time) AS INT) AS hour, s.plan_time, k.click_time,
    coalesce(k.click_mode, 0) AS click_mode, coalesce(k.click_mode, 0) AS "Response", {_PROFILE}, l.pos, l.transport_mode,
    l.distance AS distance_plan, l.eta, TRY_CAST(l.price AS INT) AS raw_price
    FROM t_listed l JOIN per ON per.sid = l.sid JOIN t_coords c ON l.sid = c.sid JOIN t_sessions s ON l.sid = s.sid
    LEFT JOIN t_clicks k ON l.sid = k.sid LEFT JOIN t_profiles p ON c.pid = p.pid WHERE c.pid IS NULL OR p.pid IS NOT NULL)
    SELECT * EXCLUDE (raw_price), CAST(coalesce(raw_price, (SELECT median(raw_price) FROM rows)) AS DOUBLE) AS price FROM rows"""))
def _(spark, d):
    return rounded(features.features_row(*_raw(spark, d)), _MEANS)


_EXTERNAL = f"""{NEAREST_SQL}, pairs AS (SELECT sid, idx, sqrt((c.o_long - t.o_long) * (c.o_long - t.o_long)
    + (c.o_lat - t.o_lat) * (c.o_lat - t.o_lat)) AS od,
    sqrt((d_long - t.o_long) * (d_long - t.o_long) + (d_lat - t.o_lat) * (d_lat - t.o_lat)) AS dd
    FROM t_coords c CROSS JOIN t_districts t),
    best AS (SELECT *, min(od) OVER (PARTITION BY sid) AS mo, min(dd) OVER (PARTITION BY sid) AS mdd FROM pairs),
    placed AS (SELECT sid, min(idx) FILTER (WHERE od = mo) AS oi, min(idx) FILTER (WHERE dd = mdd) AS di,
    {', '.join(f'round(max(CASE WHEN idx = {i} THEN od END), 6) AS o_distance_{i}' for i in range(16))} FROM best GROUP BY sid),
    external AS (SELECT c.sid, c.pid, c.req_time, c.o_long, c.o_lat, c.d_long, c.d_lat, round(dist * 10.0, 3) AS dist_nearest_sub,
    md AS req_date, CAST(hour(req_time) AS INT) AS req_hour, CAST(isodow(req_time) IN (5, 6) AS INT) AS req_weekend,
    CAST(hour(req_time) <= 7 AS INT) AS req_night, CAST(hour(req_time) BETWEEN 8 AND 17 AS INT) AS req_day,
    CAST(hour(req_time) >= 19 AS INT) AS req_evening,
    CASE WHEN md BETWEEN '10-01' AND '10-07' THEN 1 ELSE 0 END AS is_holiday, CAST(max_temp AS INT) AS max_temp,
    CAST(min_temp AS INT) AS min_temp, CAST(wind AS INT) AS wind,
    {', '.join(f"CASE WHEN weather = '{w}' THEN 1 ELSE 0 END AS weather_{w}" for w in WEATHER)},
    'o_district_' || CAST(oi AS VARCHAR) AS o_district, 'd_district_' || CAST(di AS VARCHAR) AS d_district,
    {', '.join(f"CAST({e}i = {i} AS INT) AS {e}_district_{i}" for e in 'od' for i in range(16))},
    {', '.join(f'o_distance_{i}' for i in range(16))}
    FROM t_coords c JOIN near USING (o_long, o_lat) JOIN placed USING (sid) JOIN t_calendar ON md = strftime(req_time, '%m-%d'))"""
_DISTANCES = [f"o_distance_{i}" for i in range(16)]


def _external(spark, d):
    df = features.features_external(B.queries_table(spark, d), B.stations_table(spark, d), B.holidays_table(spark, d),
                                    B.calendar_table(spark, d), B.districts_table(spark, d))
    return rounded(df, _DISTANCES)


@register("features_external", oracle("t_coords", "t_stations", "t_districts", "t_calendar",
                                      body=f"WITH {_EXTERNAL} SELECT * FROM external"))
def _(spark, d):
    return _external(spark, d)


@register("features_all", oracle("t_coords", "t_sessions", "t_listed", "t_clicks", "t_profiles", "t_stations", "t_districts",
                                 "t_calendar", body=f"""WITH {_EXTERNAL}, {_LISTS % wide_sql("arg_max", "700")}
    SELECT external.* EXCLUDE (pid), coalesce(external.pid, -1) AS pid, per.* EXCLUDE (sid), s.plan_time, k.click_time,
    CAST(isodow(c.req_time) - 1 AS INT) AS weekday, CAST(hour(c.req_time) AS INT) AS hour,
    coalesce(k.click_mode, 0) AS click_mode, coalesce(k.click_mode, 0) AS "Response", {_PROFILE}
    FROM external JOIN per ON per.sid = external.sid JOIN t_coords c ON c.sid = external.sid
    LEFT JOIN t_sessions s ON s.sid = c.sid LEFT JOIN t_clicks k ON k.sid = c.sid LEFT JOIN t_profiles p ON p.pid = c.pid"""))
def _(spark, d):
    raw = rounded(features.features_col(*_raw(spark, d)), _MEANS)
    return features.features_all(raw, _external(spark, d))


@register("features_col_components")
def _(spark, d):
    table = features.features_col(*_raw(spark, d), components=True, share=0.8, digits=6)
    parts = [c for c in table.columns if c.startswith(("PID_MainComp", "TFIDF_clustered"))]
    return table.select("sid", "split", *parts)
