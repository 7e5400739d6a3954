"""Row-local features: coordinates, clock, encodings, plan lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfold import bindings as B
from wayfold.bindings import oracle
from wayfold.catalog import register
from wayfold.functions import clock, coords, encode, planlists
from wayfold.operators import ranks
from wayfold.schemas import MODES, PROFILE_COLUMNS, WEATHER


def coords_of(spark, d):
    return coords.split_coords(B.queries_table(spark, d))


def lists_of(spark, d):
    """Plans table with the parsed array in place of the text."""
    return B.plans_table(spark, d).withColumn("plans", planlists.parse_plans(F.col("plans")))


def rounded(df, names, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in names})


@register("coords_split", oracle("t_coords", body="SELECT * FROM t_coords"))
def _(spark, d):
    return coords_of(spark, d)


@register("dist_planar", oracle("t_coords", body="""SELECT sid, round(sqrt((o_long - d_long) * (o_long - d_long)
    + (o_lat - d_lat) * (o_lat - d_lat)), 6) AS dist FROM t_coords"""))
def _(spark, d):
    dist = coords.planar(F.col("o_long"), F.col("o_lat"), F.col("d_long"), F.col("d_lat"))
    return coords_of(spark, d).select("sid", F.round(dist, 6).alias("dist"))


@register("dist_geodesic", oracle("t_coords", body=f"""SELECT sid, round({2 * coords.EARTH_KM} * asin(least(1.0, sqrt(
    pow(sin(radians(d_lat - o_lat) / 2), 2) + cos(radians(o_lat)) * cos(radians(d_lat))
    * pow(sin(radians(d_long - o_long) / 2), 2)))), 6) AS km FROM t_coords"""))
def _(spark, d):
    km = coords.great_circle_km(F.col("o_long"), F.col("o_lat"), F.col("d_long"), F.col("d_lat"))
    return coords_of(spark, d).select("sid", F.round(km, 6).alias("km"))


@register("cast_types", oracle("t_listed", body="""SELECT sid, pos, TRY_CAST(price AS INT) AS price,
    CAST(distance AS DOUBLE) AS distance, CAST(CAST(sid AS VARCHAR) AS BIGINT) AS sid_again FROM t_listed"""))
def _(spark, d):
    rows = lists_of(spark, d).select("sid", F.posexplode("plans").alias("pos", "p"))
    return rows.select("sid", "pos", encode.number(F.col("p.price"), "int").alias("price"),
                       encode.number(F.col("p.distance").cast("string")).alias("distance"),
                       encode.number(F.col("sid").cast("string"), "bigint").alias("sid_again"))


@register("time_basic", oracle("t_queries", body="""SELECT sid, CAST(isodow(req_time) - 1 AS INT) AS weekday,
    CAST(hour(req_time) AS INT) AS hour FROM t_queries"""))
def _(spark, d):
    return clock.weekday_hour(B.queries_table(spark, d)).select("sid", "weekday", "hour")


def _clock_sql(kind, source):
    return oracle(source, body=f"""SELECT sid, strftime({kind}_time, '%m-%d') AS {kind}_date,
        CAST(hour({kind}_time) AS INT) AS {kind}_hour,
        CAST(isodow({kind}_time) IN (5, 6) AS INT) AS {kind}_weekend,
        CAST(hour({kind}_time) <= 7 AS INT) AS {kind}_night,
        CAST(hour({kind}_time) BETWEEN 8 AND 17 AS INT) AS {kind}_day,
        CAST(hour({kind}_time) >= 19 AS INT) AS {kind}_evening FROM {source}""")


@register("time_features", _clock_sql("req", "t_queries"))
def _(spark, d):
    return clock.clock_features(B.queries_table(spark, d), "req").drop("pid", "req_time", "o", "d")


@register("time_features_click", _clock_sql("click", "t_clicks"))
def _(spark, d):
    return clock.clock_features(B.clicks_table(spark, d), "click").drop("click_time", "click_mode")


@register("time_features_plan", _clock_sql("plan", "t_sessions"))
def _(spark, d):
    return clock.clock_features(B.plans_table(spark, d), "plan").drop("plan_time", "plans")


@register("hour_bin", oracle("t_queries", body="""SELECT sid, CASE WHEN hour(req_time) <= 7 THEN 'night'
    WHEN hour(req_time) <= 17 THEN 'day' ELSE 'evening' END AS part FROM t_queries"""))
def _(spark, d):
    return B.queries_table(spark, d).select("sid", clock.part_of_day(F.hour("req_time")).alias("part"))


@register("time_parts", oracle("t_queries", body="""SELECT sid, CAST(month(req_time) AS INT) AS month,
    CAST(day(req_time) AS INT) AS day, CAST(minute(req_time) AS INT) AS minute, dayname(req_time) AS day_name
    FROM t_queries"""))
def _(spark, d):
    return B.queries_table(spark, d).select(
        "sid", F.month("req_time").alias("month"), F.day("req_time").alias("day"),
        F.minute("req_time").alias("minute"), F.date_format("req_time", "EEEE").alias("day_name"))


@register("day_ordinal", oracle("t_queries", body="""SELECT sid, CAST(day(req_time) + 30 * (month(req_time) - 10) AS INT)
    AS ordinal FROM t_queries"""))
def _(spark, d):
    text = F.col("req_time").cast("string")
    return B.queries_table(spark, d).select("sid", clock.day_number(text, 10).alias("ordinal"))


@register("day_request", oracle("t_queries", body="""SELECT sid, CAST(hour(req_time) >= 6 AND hour(req_time) < 22 AS INT)
    AS is_day FROM t_queries"""))
def _(spark, d):
    return B.queries_table(spark, d).select("sid", clock.daytime_request(F.col("req_time")).cast("int").alias("is_day"))


@register("one_hot", oracle("t_clicks", body="SELECT sid, click_mode, " + ", ".join(
    f"CAST(click_mode = {m} AS INT) AS click_mode_{m}" for m in range(1, 12)) + " FROM t_clicks"))
def _(spark, d):
    return encode.one_hot(B.clicks_table(spark, d).drop("click_time"), "click_mode")


@register("weather_one_hot", oracle("t_calendar", body="SELECT md, " + ", ".join(
    f"CASE WHEN weather = '{w}' THEN 1 ELSE 0 END AS weather_{w}" for w in WEATHER) + " FROM t_calendar"))
def _(spark, d):
    return encode.one_hot(B.calendar_table(spark, d).select("md", "weather"), "weather", WEATHER).drop("weather")


@register("label_response", oracle("t_queries", "t_clicks", body="""SELECT q.sid, coalesce(c.click_mode, 0) AS click_mode,
    coalesce(c.click_mode, 0) AS "Response" FROM t_queries q LEFT JOIN t_clicks c USING (sid)"""))
def _(spark, d):
    joined = B.queries_table(spark, d).select("sid").join(B.clicks_table(spark, d).drop("click_time"), "sid", "left")
    return encode.label_response(joined)


@register("label_shift", oracle("t_queries", "t_clicks", body="""SELECT sid, CAST(click_mode - 1 AS INT) AS click_mode
    FROM t_queries JOIN t_clicks USING (sid)"""))
def _(spark, d):
    joined = B.queries_table(spark, d).select("sid").join(B.clicks_table(spark, d).drop("click_time"), "sid", "left")
    return encode.label_shift(encode.label_response(joined)).drop("Response")


@register("rank_target", oracle("t_rows", "t_clicks", body="""SELECT sid, pos, transport_mode,
    CASE WHEN click_mode = transport_mode THEN 3 ELSE 0 END AS target,
    CASE WHEN click_mode = transport_mode THEN 1 ELSE 0 END AS relevant FROM t_rows LEFT JOIN t_clicks USING (sid)"""))
def _(spark, d):
    rows = B.plan_rows_table(spark, d).select("sid", "pos", "transport_mode")
    joined = rows.join(B.clicks_table(spark, d).select("sid", "click_mode"), "sid", "left")
    clicked, mode = F.col("click_mode"), F.col("transport_mode")
    return joined.select("sid", "pos", "transport_mode", encode.rank_target(clicked, mode).alias("target"),
                         encode.rank_target(clicked, mode, 1).alias("relevant"))


@register("select_features", oracle("t_profiles", body="SELECT pid, p60, p61, p62, p63, p65 FROM t_profiles"))
def _(spark, d):
    return encode.select_features(B.profiles_table(spark, d), drop=["p64"], drop_range=("p0", "p59"))


@register("rename_map", oracle("t_calendar", "t_rows", body="""SELECT sid, pos, distance AS distance_plan, eta AS plan_eta,
    price AS plan_price FROM t_rows"""))
def _(spark, d):
    rows = B.plan_rows_table(spark, d).drop("transport_mode")
    return encode.rename_prefixed(encode.rename(rows, {"distance": "distance_plan"}), ["eta", "price"], "plan_")


@register("fill_const", oracle("t_queries", "t_clicks", body="""SELECT q.sid, coalesce(pid, -1) AS pid,
    coalesce(click_mode, 0) AS click_mode FROM t_queries q LEFT JOIN t_clicks c USING (sid)"""))
def _(spark, d):
    joined = B.queries_table(spark, d).select("sid", "pid").join(
        B.clicks_table(spark, d).select("sid", "click_mode"), "sid", "left")
    return joined.fillna({"pid": -1, "click_mode": 0})


@register("fill_median", oracle("t_rows", body="""SELECT sid, pos, transport_mode, distance, eta,
    coalesce(CAST(TRY_CAST(price AS INT) AS DOUBLE), (SELECT median(TRY_CAST(price AS INT)) FROM t_rows)) AS price
    FROM t_rows"""))
def _(spark, d):
    rows = B.plan_rows_table(spark, d).withColumn("price", encode.number(F.col("price"), "int"))
    return ranks.fill_median(rows, "price")


_OVERWRITTEN = ", ".join(f"CASE WHEN p0 = 0 THEN -1 ELSE {c} END AS {c}" for c in PROFILE_COLUMNS[1:])


@register("overwrite_range", oracle("t_profiles", body=f"SELECT pid, {_OVERWRITTEN} FROM t_profiles"))
def _(spark, d):
    df = B.profiles_table(spark, d)
    return encode.overwrite_where(df, F.col("p0") == 0, encode.column_range(df, PROFILE_COLUMNS[1], PROFILE_COLUMNS[-1])).drop("p0")


_VALUE = {"dist": "distance", "price": "CASE WHEN pos IS NULL THEN NULL ELSE coalesce(TRY_CAST(price AS INT), 0) END", "eta": "eta"}
STATS_SQL = ", ".join(
    f"CAST(coalesce(max({v}), -1) AS INT) AS max_{k}, CAST(coalesce(min({v}), -1) AS INT) AS min_{k}, "
    f"round(coalesce(avg({v}), -1), 6) AS mean_{k}, round(coalesce(stddev_pop({v}), -1), 6) AS std_{k}"
    for k, v in _VALUE.items())
ARGS_SQL = ", ".join(
    f"coalesce(arg_max(transport_mode, CAST({v} AS BIGINT) * 100 + pos), -1) AS max_{k}_mode, "
    f"coalesce(arg_min(transport_mode, CAST({v} AS BIGINT) * 100 + pos), -1) AS min_{k}_mode"
    for k, v in _VALUE.items())
FLAGS_SQL = "CAST(count(pos) = 0 AS INT) AS mode_0_available, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE transport_mode = {m}) > 0 AS INT) AS mode_{m}_available" for m in MODES[1:])


def wide_sql(pick, missing, modes=MODES, absent="0"):
    """The wide columns as aggregates over the listed plans of one session."""
    out = []
    for m in modes:
        only = f"FILTER (WHERE transport_mode = {m})"
        price = f"CASE WHEN coalesce(TRY_CAST(price AS INT), 0) = 0 THEN {missing} ELSE TRY_CAST(price AS INT) END"
        out.append(f"CAST(coalesce({pick}(distance, pos) {only}, {absent}) AS INT) AS dist_{m}")
        price_of = f"list({price} ORDER BY pos {'DESC' if pick == 'arg_max' else 'ASC'}) {only}"
        out.append(f"CAST(coalesce(({price_of})[1], {absent}) AS INT) AS price_{m}")
        out.append(f"CAST(coalesce({pick}(eta, pos) {only}, {absent}) AS INT) AS eta_{m}")
    return ", ".join(out)


def per_session_sql(expressions):
    return oracle("t_sessions", "t_listed", body=f"""SELECT s.sid, {expressions} FROM t_sessions s
        LEFT JOIN t_listed l ON s.sid = l.sid GROUP BY s.sid""")


@register("plan_stats", per_session_sql(STATS_SQL))
def _(spark, d):
    df = planlists.summarize(lists_of(spark, d), arg_modes=False).drop("plans", "plan_time")
    return rounded(df, [c for c in df.columns if c.startswith(("mean", "std"))])


@register("plan_arg_modes", per_session_sql(ARGS_SQL))
def _(spark, d):
    return planlists.summarize(lists_of(spark, d), stats=False).drop("plans", "plan_time")


@register("plan_first_mode", per_session_sql("coalesce(arg_min(transport_mode, pos), 0) AS first_mode"))
def _(spark, d):
    return lists_of(spark, d).select("sid", planlists.first_mode(F.col("plans")).alias("first_mode"))


@register("mode_flags", per_session_sql(FLAGS_SQL))
def _(spark, d):
    return planlists.add_mode_flags(lists_of(spark, d)).drop("plans", "plan_time")


@register("wide_last_wins", per_session_sql(wide_sql("arg_max", "700")))
def _(spark, d):
    return planlists.wide(lists_of(spark, d), keep="last", missing_price=700).drop("plans", "plan_time")


@register("wide_first_wins", per_session_sql(wide_sql("arg_min", "99999")))
def _(spark, d):
    return planlists.wide(lists_of(spark, d), keep="first", missing_price=99999).drop("plans", "plan_time")


@register("wide_nullable", per_session_sql(wide_sql("arg_min", "NULL", MODES[1:], "NULL")))
def _(spark, d):
    return planlists.wide(lists_of(spark, d), keep="first", missing_price=None, modes=MODES[1:],
                          absent=None).drop("plans", "plan_time")


@register("plans_parse", oracle("t_sessions", "t_listed", body="""SELECT s.sid, CAST(count(l.pos) AS INT) AS n,
    CAST(coalesce(sum(distance), 0) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE price = '') AS INT) AS empty_prices
    FROM t_sessions s LEFT JOIN t_listed l ON s.sid = l.sid GROUP BY s.sid"""))
def _(spark, d):
    plans = F.col("plans")
    return lists_of(spark, d).select(
        "sid", F.size(plans).alias("n"),
        F.aggregate(plans, F.lit(0).cast("bigint"), lambda a, p: a + p["distance"]).alias("total"),
        F.size(F.filter(plans, lambda p: p["price"] == "")).alias("empty_prices"))


@register("plans_explode", oracle("t_listed", body="""SELECT l.sid, pos, distance AS distance_plan, eta, transport_mode,
    coalesce(TRY_CAST(price AS INT), -1) AS price FROM t_listed l"""))
def _(spark, d):
    return planlists.unfold(lists_of(spark, d).drop("plan_time"), missing_price=-1)


@register("display_order", oracle("t_listed", body="SELECT sid, transport_mode, CAST(pos + 1 AS INT) AS shown_at FROM t_listed"))
def _(spark, d):
    rows = planlists.unfold(lists_of(spark, d))
    return rows.select("sid", "transport_mode", (F.col("pos") + 1).alias("shown_at"))


@register("mode_document", per_session_sql(
    "coalesce(string_agg('word_' || CAST(transport_mode AS VARCHAR), ' ' ORDER BY pos), 'word_null') AS document"))
def _(spark, d):
    return lists_of(spark, d).select("sid", F.array_join(planlists.mode_words(F.col("plans")), " ").alias("document"))
