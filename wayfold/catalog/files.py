"""Sources and sinks: every query writes files below the shared folder and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfold import bindings as B
from wayfold.bindings import SHOWN, oracle
from wayfold.catalog import register
from wayfold.operators import ranks
from wayfold.schemas import PROFILE_COLUMNS
from wayfold.session import scratch_path
from wayfold.sources import readers, writers


def _csv(df, path):
    df.write.option("header", "true").option("escape", '"').option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


@register("src_csv_tables", oracle("t_queries", "t_sessions", "t_clicks", "t_profiles", body="""
    SELECT q.sid, q.pid, req_time, o, d, plan_time, click_time, click_mode, """ + ", ".join(PROFILE_COLUMNS) + """
    FROM t_queries q LEFT JOIN t_sessions s ON q.sid = s.sid LEFT JOIN t_clicks c ON q.sid = c.sid
    LEFT JOIN t_profiles p ON q.pid = p.pid"""))
def _(spark, d):
    folder = scratch_path(spark, "csv")
    made = {"profiles": B.profiles_table, "queries": B.queries_table, "plans": B.plans_table, "clicks": B.clicks_table}
    for name, file in readers.TRAIN_FILES.items():
        _csv(made[name](spark, d), f"{folder}/{file}")
    t = readers.read_tables(spark, folder)
    joined = t["queries"].join(t["plans"].drop("plans"), "sid", "left").join(t["clicks"], "sid", "left")
    return joined.join(t["profiles"], "pid", "left")


@register("src_csv_plans", oracle("t_sessions", "t_listed", body="""SELECT s.sid, plan_time, transport_mode, distance, price, eta
    FROM t_sessions s JOIN t_listed l ON s.sid = l.sid"""))
def _(spark, d):
    from wayfold.functions.planlists import parse_plans
    path = scratch_path(spark, "plans")
    _csv(B.plans_table(spark, d), path)
    back = readers.read_csv(spark, path, readers.S.PLANS)
    return back.select("sid", "plan_time", F.inline(parse_plans(F.col("plans")))).select(
        "sid", "plan_time", "transport_mode", "distance", "price", "eta")


@register("src_json_calendar", oracle("t_calendar", body="SELECT md, max_temp, min_temp, weather, wind FROM t_calendar"))
def _(spark, d):
    path = scratch_path(spark, "weather")
    days = B.calendar_table(spark, d)
    # one object with a key per day of the year, hence at most 366 entries
    entry = F.concat(F.lit('"'), "md", F.lit('": '), F.to_json(F.struct("max_temp", "min_temp", "weather", "wind")))
    text = days.groupBy().agg(F.collect_list(entry).alias("e")).select(
        F.concat(F.lit("{"), F.array_join("e", ", "), F.lit("}")).alias("value"))
    text.write.text(path)
    return readers.read_calendar(spark, path)


@register("src_dims", oracle("t_stations", "t_districts", "t_calendar", body="""SELECT 'station' AS kind, subway_name AS name,
    round(o_lat, 2) AS lat, round(o_long, 2) AS long, NULL::INT AS idx FROM t_stations
    UNION ALL SELECT 'district', District, o_lat, o_long, CAST(row_number() OVER (ORDER BY idx) - 1 AS INT) FROM t_districts
    UNION ALL SELECT 'holiday', md, NULL, NULL, NULL FROM t_calendar WHERE md BETWEEN '10-01' AND '10-07'"""))
def _(spark, d):
    folder = scratch_path(spark, "dims")
    _csv(B.stations_table(spark, d), f"{folder}/stations")
    _csv(B.districts_table(spark, d).orderBy("idx").drop("idx"), f"{folder}/districts")
    _csv(B.holidays_table(spark, d).select(F.lit("national").alias("name"), "md"), f"{folder}/holidays")
    stations = readers.read_stations(spark, f"{folder}/stations").selectExpr(
        "'station' AS kind", "subway_name AS name", "o_lat AS lat", "o_long AS long", "CAST(NULL AS INT) AS idx")
    districts = readers.read_districts(spark, f"{folder}/districts").selectExpr(
        "'district' AS kind", "District AS name", "o_lat AS lat", "o_long AS long", "idx")
    holidays = readers.read_holidays(spark, f"{folder}/holidays").selectExpr(
        "'holiday' AS kind", "md AS name", "CAST(NULL AS DOUBLE) AS lat", "CAST(NULL AS DOUBLE) AS long", "CAST(NULL AS INT) AS idx")
    return stations.unionByName(districts).unionByName(holidays)


@register("sink_feature_table", oracle("t_queries", body="""SELECT sid, pid, CAST(hour(req_time) AS INT) AS hour FROM t_queries
    QUALIFY row_number() OVER (ORDER BY req_time, sid) > floor(0.8 * count(*) OVER ())"""))
def _(spark, d):
    path = scratch_path(spark, "features")
    table = ranks.split_by_time(B.queries_table(spark, d)).select("sid", "pid", F.hour("req_time").alias("hour"), "split")
    writers.write_feature_table(table, path)
    return readers.read_table(spark, path).where("split = 'test'").drop("split")


@register("sink_submission_csv", oracle("t_clicks", body="""SELECT sid, click_mode AS recommend_mode, 'header' AS kind FROM t_clicks
    UNION ALL SELECT sid, click_mode, 'plain' FROM t_clicks"""))
def _(spark, d):
    folder = scratch_path(spark, "submission")
    predicted = B.clicks_table(spark, d).select("sid", F.col("click_mode").alias("prediction"))
    writers.write_submission(predicted, f"{folder}/with", header=True)
    writers.write_submission(predicted, f"{folder}/without", header=False)
    named = readers.read_csv(spark, f"{folder}/with", "sid bigint, recommend_mode int")
    plain = spark.read.schema("sid bigint, recommend_mode int").csv(f"{folder}/without")
    return named.withColumn("kind", F.lit("header")).unionByName(plain.withColumn("kind", F.lit("plain")))


@register("src_glob_union", oracle("t_rows", body="""SELECT CAST(sid AS VARCHAR) AS sid, CAST(transport_mode AS VARCHAR)
    AS transport_mode, CASE WHEN transport_mode > 3 THEN CAST(distance AS VARCHAR) END AS distance FROM t_rows
    WHERE transport_mode <= 6"""))
def _(spark, d):
    folder = scratch_path(spark, "runs")
    rows = B.plan_rows_table(spark, d).select("sid", "transport_mode", "distance")
    _csv(rows.where("transport_mode <= 3").drop("distance"), f"{folder}/run_a_Summary.csv")
    _csv(rows.where("transport_mode BETWEEN 4 AND 6"), f"{folder}/run_b_Summary.csv")
    _csv(rows.where("transport_mode > 6"), f"{folder}/run_c_other.csv")
    return readers.read_matching(spark, folder, "Summary")


@register("sink_qid_text", oracle("t_dedup", "t_clicks", body="""SELECT concat_ws(' ', CASE WHEN click_mode = transport_mode THEN '1'
    ELSE '0' END, 'qid:' || CAST(sid AS VARCHAR), '1:' || CAST(transport_mode AS VARCHAR),
    CASE WHEN distance <> 0 THEN '2:' || CAST(distance AS VARCHAR) END, CASE WHEN eta <> 0 THEN '3:' || CAST(eta AS VARCHAR) END)
    AS value FROM t_dedup LEFT JOIN t_clicks USING (sid)"""))
def _(spark, d):
    path = scratch_path(spark, "qid")
    rows = B.plan_rows_table(spark, d).join(B.clicks_table(spark, d).select("sid", "click_mode"), "sid", "left")
    writers.write_qid_text(rows, path, ["transport_mode", "distance", "eta"], SHOWN)
    return spark.read.text(path)


@register("listwise_pad", oracle("t_dedup", "t_clicks", body=f"""WITH lists AS (SELECT sid,
    list(CASE WHEN click_mode = transport_mode THEN 1 ELSE 0 END ORDER BY {', '.join(SHOWN)}) AS y,
    list(transport_mode ORDER BY {', '.join(SHOWN)}) AS m FROM t_dedup LEFT JOIN t_clicks USING (sid) GROUP BY sid)
    SELECT sid, array_to_string(list_resize(y, 12, -1), ',') AS label, array_to_string(list_resize(m, 12, 0), ',')
    AS transport_mode FROM lists"""))
def _(spark, d):
    rows = B.plan_rows_table(spark, d).join(B.clicks_table(spark, d).select("sid", "click_mode"), "sid", "left")
    lists = writers.padded_lists(rows, ["transport_mode"], SHOWN)
    return lists.select("sid", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("label", "transport_mode")])
