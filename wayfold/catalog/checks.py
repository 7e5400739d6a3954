"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfold import bindings as B
from wayfold.bindings import oracle
from wayfold.catalog import register
from wayfold.operators import folds, quality


@register("check_columns", oracle("t_clicks", body="""SELECT "column", "column" IN ('sid', 'click_time', 'click_mode') AS found, n
    FROM (SELECT unnest(['sid', 'click_mode', 'eta', 'SID']) AS "column"), (SELECT count(*) AS n FROM t_clicks)"""))
def _(spark, d):
    clicks = B.clicks_table(spark, d)
    rows = quality.check_columns(clicks, ["sid", "click_mode"]).count()
    return quality.columns_found(clicks, ["sid", "click_mode", "eta", "SID"]).withColumn("n", F.lit(rows).cast("long"))


@register("check_same_schema", oracle("t_queries", body="""SELECT CAST(v.place AS INT) AS place, v."left", v."right", n FROM (VALUES
    (1, 'pid bigint', 'pid string'), (3, 'o string', 'd string'), (4, 'd string', NULL)) v(place, "left", "right"), (SELECT count(*) AS n FROM t_queries)"""))
def _(spark, d):
    queries = B.queries_table(spark, d)
    rows = quality.check_same_schema(queries, queries.select(*queries.columns)).count()
    other = queries.withColumn("pid", F.col("pid").cast("string")).drop("o")
    return quality.schema_differences(queries, other).withColumn("n", F.lit(rows).cast("long"))


@register("rows_with_null", oracle("t_queries", "t_clicks", body="""SELECT count(*) FILTER (WHERE pid IS NULL OR click_mode IS NULL)
    AS rows_with_null, CAST(count(*) > count(pid) AS INT) + CAST(count(*) > count(click_mode) AS INT) AS columns_with_null
    FROM t_queries LEFT JOIN t_clicks USING (sid)"""))
def _(spark, d):
    joined = B.queries_table(spark, d).select("sid", "pid", "req_time").join(
        B.clicks_table(spark, d).select("sid", "click_mode"), "sid", "left")
    return quality.rows_with_null(joined)


@register("check_row_count", oracle("t_queries", "t_clicks", body="""SELECT (SELECT count(*) FROM t_queries) AS before,
    (SELECT count(*) FROM t_queries LEFT JOIN t_clicks USING (sid)) AS after, (SELECT count(*) FROM t_queries)
    = (SELECT count(*) FROM t_queries LEFT JOIN t_clicks USING (sid)) AS same"""))
def _(spark, d):
    queries = B.queries_table(spark, d).select("sid")
    return quality.check_row_count(queries, queries.join(B.clicks_table(spark, d).select("sid"), "sid", "left"))


# A fold table with sids left out, listed twice, and unknown ones.
_BROKEN = "SELECT sid FROM t_queries WHERE sid % 7 <> 0 UNION ALL SELECT sid FROM t_queries WHERE sid % 11 = 0 UNION ALL SELECT -sid FROM t_queries WHERE sid % 13 = 0"


@register("check_folds", oracle("t_queries", body=f"""WITH folded AS (SELECT 'whole' AS kind, sid FROM t_queries UNION ALL SELECT 'broken', sid FROM ({_BROKEN})),
    times AS (SELECT kind, sid, count(*) AS n FROM folded GROUP BY ALL),
    found AS (SELECT kind, count(*) FILTER (WHERE n > 1) AS repeated, (SELECT count(*) FROM t_queries) - count(*) FILTER (WHERE sid >= 0) AS missing,
    count(*) FILTER (WHERE sid < 0) AS unknown FROM times GROUP BY kind)
    SELECT *, repeated + missing + unknown = 0 AS ok FROM found"""))
def _(spark, d):
    queries = B.queries_table(spark, d).select("sid")
    whole = folds.folds_shuffled(queries, 5).select("sid", "fold")
    broken = whole.where("sid % 7 <> 0").unionByName(whole.where("sid % 11 = 0")).unionByName(
        whole.where("sid % 13 = 0").select((-F.col("sid")).alias("sid"), "fold"))
    checked = [quality.check_folds(df, queries).withColumn("kind", F.lit(kind)) for kind, df in (("whole", whole), ("broken", broken))]
    return checked[0].unionByName(checked[1])
