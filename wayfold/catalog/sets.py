"""Stacking and comparing tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfold import bindings as B
from wayfold.bindings import oracle
from wayfold.catalog import register
from wayfold.operators import setops
from wayfold.schemas import PROFILE_COLUMNS


@register("union_rows", oracle("t_queries", "t_clicks", body="""SELECT sid, pid, NULL::INT AS click_mode FROM t_queries
    UNION ALL SELECT sid, NULL, click_mode FROM t_clicks"""))
def _(spark, d):
    return setops.union_rows(B.queries_table(spark, d).select("sid", "pid"),
                             B.clicks_table(spark, d).select("sid", "click_mode"), fill=True)


@register("add_sentinel", oracle("t_profiles", body=f"""SELECT pid, {', '.join(PROFILE_COLUMNS)} FROM t_profiles
    UNION ALL SELECT -1, {', '.join(['-1'] * len(PROFILE_COLUMNS))}"""))
def _(spark, d):
    return setops.add_sentinel(B.profiles_table(spark, d))


@register("distinct_rows", oracle("t_rows", body="SELECT DISTINCT sid, transport_mode FROM t_rows"))
def _(spark, d):
    return B.plan_rows_table(spark, d).select("sid", "transport_mode").distinct()


@register("sid_overlap", oracle("t_queries", "t_clicks", body="""SELECT count(*) FILTER (WHERE q.sid IS NOT NULL AND c.sid IS NOT NULL)
    AS "both", count(*) FILTER (WHERE c.sid IS NULL) AS only_left, count(*) FILTER (WHERE q.sid IS NULL) AS only_right
    FROM t_queries q FULL JOIN t_clicks c ON q.sid = c.sid"""))
def _(spark, d):
    return setops.sid_overlap(B.queries_table(spark, d), B.clicks_table(spark, d))


@register("sid_intersection", oracle("t_queries", "t_clicks", body="""SELECT sid FROM t_queries INTERSECT SELECT sid FROM t_clicks"""))
def _(spark, d):
    return setops.shared_sids(B.queries_table(spark, d), B.clicks_table(spark, d))


@register("sid_difference", oracle("t_queries", "t_clicks", body="""SELECT sid FROM t_queries EXCEPT ALL SELECT sid FROM t_clicks"""))
def _(spark, d):
    return setops.missing_sids(B.queries_table(spark, d), B.clicks_table(spark, d))


@register("schema_diff", """SELECT 'only_left' AS side, unnest(['d', 'o', 'pid', 'req_time']) AS "column", (SELECT count(*) FROM orders
    WHERE o_orderkey % 97 <> 5) AS n UNION ALL SELECT 'only_right', unnest(['plan_time', 'plans']), (SELECT count(*) FROM orders
    WHERE o_orderkey % 24 <> 0)""")
def _(spark, d):
    tables = {"only_left": B.queries_table(spark, d), "only_right": B.plans_table(spark, d)}
    diff = setops.schema_diff(*tables.values())
    # row counts beside the names, so the check says how much data each difference touches
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(side).alias("side"), F.explode(F.array(*[F.lit(c) for c in diff[side]])).alias("column"), "n")
        for side, df in tables.items()]
    return setops.union_rows(*parts)
