"""Order-dependent operators: first of a group, best of a session, exact splits, top k."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfold import bindings as B
from wayfold.bindings import SHOWN, oracle
from wayfold.catalog import register
from wayfold.operators import ranks, scoring, summaries

SCORE = "(sid * 31 + transport_mode * 17) % 7"


@register("dedupe_mode", oracle("t_dedup", body="SELECT sid, transport_mode, pos, distance, eta, price FROM t_dedup"))
def _(spark, d):
    return ranks.first_per(B.plan_rows_table(spark, d), ["sid", "transport_mode"], ["pos", "distance", "eta", "price"])


@register("best_per_session", oracle("t_rows", body=f"""SELECT sid, transport_mode FROM (SELECT sid, transport_mode,
    row_number() OVER (PARTITION BY sid ORDER BY {SCORE} DESC, {', '.join(SHOWN)}) AS rn FROM t_rows) WHERE rn = 1"""))
def _(spark, d):
    from wayfold.operators.scoring import best_per_session
    return best_per_session(B.plan_rows_table(spark, d).withColumn("score", F.expr(SCORE)), order=SHOWN)


@register("row_offsets", oracle("t_rows", body="""SELECT sid, CAST(sum(n) OVER (ORDER BY sid) AS BIGINT) AS last_row,
    n AS difference FROM (SELECT sid, count(*) AS n FROM t_rows GROUP BY sid)"""))
def _(spark, d):
    sizes = summaries.session_sizes(B.plan_rows_table(spark, d))
    return ranks.running_totals(sizes, "sid", "n", "last_row").withColumnRenamed("n", "difference")


@register("split_time_rows", oracle("t_queries", body="""SELECT sid, CASE WHEN row_number() OVER (ORDER BY req_time, sid)
    <= floor(0.8 * (SELECT count(*) FROM t_queries)) THEN 'train' ELSE 'test' END AS split FROM t_queries"""))
def _(spark, d):
    return ranks.split_by_time(B.queries_table(spark, d)).select("sid", "split")


@register("split_time_sessions", oracle("t_rows", "t_queries", body="""WITH s AS (SELECT sid, row_number() OVER
    (ORDER BY req_time, sid) AS rn, count(*) OVER () AS n FROM (SELECT DISTINCT sid, req_time FROM t_rows JOIN t_queries USING (sid)))
    SELECT sid, pos, transport_mode, CASE WHEN rn <= floor(0.8 * n) THEN 'train' ELSE 'test' END AS split
    FROM t_rows JOIN s USING (sid)"""))
def _(spark, d):
    rows = B.plan_rows_table(spark, d).select("sid", "pos", "transport_mode")
    timed = rows.join(B.queries_table(spark, d).select("sid", "req_time"), "sid")
    return ranks.split_sessions_by_time(timed).drop("req_time")


@register("split_time_cutoff", oracle("t_queries", body="""SELECT sid, CASE WHEN req_time >= TIMESTAMP '1999-06-14' THEN 'test'
    ELSE 'train' END AS split FROM t_queries"""))
def _(spark, d):
    return ranks.split_at(B.queries_table(spark, d), "1999-06-14").select("sid", "split")


@register("topk_users", oracle("t_queries", body="""SELECT pid, count(*) AS n FROM t_queries WHERE pid IS NOT NULL GROUP BY pid
    ORDER BY n DESC, pid LIMIT 50"""))
def _(spark, d):
    return summaries.top_users(B.queries_table(spark, d), 50)


@register("best_k", """WITH x AS (SELECT vec_id, unnest(range(1, 65)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings),
    dists AS (SELECT a.vec_id, b.vec_id AS other, sum((a.v - b.v) * (a.v - b.v)) AS dist FROM x a JOIN x b ON a.i = b.i GROUP BY a.vec_id, b.vec_id),
    pairs AS (SELECT k, vec_id, vec_id % k AS la, other % k AS lb, dist FROM dists CROSS JOIN (SELECT unnest([2, 4, 8]) AS k)),
    means AS (SELECT k, vec_id, la, lb, sum(dist) / CASE WHEN la = lb THEN count(*) - 1 ELSE count(*) END AS m FROM pairs GROUP BY k, vec_id, la, lb),
    ab AS (SELECT k, vec_id, max(CASE WHEN la = lb THEN m END) AS a, min(CASE WHEN la <> lb THEN m END) AS b FROM means GROUP BY k, vec_id)
    SELECT CAST(k AS INT) AS k, round(avg((b - a) / greatest(a, b)), 6) AS score FROM ab GROUP BY k ORDER BY score DESC, k LIMIT 1""")
def _(spark, d):
    points = B.table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    scores = [scoring.silhouette(points.withColumn("label", F.col("vec_id") % k), "x", "label").select(
        F.lit(k).alias("k"), F.round("silhouette", 6).alias("score")) for k in (2, 4, 8)]
    return summaries.best_row(scores[0].unionByName(scores[1]).unionByName(scores[2]), "score", "k")


@register("sort_head", oracle("t_rows", body=f"""(SELECT 'head' AS kind, sid, distance FROM t_rows ORDER BY distance, sid,
    {', '.join(SHOWN)} LIMIT 20) UNION ALL (SELECT 'tail', sid, distance FROM t_rows
    ORDER BY distance DESC, sid DESC, {', '.join(c + ' DESC' for c in SHOWN)} LIMIT 20)"""))
def _(spark, d):
    rows, order = B.plan_rows_table(spark, d), ["distance", "sid", *SHOWN]
    head = rows.orderBy(*order).limit(20).select(F.lit("head").alias("kind"), "sid", "distance")
    tail = rows.orderBy(*[F.desc(c) for c in order]).limit(20).select(F.lit("tail").alias("kind"), "sid", "distance")
    return head.unionByName(tail)
