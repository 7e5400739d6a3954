"""Score tables, ensembles and metrics over deterministic stand-in scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayfold import bindings as B
from wayfold.bindings import SHOWN, oracle
from wayfold.catalog import register
from wayfold.catalog.scalars import rounded
from wayfold.functions.encode import rank_target
from wayfold.operators import ranks, scoring
from wayfold.schemas import MODES

STAND_IN = "((sid * 31 + transport_mode * 17) % 101) / CAST(101 AS DOUBLE)"
GUESS = "CAST(CASE WHEN sid % 3 = 0 THEN click_mode ELSE (sid * 7) % 12 END AS INT)"


def _scored(spark, d):
    return B.plan_rows_table(spark, d).withColumn("score", F.expr(STAND_IN))


def _judged(spark, d):
    return B.clicks_table(spark, d).selectExpr("sid", "click_mode AS label", f"{GUESS} AS prediction", "CAST(sid % 5 AS INT) AS fold")


_JUDGED = f"judged AS (SELECT sid, click_mode AS label, {GUESS} AS prediction, CAST(sid % 5 AS INT) AS fold FROM t_clicks)"


def metric_sql(fold: str = "0") -> str:
    """Per-fold scores named F1, acc, rec, prec as CTE ``scores``."""
    return f"""{_JUDGED}, classes AS (SELECT {fold} AS fold, c, CAST(sum(l) AS BIGINT) AS l, CAST(sum(p) AS BIGINT) AS p,
        CAST(sum(h) AS BIGINT) AS h FROM (
        SELECT fold, label AS c, 1 AS l, 0 AS p, CAST(label = prediction AS INT) AS h FROM judged UNION ALL
        SELECT fold, prediction, 0, 1, 0 FROM judged) GROUP BY ALL),
        scores AS (SELECT fold, sum(l * (2 * h / (l + p))) / sum(l) AS f1, sum(h) / sum(l) AS acc,
        sum(CASE WHEN l > 0 THEN l * (h / l) ELSE 0 END) / sum(l) AS rec,
        sum(CASE WHEN p > 0 THEN l * (h / p) ELSE 0 END) / sum(l) AS prec FROM classes GROUP BY fold)"""


@register("confusion", oracle("t_clicks", body=f"WITH {_JUDGED} SELECT label, prediction, count(*) AS n FROM judged GROUP BY ALL"))
def _(spark, d):
    return scoring.confusion(_judged(spark, d))


@register("weighted_f1", oracle("t_clicks", body=f"WITH {metric_sql()} SELECT round(f1, 6) AS weighted_f1 FROM scores"))
def _(spark, d):
    return rounded(scoring.metrics(_judged(spark, d)).select("weighted_f1"), ["weighted_f1"])


@register("accuracy", oracle("t_clicks", body=f"WITH {_JUDGED} SELECT round(avg(CAST(label = prediction AS INT)), 6) AS accuracy FROM judged"))
def _(spark, d):
    return rounded(scoring.metrics(_judged(spark, d)).select("accuracy"), ["accuracy"])


@register("weighted_recall", oracle("t_clicks", body=f"""WITH {metric_sql('fold')} SELECT fold, round(rec, 6) AS weighted_recall,
    round(prec, 6) AS weighted_precision FROM scores"""))
def _(spark, d):
    names = ["weighted_recall", "weighted_precision"]
    return rounded(scoring.metrics(_judged(spark, d), by=["fold"]).select("fold", *names), names)


def _folds(column: str, name: str) -> str:
    return (f"""'{{' || string_agg('"' || CAST(fold AS VARCHAR) || '":' || CAST(round({column}, 6) AS VARCHAR), ',' ORDER BY fold) || '}}' """
            f'AS "{name}_folds"')


_FOLD_SCORES = {"F1": "f1", "Acc": "acc", "Recall": "rec", "Precision": "prec"}


@register("cv_summary", oracle("t_clicks", body=f"""WITH {metric_sql('fold')},
    cells AS (SELECT fold, label, prediction, count(*) AS n FROM judged GROUP BY ALL),
    listed AS (SELECT fold, string_agg('{{"label":' || CAST(label AS VARCHAR) || ',"prediction":' || CAST(prediction AS VARCHAR)
        || ',"n":' || CAST(n AS VARCHAR) || '}}', ',' ORDER BY label, prediction) AS cells FROM cells GROUP BY fold)
    SELECT 'stand-in' AS model_type, '{{"k": 5}}' AS parameters, 'sid - click_mode' AS features, 2 AS number,
    {', '.join(_folds(c, n) for n, c in _FOLD_SCORES.items())},
    '{{' || string_agg('"' || CAST(fold AS VARCHAR) || '":[' || cells || ']', ',' ORDER BY fold) || '}}' AS "Conf_folds",
    {', '.join(f'round(avg({c}), 6) AS "{n}_mean"' for n, c in _FOLD_SCORES.items())} FROM scores JOIN listed USING (fold)"""))
def _(spark, d):
    row = scoring.cv_summary(_judged(spark, d), '{"k": 5}', ["sid", "click_mode"], "stand-in")
    return rounded(row, [c for c in row.columns if c.endswith("_mean")])


@register("score_submission", oracle("t_clicks", "t_queries", body=f"""WITH {_JUDGED.replace('FROM t_clicks', 'FROM t_clicks JOIN t_queries USING (sid)')},
    classes AS (SELECT c, CAST(sum(l) AS BIGINT) AS l, CAST(sum(p) AS BIGINT) AS p, CAST(sum(h) AS BIGINT) AS h FROM (
        SELECT label AS c, 1 AS l, 0 AS p, CAST(label = prediction AS INT) AS h FROM judged UNION ALL
        SELECT prediction, 0, 1, 0 FROM judged) GROUP BY c)
    SELECT CAST((SELECT count(*) FROM t_queries WHERE sid NOT IN (SELECT sid FROM t_clicks)) AS BIGINT) AS not_labelled,
    CAST((SELECT count(*) FROM t_clicks WHERE sid NOT IN (SELECT sid FROM t_queries)) AS BIGINT) AS not_predicted,
    CAST(0 AS BIGINT) AS conflicting, round(sum(l * (2 * h / (l + p))) / sum(l), 6) AS weighted_f1, round(sum(h) / sum(l), 6) AS accuracy,
    round(sum(CASE WHEN l > 0 THEN l * (h / l) ELSE 0 END) / sum(l), 6) AS weighted_recall,
    round(sum(CASE WHEN p > 0 THEN l * (h / p) ELSE 0 END) / sum(l), 6) AS weighted_precision FROM classes"""))
def _(spark, d):
    truth = B.clicks_table(spark, d).selectExpr("sid", "click_mode AS label")
    guesses = B.queries_table(spark, d).select("sid").join(B.clicks_table(spark, d).select("sid", "click_mode"), "sid", "left")
    guesses = guesses.selectExpr("sid", f"coalesce({GUESS}, 0) AS prediction")
    row = scoring.score_submission(guesses.unionByName(guesses), truth)
    return rounded(row, ["weighted_f1", "accuracy", "weighted_recall", "weighted_precision"])


@register("score_matrix", oracle("t_rows", body=f"SELECT sid, CAST(sid % 5 AS INT) AS fold, " + ", ".join(
    f"round(coalesce(max(CASE WHEN transport_mode = {m} THEN {STAND_IN} END), 0.0), 6) AS prob_{m}" for m in MODES)
    + " FROM t_rows GROUP BY sid"))
def _(spark, d):
    rows = _scored(spark, d).withColumn("fold", F.expr("CAST(sid % 5 AS INT)"))
    return rounded(scoring.score_matrix(rows, extra=["fold"]), [f"prob_{m}" for m in MODES])


def _prob(m, k):
    return f"((sid * {k} + {m} * 29) % 89) / CAST(89 AS DOUBLE)"


def _probs(spark, d, k):
    return B.queries_table(spark, d).selectExpr("sid", *[f"{_prob(m, k)} AS prob_{m}" for m in MODES])


@register("ensemble_mean", oracle("t_queries", body="WITH m AS (SELECT sid, " + ", ".join(
    f"round(({_prob(m, 3)} + {_prob(m, 7)} + {_prob(m, 13)}) / 3, 9) AS prob_{m}" for m in MODES) + " FROM t_queries) SELECT sid, "
    + ", ".join(f"round(prob_{m}, 6) AS prob_{m}" for m in MODES) + ", CAST(list_position(["
    + ", ".join(f"prob_{m}" for m in MODES) + "], greatest(" + ", ".join(f"prob_{m}" for m in MODES)
    + ")) - 1 AS INT) AS prediction FROM m"))
def _(spark, d):
    mean = scoring.ensemble_mean([_probs(spark, d, k) for k in (3, 7, 13)])
    return rounded(mean, [f"prob_{m}" for m in MODES])


@register("stack_features", oracle("t_queries", "t_clicks", body="SELECT sid, " + ", ".join(
    f"round({_prob(m, k)}, 6) AS prob_{m}_{n}" for n, k in (("a", 3), ("b", 7)) for m in MODES)
    + ", coalesce(click_mode, 0) AS click_mode FROM t_queries LEFT JOIN t_clicks USING (sid)"))
def _(spark, d):
    from wayfold.learn.stacking import stack_features
    stacked = stack_features({"a": _probs(spark, d, 3), "b": _probs(spark, d, 7)},
                             B.clicks_table(spark, d).select("sid", "click_mode"))
    return rounded(stacked, [c for c in stacked.columns if c.startswith("prob_")])


@register("ndcg_at_k", oracle("t_dedup", "t_clicks", body=f"""WITH r AS (SELECT sid, CASE WHEN click_mode = transport_mode THEN 3 ELSE 0 END AS t,
    row_number() OVER (PARTITION BY sid ORDER BY {STAND_IN} DESC, {', '.join(SHOWN)}) AS rank FROM t_dedup LEFT JOIN t_clicks USING (sid)),
    hit AS (SELECT sid, rank FROM r WHERE t = 3)
    SELECT count(*) AS sessions, """ + ", ".join(
    f"round(avg(CASE WHEN rank <= {k} THEN 1 / log2(rank + 1) ELSE 0 END), 6) AS ndcg_{k}" for k in (1, 3, 5, 10)) + " FROM hit"))
def _(spark, d):
    rows = ranks.first_per(B.plan_rows_table(spark, d), ["sid", "transport_mode"], ["pos", "distance", "eta", "price"])
    rows = rows.withColumn("score", F.expr(STAND_IN)).join(B.clicks_table(spark, d).select("sid", "click_mode"), "sid", "left")
    rows = rows.withColumn("target", rank_target(F.col("click_mode"), F.col("transport_mode")))
    return rounded(scoring.ndcg(rows, order=SHOWN), [f"ndcg_{k}" for k in (1, 3, 5, 10)])


@register("silhouette", """WITH x AS (SELECT vec_id, label, unnest(range(1, 65)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings),
    pairs AS (SELECT a.vec_id, a.label AS la, b.label AS lb, b.vec_id AS other, sum((a.v - b.v) * (a.v - b.v)) AS dist
    FROM x a JOIN x b ON a.i = b.i GROUP BY a.vec_id, a.label, b.label, b.vec_id),
    means AS (SELECT vec_id, la, lb, sum(dist) / CASE WHEN la = lb THEN count(*) - 1 ELSE count(*) END AS m FROM pairs GROUP BY vec_id, la, lb),
    ab AS (SELECT vec_id, max(CASE WHEN la = lb THEN m END) AS a, min(CASE WHEN la <> lb THEN m END) AS b FROM means GROUP BY vec_id)
    SELECT count(*) AS n, round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM ab""")
def _(spark, d):
    points = B.table(spark, d, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("x"))
    return rounded(scoring.silhouette(points, "x", "label"), ["silhouette"])
