"""A session ranker: logistic regression on differences between the clicked plan and the others."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.learn.decompose import assemble, standardize
from wayfold.operators.joins import inside_fold, outside_fold


def click_pairs(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per clicked session, feature differences clicked - other (label 1) and the reverse (label 0).

    Rows must be unique per (sid, mode): then one clicked row meets at most ten others, so the
    pairs grow with the rows and not with their square.
    """
    won = F.col("click_mode") == F.col("transport_mode")
    clicked = rows.where(won).select("sid", *[F.col(f).alias(f"_c_{f}") for f in features])
    others = rows.where(~won).select("sid", *features)
    both = others.join(clicked, "sid")
    side = lambda sign, label: F.struct(*[(sign * (F.col(f"_c_{f}") - F.col(f))).cast("double").alias(f) for f in features],
                                        F.lit(float(label)).alias("label"))
    return both.select(F.inline_outer(F.array(side(1, 1), side(-1, 0))))


def fit_pairwise(rows: DataFrame, features: Sequence[str], rounds: int = 50, reg: float = 0.0) -> dict[str, float]:
    """Weight per feature; no intercept, as a shift of all scores ranks the same."""
    pairs = assemble(click_pairs(rows, features), features)
    model = LogisticRegression(fitIntercept=False, maxIter=rounds, regParam=reg).fit(pairs)
    return dict(zip(features, (float(v) for v in model.coefficients)))


def linear_score(weights: dict[str, float]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(f) * F.lit(w) for f, w in weights.items()])


def cv_ranker(rows: DataFrame, features: Sequence[str], **how) -> DataFrame:
    """Out-of-fold score of every shown plan; ``rows`` carry their ``fold``."""
    parts = []
    for fold in sorted(r[0] for r in rows.select("fold").distinct().collect()):
        train, test = outside_fold(rows, fold), inside_fold(rows, fold)
        test, train = standardize(test, features, using=train), standardize(train, features)
        parts.append(test.withColumn("score", linear_score(fit_pairwise(train, features, **how))))
    return reduce(DataFrame.unionByName, parts)


def final_fit_predict(train: DataFrame, test: DataFrame, features: Sequence[str], path: str, **how) -> DataFrame:
    """Fit on the clicked sessions of ``train``, store the weights at ``path``, score every row of ``test`` with the stored ones.

    The scale of a feature goes into its weight: a shift of all scores ranks the same.
    """
    spread = train.agg(*[F.stddev_pop(f).alias(f) for f in features]).first()
    weights = fit_pairwise(standardize(train, features), features, **how)
    rows = [(f, w / (spread[f] or 1.0)) for f, w in weights.items()]
    spark = train.sparkSession
    spark.createDataFrame(rows, "feature string, weight double").coalesce(1).write.mode("overwrite").parquet(path)
    stored = {r["feature"]: r["weight"] for r in spark.read.parquet(path).collect()}  # one row per feature
    return test.withColumn("score", linear_score(stored))
