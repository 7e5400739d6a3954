"""Scores to decisions and metrics.

Every metric starts from the confusion counts, at most one row per pair of classes, so only the
first grouping touches the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfold.schemas import MODES


def best_per_session(rows: DataFrame, score: str = "score", order: Sequence[str] = ("pos",)) -> DataFrame:
    """Mode with the highest score of each session, the first shown on ties."""
    key = F.struct((-F.col(score)).alias("_s"), *order, F.col("transport_mode").alias("_mode"))
    return rows.groupBy("sid").agg(F.min(key).alias("b")).select("sid", F.col("b._mode").alias("transport_mode"))


def score_matrix(rows: DataFrame, score: str = "score", modes: Sequence[int] = MODES, extra: Sequence[str] = ()) -> DataFrame:
    """One row per session with a score per mode, 0 where the mode is not shown."""
    cells = [F.coalesce(F.max(F.when(F.col("transport_mode") == m, F.col(score))), F.lit(0.0)).alias(f"prob_{m}") for m in modes]
    return rows.groupBy("sid", *extra).agg(*cells)


def arg_max(columns: Sequence[str], first: int = 0) -> Column:
    """Number of the column with the largest value, the first one on ties."""
    values = F.array(*[F.col(c) for c in columns])
    return (F.array_position(values, F.array_max(values)) - 1 + first).cast("int")


def ensemble_mean(tables: Sequence[DataFrame], modes: Sequence[int] = MODES) -> DataFrame:
    """Mean probability per class over the models and the class with the largest one."""
    stacked = tables[0]
    for df in tables[1:]:
        stacked = stacked.unionByName(df)
    names = [f"prob_{m}" for m in modes]
    # rounding keeps the choice independent of the order of the additions
    means = stacked.groupBy("sid").agg(*[F.round(F.avg(c), 9).alias(c) for c in names])
    return means.withColumn("prediction", arg_max(names, first=modes[0]))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Weighted F1, accuracy, weighted recall and weighted precision, per ``by`` group.

    Classes weigh by their number of labels; a class never predicted has precision and F1 zero.
    """
    cells = confusion(df, label, prediction, by)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("guessed"),
                 F.lit(0).cast("bigint").alias("hits")))
    per = cells.select(*by, F.inline(sides)).groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hits").alias("hits"))
    zero_safe = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    precision = zero_safe(F.col("hits"), F.col("guessed"))
    recall = zero_safe(F.col("hits"), F.col("support"))
    f1 = zero_safe(2 * F.col("hits"), F.col("support") + F.col("guessed"))
    weighted = lambda c: F.sum(F.col("support") * c) / F.sum("support")
    return per.groupBy(*by).agg(
        weighted(f1).alias("weighted_f1"), (F.sum("hits") / F.sum("support")).alias("accuracy"),
        weighted(recall).alias("weighted_recall"), weighted(precision).alias("weighted_precision"))


def cv_summary(scored: DataFrame, params: str, features: Sequence[str], model: str) -> DataFrame:
    """One row per run: scores of every fold as JSON, their means, parameters and features."""
    per = metrics(scored, by=["fold"])
    named = {"F1": "weighted_f1", "Acc": "accuracy", "Recall": "weighted_recall", "Precision": "weighted_precision"}
    # confusion counts of each fold, one entry per pair of classes
    cells = confusion(scored, by=["fold"]).groupBy("fold").agg(F.sort_array(F.collect_list(F.struct(
        F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"), "n"))).alias("cells"))
    # one entry per fold, a handful
    folds = lambda value: F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct(
        F.col("fold").cast("string").alias("key"), value.alias("value"))))))
    return per.join(cells, "fold").agg(
        F.lit(model).alias("model_type"), F.lit(params).alias("parameters"),
        F.lit(" - ".join(features)).alias("features"), F.lit(len(features)).alias("number"),
        *[folds(F.round(c, 6)).alias(f"{n}_folds") for n, c in named.items()], folds(F.col("cells")).alias("Conf_folds"),
        *[F.avg(c).alias(f"{n}_mean") for n, c in named.items()])


def score_submission(submission: DataFrame, truth: DataFrame) -> DataFrame:
    """Scores of ``(sid, prediction)`` against ``(sid, label)`` with the coverage of both sides.

    Repeated rows count once; a sid predicted twice differently shows in ``conflicting``.
    """
    one = submission.groupBy("sid").agg(F.min("prediction").alias("prediction"), F.max("prediction").alias("_other"))
    joined = truth.join(one, "sid", "full")
    matched = F.col("label").isNotNull() & F.col("prediction").isNotNull()
    coverage = joined.agg(F.count_if(F.col("prediction").isNull()).alias("not_predicted"),
                          F.count_if(F.col("label").isNull()).alias("not_labelled"),
                          F.count_if(F.col("_other") != F.col("prediction")).alias("conflicting"))
    scores = metrics(joined.where(matched))
    # two one-row tables side by side, without a join
    both = coverage.unionByName(scores, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def ndcg(rows: DataFrame, score: str = "score", label: str = "target", order: Sequence[str] = ("pos",),
         at: Sequence[int] = (1, 3, 5, 10)) -> DataFrame:
    """Mean NDCG at several depths over the sessions with a relevant plan.

    Expects at most one row per (sid, mode), as after ``first_per``: a session then has at most
    eleven rows, which bounds the window.  Everything comes from one order by session and score; the best order is that of
    a session's own labels.
    """
    key = Window.partitionBy("sid")
    ranked = rows.withColumn("_rank", F.row_number().over(key.orderBy(F.desc(score), *order)))
    gain = lambda of, place: (F.pow(F.lit(2.0), of) - 1) / F.log2(place + 1)
    got = {f"got_{k}": F.sum(F.when(F.col("_rank") <= k, gain(F.col(label), F.col("_rank"))).otherwise(0.0)).over(key) for k in at}
    seen = ranked.withColumns(got | {"_labels": F.collect_list(label).over(key)}).where("_rank = 1")
    best = F.transform(F.sort_array("_labels", asc=False), lambda of, i: gain(of, i + 1))
    per = seen.withColumn("_best", best).withColumns({
        f"ideal_{k}": F.aggregate(F.slice("_best", 1, k), F.lit(0.0), lambda a, v: a + v) for k in at})
    some = per.where(F.col(f"ideal_{max(at)}") > 0)
    return some.agg(*[F.avg(F.col(f"got_{k}") / F.col(f"ideal_{k}")).alias(f"ndcg_{k}") for k in at], F.count(F.lit(1)).alias("sessions"))


def silhouette(df: DataFrame, features: str, cluster: str) -> DataFrame:
    """Mean silhouette with squared Euclidean distance, from one vector sum per cluster.

    The mean squared distance from x to a cluster is |x|^2 - 2 x.mean + mean|y|^2, so no pair of
    rows is ever formed.  ``features`` is an array column; the clusters are few (checked).
    """
    stats = df.select(cluster, F.posexplode(features).alias("i", "v")).groupBy(cluster, "i").agg(
        F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"), F.count(F.lit(1)).alias("n"))
    per = stats.groupBy(cluster).agg(F.array_sort(F.collect_list(F.struct("i", "s"))).alias("l"), F.sum("q").alias("q"), F.max("n").alias("n"))
    rows = per.limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10,000 clusters")
    cells = F.array(*[F.struct(F.lit(int(r[0])).alias("c"), F.array(*[F.lit(e["s"] / r["n"]) for e in r["l"]]).alias("mean"),
                               F.lit(r["q"] / r["n"]).alias("q"), F.lit(r["n"]).alias("n")) for r in rows])
    norm = F.aggregate(features, F.lit(0.0), lambda a, v: a + v * v)
    dot = lambda m: F.aggregate(F.zip_with(features, m, lambda a, b: a * b), F.lit(0.0), lambda a, p: a + p)
    far = F.transform(cells, lambda c: F.struct(c["c"].alias("c"), c["n"].alias("n"), (c["q"] - 2 * dot(c["mean"])).alias("d")))
    measured = df.withColumns({"_norm": norm, "_d": far})
    own = F.get(F.filter("_d", lambda e: e["c"] == F.col(cluster)), F.lit(0))
    nearest = F.array_min(F.transform(F.filter("_d", lambda e: e["c"] != F.col(cluster)), lambda e: e["d"]))
    measured = measured.select(own["n"].alias("n"), (own["d"] + F.col("_norm")).alias("own"), (nearest + F.col("_norm")).alias("others"))
    a, others = F.coalesce(F.try_divide(F.col("own") * F.col("n"), F.col("n") - 1), F.lit(0.0)), F.col("others")
    # clusters of equal points are as near to one another as to themselves
    value = F.when((F.col("n") > 1) & (F.greatest(a, others) > 0), F.try_divide(others - a, F.greatest(a, others))).otherwise(F.lit(0.0))
    return measured.select(value.alias("s")).agg(F.avg("s").alias("silhouette"), F.count("s").alias("n"))
