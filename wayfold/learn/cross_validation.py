"""k-fold cross-validation of any Spark ML classifier, with out-of-fold probabilities."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.learn.decompose import assemble, standardize
from wayfold.operators import scoring
from wayfold.operators.joins import inside_fold, outside_fold
from wayfold.operators.quality import check_columns
from wayfold.schemas import MODES
from wayfold.session import cut_lineage

Prepare = Callable[[DataFrame], DataFrame]


def with_probabilities(predicted: DataFrame, classes: Sequence[int] = MODES) -> DataFrame:
    """``prob_<class>`` columns from ``probability``, or from one-against-rest margins."""
    if "probability" in predicted.columns:
        values = vector_to_array("probability")
    else:
        values = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
    held = predicted.withColumn("_p", values)
    total = F.aggregate("_p", F.lit(0.0), lambda a, v: a + v)
    share = lambda c: F.coalesce(F.get("_p", F.lit(c)) / F.col("_total"), F.lit(0.0))
    return held.withColumn("_total", total).withColumns({f"prob_{c}": share(c) for c in classes}).drop("_p", "_total")


def dealt(df: DataFrame, key: str) -> DataFrame:
    """The rows in parts and an order that follow from their keys alone, so that seeded draws meet the same rows.

    The number of parts is the session's ``spark.sql.shuffle.partitions``.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, key).sortWithinPartitions(key)


def _vectors(df: DataFrame, features: Sequence[str], vector: str | None) -> DataFrame:
    """With ``features`` as one vector of that name, made here unless the column ``vector`` holds it already."""
    return assemble(df, features) if vector is None else df.withColumn("features", F.col(vector))


def fit_on(train: DataFrame, features: Sequence[str], label: str, estimator: Estimator, key: str, laid: bool = False, vector: str | None = None,
           settings: Sequence[Mapping] | None = None):
    """``laid``: the rows come from a table that was stored as :func:`dealt` leaves it, so they need not move again.

    With ``settings``, parameters each, a list of models.
    """
    ready = _vectors(train, features, vector).select(F.col(key).alias("_key"), "features", F.col(label).cast("double").alias("label"))
    rows = (ready if laid else dealt(ready, "_key")).drop("_key")
    return estimator.fit(rows) if settings is None else estimator.fit(rows, list(settings))


def predict_with(model, df: DataFrame, features: Sequence[str], keep: Sequence[str],
                 classes: Sequence[int] = MODES, vector: str | None = None) -> DataFrame:
    predicted = with_probabilities(model.transform(_vectors(df, features, vector)), classes)
    return predicted.select(*keep, *[f"prob_{c}" for c in classes], F.col("prediction").cast("int").alias("prediction"))


def cv_classifier(df: DataFrame, features: Sequence[str], estimator: Estimator, label: str = "click_mode", key: str = "sid",
                  classes: Sequence[int] = MODES, balance: Prepare | None = None, scaled: bool = False, parallelism: int = 2,
                  laid: bool = False, vector: str | None = None) -> DataFrame:
    """Out-of-fold table: key, fold, ``prob_<class>``, prediction and label.

    ``df`` carries its ``fold``; it is read once per fold, so give a stored or checkpointed table.
    ``balance`` resamples the training part only; ``scaled`` standardizes by the training part.
    ``laid`` states that ``df`` was stored as :func:`dealt` by ``key``: the rows of a fold then lie as if dealt on their own,
    and are not shuffled for its fit, unless resampled.
    ``vector`` names a stored column that holds the assembled features, which every pass of a fit makes anew otherwise.
    ``parallelism`` models are fitted at a time: a fit is many short jobs, which leave cores idle between them.
    """
    return _cross(df, features, estimator, None, label, key, classes, balance, scaled, parallelism, laid, vector)[0]


def cv_settings(df: DataFrame, features: Sequence[str], estimator: Estimator, settings: Sequence[Mapping], label: str = "click_mode", key: str = "sid",
                classes: Sequence[int] = MODES, balance: Prepare | None = None, scaled: bool = False, parallelism: int = 2,
                laid: bool = False, vector: str | None = None) -> list[DataFrame]:
    """The table of :func:`cv_classifier` for each of ``settings``, parameters of ``estimator``; the rows of a fold are prepared once for all."""
    return _cross(df, features, estimator, settings, label, key, classes, balance, scaled, parallelism, laid, vector)


def _cross(df, features, estimator, settings, label, key, classes, balance, scaled, parallelism, laid, vector) -> list[DataFrame]:
    if scaled and vector is not None:
        raise ValueError("scaled works on columns, not on a stored vector")
    check_columns(df, [key, "fold", label, *(features if vector is None else [vector])])
    folds = sorted(r[0] for r in df.select("fold").distinct().collect())

    def predicted(fold) -> list[DataFrame]:
        train, test = outside_fold(df, fold), inside_fold(df, fold)
        if scaled:
            test, train = standardize(test, features, using=train), standardize(train, features)
        if balance is not None:
            train = balance(train)
        models = fit_on(train, features, label, estimator, key, laid and balance is None, vector, settings)
        test = test.withColumn("label", F.col(label))
        return [predict_with(m, test, features, [key, "fold", "label"], classes, vector) for m in (models if settings is not None else [models])]

    with ThreadPoolExecutor(parallelism) as pool:
        return [reduce(DataFrame.unionByName, parts) for parts in zip(*pool.map(predicted, folds))]


def fold_scores(oof: DataFrame) -> DataFrame:
    return scoring.metrics(oof, by=["fold"])


def hyper_grid(df: DataFrame, features: Sequence[str], make: Callable[..., Estimator], grid: Mapping[str, Iterable],
               settings: int = 2, **how) -> DataFrame:
    """Mean scores over the folds for every combination of parameter values of ``make``, ``settings`` of them at a time."""
    def scored(values: tuple) -> DataFrame:
        setting = dict(zip(grid, values))
        oof = cv_classifier(df, features, make(**setting), **how)
        text = ", ".join(sorted(f"{name}={v}" for name, v in setting.items()))
        return fold_scores(oof).agg(F.lit(text).alias("setting"), F.avg("weighted_f1").alias("weighted_f1"),
                                    F.avg("accuracy").alias("accuracy"))

    with ThreadPoolExecutor(settings) as pool:
        return reduce(DataFrame.unionByName, list(pool.map(scored, product(*grid.values()))))


def final_fit_predict(train: DataFrame, test: DataFrame, features: Sequence[str], estimator: Estimator, path: str,
                      label: str = "click_mode", key: str = "sid", classes: Sequence[int] = MODES, scaled: bool = False, laid: bool = False,
                      vector: str | None = None) -> DataFrame:
    """Fit on all training rows, store the model at ``path`` and predict the test rows with the stored one.

    With ``scaled`` the scale of the training rows is a part of the stored model; ``laid`` is that of :func:`cv_classifier`, and
    rows that are not laid are dealt and stored once as vectors, as scale and fit read them several times.  ``vector`` names a
    column of both tables that holds the assembled features; the stored model takes the single ones all the same.
    """
    raw = "_raw" if scaled else "features"
    assembler = VectorAssembler(inputCols=list(features), outputCol=raw, handleInvalid="keep")
    rows = assembler.transform(train) if vector is None else train.withColumn(raw, F.col(vector))
    ready = rows.select(F.col(key).alias("_key"), raw, F.col(label).cast("double").alias("label"))
    ready = (ready if laid else cut_lineage(dealt(ready, "_key"))).drop("_key")
    scaler = [StandardScaler(withMean=True, inputCol=raw, outputCol="features")] if scaled else []
    fitted = Pipeline(stages=[*scaler, estimator]).fit(ready)
    PipelineModel(stages=[assembler, *fitted.stages]).write().overwrite().save(path)
    stored = PipelineModel.load(path)
    if vector is None:
        found = stored.transform(test.select(key, *features))
    else:
        found = PipelineModel(stages=stored.stages[1:]).transform(test.select(key, F.col(vector).alias(raw)))
    predicted = with_probabilities(found, classes)
    return predicted.select(key, *[f"prob_{c}" for c in classes], F.col("prediction").cast("int").alias("prediction"))
