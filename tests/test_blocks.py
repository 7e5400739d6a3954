"""Fits that run on blocks of rows: right sums, models as good as Spark ML's own, bounded work of a pass."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier, OneVsRestModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors

from wayfold.learn import blocks, classifiers, nets
from wayfold.learn.boosting import BoostedModel


@pytest.fixture(scope="module")
def points(spark):
    x = np.random.default_rng(1).normal(size=(900, 4))
    y = (x[:, 0] * x[:, 1] > 0) + 2 * (x[:, 2] > 0.5)
    rows = [(Vectors.dense(a), float(b)) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, ["features", "label"]).repartition(3).cache()


def test_sums_reach_every_row_in_few_tasks(points):
    stored, tasks = blocks.as_blocks(points, points.features, points.label, a_task=500)
    assert stored.getNumPartitions() == 3 and tasks.getNumPartitions() == 2
    found = blocks.summed(tasks, lambda x, y: np.concatenate([[len(y), y.sum()], x.sum(axis=0)]))
    rows = points.collect()
    assert np.allclose(found, [900, sum(r.label for r in rows), *sum(r.features.toArray() for r in rows)])
    assert blocks.summed(blocks.as_blocks(points.limit(0), points.features, points.label)[1], lambda x, y: y) is None


def test_net_gradient_and_loss_against_differences_and_spark():
    rng, sizes = np.random.default_rng(2), [3, 4, 3]
    x, y, w = rng.normal(size=(50, 3)), rng.integers(0, 3, 50).astype(float), rng.normal(size=31)
    loss = lambda w: nets.gradient(x, y, w, sizes)[1]
    steps = 1e-6 * np.eye(31)
    slopes = [(loss(w + s) - loss(w - s)) / 2e-6 for s in steps]
    assert np.allclose(nets.gradient(x, y, w, sizes)[2:], slopes, atol=1e-5)


def test_net_is_sparks_model_and_fits_as_well(points):
    one = classifiers.net(4, (8, 6), classes=4, rounds=40)
    own, spark_ml = one.fit(points), MultilayerPerceptronClassifier(layers=[4, 8, 6, 4], maxIter=40, seed=1).fit(points)
    assert isinstance(one, nets.BlockNet) and isinstance(own, MultilayerPerceptronClassificationModel)
    x, y = (np.array([r[c].toArray() if c == "features" else r[c] for r in points.collect()]) for c in ("features", "label"))
    loss = lambda m: nets.gradient(x, y, np.array(m.weights.toArray()), [4, 8, 6, 4])[1] / 900
    assert loss(own) < loss(spark_ml) + 0.1
    # Spark's model and the passes read the weights alike
    right = [r.prediction == r.label for r in own.transform(points).collect()]
    assert np.mean(right) > 0.75


def test_nets_of_one_fold_share_their_blocks(points, monkeypatch):
    """Rows are prepared once for all networks, which are those of single fits; large sums overflow nothing."""
    made, as_blocks = [], blocks.as_blocks
    monkeypatch.setattr(blocks, "as_blocks", lambda *a: made.append(1) or as_blocks(*a))
    one = classifiers.net(4, (6,), classes=4, rounds=5)
    layers = [[4, 6, 4], [4, 5, 3, 4]]
    both = one.fit(points, [{one.layers: s} for s in layers])
    assert len(made) == 1
    for s, model in zip(layers, both):
        alone = one.fit(points, {one.layers: s})
        assert np.allclose(model.weights.toArray(), alone.weights.toArray(), atol=1e-4)
    far = nets.gradient(np.full((2, 1), 1e4, np.float32), np.zeros(2, np.float32), np.array([-1, 0, 1, -1, 0, 0], np.float32), [1, 1, 2])
    assert np.isfinite(far).all() and np.isclose(far[1], 2 * np.log(2))


def test_net_refuses_what_spark_refuses(spark):
    for vector, label in (([float("nan")], 0.0), ([1.0], 0.5), ([1.0], -1.0), ([1.0], None)):
        df = spark.createDataFrame([(vector, label)], "x array<double>, label double")
        with pytest.raises(Exception, match="not finite|no whole"):
            classifiers.net(1, (2,), classes=2, rounds=1).fit(df.select(array_to_vector("x").alias("features"), "label"))


@pytest.fixture(scope="module")
def steps(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, size=(1500, 3)).astype(float)
    y = np.where(x[:, 0] > 7, 2, np.where(x[:, 1] + x[:, 2] > 11, 1, 0))
    y = np.where(rng.random(1500) < 0.15, rng.integers(0, 3, 1500), y)
    return spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"]).repartition(4).cache()


def _raw(model, rows):
    return np.array([r.rawPrediction.toArray() for r in model.transform(rows).select("rawPrediction").collect()])


@pytest.mark.parametrize("held", [0.25, 1e-9])
def test_shared_trees_are_those_of_a_fit_per_class(steps, held, monkeypatch):
    """The same trees, rates and early stop as Spark ML's, in passes whose number does not grow with the classes."""
    one = classifiers.boosted(rounds=8, depth=3, rate=0.4, held=held)
    passes, summed = [], blocks.summed
    monkeypatch.setattr(blocks, "summed", lambda *a: passes.append(1) or summed(*a))
    own = one.fit(steps)
    assert len(passes) <= 8 * (3 + 1)
    monkeypatch.setattr(type(one.getClassifier()), "getFeatureSubsetStrategy", lambda self: "as before")
    per_class = one.fit(steps)
    assert isinstance(own, BoostedModel) and isinstance(per_class, OneVsRestModel)
    assert [len(trees) for trees in own.ensembles()] == [m.getNumTrees for m in per_class.models]
    assert np.allclose(_raw(own, steps), _raw(per_class, steps), atol=1e-9)
    assert [r.prediction for r in own.transform(steps).collect()] == [r.prediction for r in per_class.transform(steps).collect()]


def test_shared_trees_of_many_values_fit_as_well_and_are_kept(points, tmp_path):
    model = Pipeline(stages=[classifiers.boosted(rounds=10, depth=4, rate=0.3, held=0.2)]).fit(points)
    right = [r.prediction == r.label for r in model.transform(points).collect()]
    assert np.mean(right) > 0.85
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert np.array_equal(_raw(again, points), _raw(model, points))


def test_sums_of_many_tasks_are_added_by_tasks(points, monkeypatch):
    _, tasks = blocks.as_blocks(points, points.features, points.label, a_task=100)
    one = lambda x, y: np.array([len(y), y.sum()])
    few = blocks.summed(tasks, one)
    monkeypatch.setattr(blocks, "MANY", 1)
    assert np.allclose(blocks.summed(tasks, one), few)


def test_sums_of_many_tasks_take_one_job(points, monkeypatch):
    monkeypatch.setattr(blocks, "MANY", 0)
    stored, tasks = blocks.as_blocks(points, points.features, points.label, a_task=400)
    spark = points.sparkSession
    spark.sparkContext.setJobGroup("sums", "sums")
    try:
        assert blocks.summed(tasks, lambda x, y: np.array([len(y)])) == [900]
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("sums")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert blocks.summed(blocks.as_blocks(points.limit(0), points.features, points.label)[1], lambda x, y: y) is None


def test_no_training_rows(points):
    with pytest.raises(ValueError, match="no training rows"):
        classifiers.boosted(held=0.2).fit(points.limit(0))
