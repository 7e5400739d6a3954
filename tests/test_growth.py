"""What queries do once, together or in place of growing work, beside plain versions."""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from wayfold.functions import planlists
from wayfold.learn import clusters, cross_validation
from wayfold.operators import scoring


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _kmodes(rows, k, rounds):
    """Clusters of ``{key: values}`` by plain k-modes; null is the smallest value."""
    order = lambda v: (v is not None, v if v is not None else 0)
    often = [Counter(r[i] for r in rows.values()) for i in range(len(next(iter(rows.values()))))]
    weight = lambda r: sum(often[i][v] for i, v in enumerate(r) if v is not None)
    far = lambda a, b: sum(x != y for x, y in zip(a, b))
    modes = []
    while len(modes) < k:
        score = lambda r: weight(r) * (min(far(r, m) for m in modes) if modes else 1)
        modes.append(min(set(rows.values()), key=lambda r: (-score(r), [order(v) for v in r])))
    closest = lambda r: min(range(k), key=lambda c: (far(r, modes[c]), c))
    for _ in range(rounds):
        groups = [[r for r in rows.values() if closest(r) == c] for c in range(k)]
        modes = [tuple(min(Counter(r[i] for r in g).items(), key=lambda e: (-e[1], order(e[0])))[0] if g else m[i] for i in range(len(m)))
                 for g, m in zip(groups, modes)]
    return {key: closest(r) for key, r in rows.items()}


def test_kmodes_as_plain_and_on_stored_rows(spark):
    rows = {i: tuple(None if (i * p) % 11 == 0 else (i * i + i * p) % 7 % (2 + p % 3) for p in (1, 2, 3, 5, 7)) for i in range(120)}
    df = spark.createDataFrame([(i, *r) for i, r in rows.items()], "pid long, a int, b int, c int, d int, e int")
    found = clusters.kmodes(df, ["a", "b", "c", "d", "e"], 3, rounds=4)
    assert {r["pid"]: r["cluster"] for r in found.collect()} == _kmodes(rows, 3, 4)
    # neither the attributes nor lambdas over them are computed in every round
    source = spark.range(40).select(F.col("id").alias("pid"), *[(F.col("id") % (i + 2)).cast("int").alias(f"p{i}") for i in range(4)])
    plan = _plan(clusters.kmodes(source, [f"p{i}" for i in range(4)], 2, rounds=1))
    assert "Range" not in plan and "lambda" not in plan


def test_vectors_of_clusters_are_stored(spark):
    source = spark.range(40).select(F.col("id").alias("pid"), (F.col("id") % 2).cast("int").alias("a"), (F.col("id") % 3).cast("int").alias("b"))
    for found in (clusters.kmeans(source, ["a", "b"], 2), clusters.hierarchy(source, ["a", "b"], 2)):
        assert "Range" not in _plan(found) and found.count() == 40


class _Together(DecisionTreeClassifier):
    def fit(self, dataset, params=None):
        self.meet.wait(120)
        return super().fit(dataset, params)


def test_folds_and_settings_are_fitted_at_the_same_time(spark):
    df = spark.range(80).selectExpr("id AS sid", "CAST(id % 2 AS int) AS fold", "CAST(id % 3 AS int) AS click_mode", "CAST(id % 3 AS double) AS x").cache()

    def make(depth, meet):
        one = _Together(maxDepth=depth, seed=1)
        one.meet = meet
        return one
    assert cross_validation.cv_classifier(df, ["x"], make(2, threading.Barrier(2))).where("prediction = label").count() == 80
    meet = threading.Barrier(4)
    grid = cross_validation.hyper_grid(df, ["x"], lambda depth: make(depth, meet), {"depth": [1, 2]})
    assert [r["setting"] for r in grid.collect()] == ["depth=1", "depth=2"]


def test_ndcg_sorts_once_and_takes_labels_of_any_grade(spark):
    rows = [(1, 0, 3.0, 1), (1, 1, 2.0, 3), (1, 2, 1.0, None), (2, 0, 1.0, 0), (3, 0, 1.0, 2), (None, 0, 2.0, 0), (None, 1, 1.0, 1)]
    df = spark.createDataFrame(rows, "sid long, pos int, score double, target int")
    found = scoring.ndcg(df, at=(1, 2))
    r = found.first()
    log = 1.584962500721156
    assert r["sessions"] == 3
    assert abs(r["ndcg_1"] - (1 / 7 + 1 + 0) / 3) < 1e-12
    assert abs(r["ndcg_2"] - ((1 + 7 / log) / (7 + 1 / log) + 1 + 1 / log) / 3) < 1e-12
    assert _plan(found).count("Sort [") == 1


def test_wide_looks_modes_up_without_a_lambda_each(spark):
    text = '[{"distance":1,"price":5,"eta":1,"transport_mode":3},{"distance":2,"price":"","eta":2,"transport_mode":3},null]'
    df = spark.createDataFrame([(1, text), (2, None)], "sid long, plans string").withColumn("plans", planlists.parse_plans(F.col("plans")))
    for keep, price, want in (("first", 99999, (1, 5, 1)), ("last", 700, (2, 700, 2))):
        found = planlists.wide(df, keep=keep, missing_price=price)
        got = {r["sid"]: (r["dist_3"], r["price_3"], r["eta_3"], r["dist_4"]) for r in found.collect()}
        assert got == {1: (*want, 0), 2: (0, 0, 0, 0)}
        assert "filter(" not in _plan(found)
