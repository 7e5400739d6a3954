"""The blocks of the searches in many dimensions beside plain numpy."""

from __future__ import annotations

import numpy as np

from wayfold.learn import reach
from wayfold.operators import metric


def _one_by_one(q, c):
    total = np.zeros((len(q), len(c)))
    for a, b in zip(q.T, c.T, strict=True):
        total += (a[:, None] - b[None]) ** 2
    return total


def test_whole_numbers_need_one_product_and_fractions_keep_their_order(monkeypatch):
    rng = np.random.default_rng(4)
    flags, real = rng.integers(0, 2, (40, 66)).astype(float), rng.normal(0, 3, (40, 9))
    assert (metric.squares(flags, flags[:7]) == _one_by_one(flags, flags[:7])).all()
    assert (metric.squares(real, real[:7]) == _one_by_one(real, real[:7])).all()
    off = np.abs(metric.rough_squares(real, real) - _one_by_one(real, real))
    assert (off <= metric.rough_error(real, real)[:, None]).all()


def test_core_distances_move_no_pairs(spark, monkeypatch):
    """Blocks send counts per distance: of equally far rows no more than one line a query."""
    sent = []
    real = metric.search
    monkeypatch.setattr(metric, "search", lambda *a: sent.append(real(*a)) or sent[-1])
    x = np.eye(60)
    rows = spark.createDataFrame([(i, v.tolist(), 2) for i, v in enumerate(x)], "id long, x array<double>, n long")
    found = {r["id"]: r["core"] for r in reach.core_distances(rows, 50).collect()}
    assert set(found.values()) == {round(2 ** 0.5, 9)} and len(found) == 60
    assert [df.count() for df in sent] == [120]


def test_rounds_keep_no_constraints_of_their_plans(spark):
    """What a checkpoint carries of its plan doubles from round to round where a table meets what came of it."""
    from wayfold.session import cut_lineage, cut_plan

    rows = spark.range(9).selectExpr("id", "id + 1 AS up").where("id > 2 AND up > 4")
    known = lambda df: df._jdf.queryExecution().optimizedPlan().constraints().size()
    assert known(cut_lineage(rows)) > 0 and known(cut_plan(rows)) == 0
    assert cut_plan(rows).collect() == rows.collect() and cut_plan(rows).schema == rows.schema
