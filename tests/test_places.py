"""The search for nearest places on a plane beside brute force."""

from __future__ import annotations

import numpy as np
import pytest

from wayfold.learn import classifiers
from wayfold.operators import places


@pytest.mark.parametrize(("leaf", "block", "k"), [(512, 4096, 5), (8, 64, 5), (8, 4, 1), (8, 4, 5000)])
def test_every_needed_spot_and_few_others(spark, monkeypatch, leaf, block, k):
    monkeypatch.setattr(places, "LEAF", leaf)
    monkeypatch.setattr(places, "BLOCK", block)
    rng = np.random.default_rng(3)
    # a dense centre, a thin rest, places where no spot is
    s = np.unique(np.concatenate([rng.normal(0, 0.01, (300, 2)), rng.uniform(-5, 5, (100, 2))]).round(4), axis=0)
    p = np.unique(np.concatenate([s[:80], rng.uniform(-5, 5, (60, 2)), rng.uniform(40, 41, (40, 2))]).round(4), axis=0)
    n = rng.integers(1, 4, len(s))
    got = places.nearest_places(spark.createDataFrame(p.tolist(), "_x double, _y double").repartition(3),
                                spark.createDataFrame([(*map(float, a), int(b)) for a, b in zip(s, n)], "_sx double, _sy double, _n long"), k)
    found = {}
    for r in got.collect():
        assert found.setdefault((r["_x"], r["_y"]), {}).setdefault((r["_sx"], r["_sy"]), r["_n"]) == r["_n"]
    met = []
    for x, y in p.tolist():
        far = np.hypot(s[:, 0] - x, s[:, 1] - y)
        order = np.argsort(far)
        enough = np.flatnonzero(np.cumsum(n[order]) >= k)
        last = far[order[enough[0]]] if len(enough) else np.inf
        assert {tuple(v) for v in s[far <= last].tolist()} <= set(found[x, y])
        met.append(len(found[x, y]))
    # a place far off may meet the whole centre, others do not
    assert k > 1000 or np.median(met) <= 10 * k


def test_votes_visit_no_nested_cells(spark, monkeypatch):
    """The search by leaves takes the place of a descent through nested cells, which grew with the density of the places."""
    from wayfold.operators import context

    monkeypatch.setattr(context, "_may_count", lambda *_: pytest.fail("nested cells"))
    rows = spark.range(2000).selectExpr("id % 50 / 1000D AS x", "id / 100000D AS y", "CAST(id % 3 AS INT) AS l")
    assert classifiers.nearest_vote(rows, rows, "x", "y", "l", 20).count() == 2000
