"""Hard negatives beside all products, and the tree's bounds."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfold.llm import hypertree, integers, negatives, queries

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, key string, x int, leaf int, block string"


def _mined(rows, positives=5, most=5, percent=80):
    """Every (anchor, positive, rank, negative, scores), all in Python integers."""
    whole = lambda x: int(x) * 256 if abs(x) > 2**60 else math.floor(x * 256)
    ok = [(i, tuple(whole(float(x)) for x in v), k) for i, v, k in rows
          if i is not None and k is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q, k in {r for r in ok if r[0] % 100 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j, own) for j, v, own in ok if j != i and len(v) == len(q))
        for s, j, _ in [x for x in scored if x[2] == k][:positives]:
            fits = [(t, n) for t, n, own in scored if own != k and percent * -s <= 100 * -t <= 100 * -s][:most]
            long = lambda x: x if -(2**63) <= x < 2**63 else None
            out += [(i, j, r + 1, n, long(-s), long(-t)) for r, (t, n) in enumerate(fits)]
    return sorted(out, key=str)


def _got(df):
    return sorted(map(tuple, df.collect()), key=str)


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "k", 1, 2, "b") for r in rows], SCHEMA).repartition(4)


def _clusters(seed, n, dim, centres=12, spread=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 1, (centres, dim))
    return [(i, (middle[i % centres] + rng.normal(0, spread, dim)).tolist(), int(rng.integers(0, 4))) for i in range(n)]


ODD = [(None, [0.1, 0.2], 1), (700, None, 1), (800, [], 1), (900, [None, 0.1], 1), (1000, [math.nan, 0.1], 1), (1100, [math.inf, 0.1], 1), (1200, [0.1, 0.2], None),
       (1300, [0.5, 0.25], 1), (1301, [0.5, 0.25], 1), (1302, [0.45, 0.25], 2), (1303, [1e200, -3.0], 1), (1400, [1e200, 7.5], 1), (1401, [9e199, 1e180], 2),
       (1500, [1e12, 1.5], 3), (1501, [1e12, 2.5], 3), (1502, [1e12, 2.25], 4), (1600, [-1.0, 0.0], 9), (1601, [1.0, 0.0], 9), (1602, [0.9, 0.0], 8),
       (1700, [2.0], 1), (1701, [3.0], 1), (1702, [2.9], 2), (1800, [0.0, 0.0], 6), (1801, [1.0, 1.0], 6), (1300, [0.5, 0.25], 1), (1300, [0.5, 0.26], 2)]


@pytest.mark.parametrize(("leaf", "block"), [(4096, 8192), (32, 16)])
def test_negatives_equal_brute_force(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(negatives, "LEAF", leaf)
    monkeypatch.setattr(negatives, "BLOCK", block)
    rows = _clusters(1, 420, 6) + [(2000 + i, [0.3, -0.2, 0.1, 0.0, 0.5, 0.1], i % 3) for i in range(220)]  # many equal vectors: ties
    assert _got(negatives.hard_negatives(_frame(spark, rows), F.col("vec_id") % 100 == 0)) == _mined(rows)


def test_odd_rows(spark):
    assert _got(negatives.hard_negatives(_frame(spark, ODD), F.col("vec_id") % 100 == 0)) == _mined(ODD)
    assert _got(negatives.hard_negatives(_frame(spark, ODD).limit(0), F.col("vec_id") % 100 == 0)) == []
    assert _got(negatives.hard_negatives(_frame(spark, ODD).filter("label > 100"), F.col("vec_id") % 100 == 0)) == []


def test_tree_leaves_out_leaves_but_no_row():
    rng = np.random.default_rng(4)
    u = np.array([v for _, v, _ in _clusters(5, 3000, 8, centres=40, spread=0.02)])
    u /= np.abs(u).max()
    square = float((u * u).sum(1).max())
    lifted = hypertree.lifted(u, square)
    tree = hypertree.Tree(lifted[:1500], len(u), 64, arity=8)
    leaf = tree.route(lifted, ranges=True)
    assert tree.leaves > 30 and len(set(leaf)) > 20
    q = u[rng.integers(0, len(u), 60)]
    own = (q * q).sum(1)
    scores = q @ u.T
    high = np.sort(scores, 1)[:, -3]
    low = high * 0.95
    hit = tree.meeting(hypertree.asked(q), (own + square - 2 * high)[:, None], (own + square - 2 * low)[:, None], own + square)
    inside = (scores <= high[:, None]) & (scores >= low[:, None])
    for i in range(len(q)):
        assert hit[i, leaf[inside[i]]].all()
    assert hit.mean() < 0.5
    closed = tree.meeting(hypertree.asked(q), np.ones((60, 1)), np.zeros((60, 1)), own + square)
    assert not closed.any()


def test_keys_sort_as_scores():
    for largest, scores in [(300, [-5, 0, 7, 90_000 * 64]), (2**40, [-(2**86), -1, 0, 2**70, 2**86])]:
        keys = integers.Keys(largest, 64)
        made = keys.of(np.array(scores, object if largest > 2**30 else np.int64))
        assert made == sorted(made) and [keys.score(k) for k in made] == scores


def test_query_over_the_whole_table(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(negatives, "LEAF", 64)
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert _got(queries.QUERIES["op12_hard_negatives"](spark, sf_dir)) == _mined(rows)
