"""Hierarchy, density levels, nearest votes and lambda gradients beside plain numpy and Python versions."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfold.learn import classifiers, lambdas, ranker, reach, ward
from wayfold.operators import metric


def _frame(spark, x, first=100):
    columns = [f"f{i}" for i in range(x.shape[1])]
    rows = [(first + 7 * i, *map(float, v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "pid long, " + ", ".join(f"{c} double" for c in columns)).repartition(3), columns, [r[0] for r in rows]


def _ward(x):
    """Heights and, for any k, labels of the greedy Ward hierarchy over single rows."""
    groups = {i: [i] for i in range(len(x))}
    merges = []
    cost = {}
    mean = {i: x[i] for i in groups}
    for a in groups:
        for b in groups:
            if a < b:
                cost[a, b] = 0.5 * ((x[a] - x[b]) ** 2).sum()
    while len(groups) > 1:
        (a, b), c = min(cost.items(), key=lambda e: (e[1], e[0]))
        merges.append((a, b, math.sqrt(2 * c)))
        n, m = len(groups[a]), len(groups[b])
        mean[a] = (n * mean[a] + m * mean[b]) / (n + m)
        groups[a] += groups.pop(b)
        cost = {k: v for k, v in cost.items() if a not in k and b not in k}
        for o in groups:
            if o != a:
                w = len(groups[o]) * len(groups[a]) / (len(groups[o]) + len(groups[a]))
                cost[min(a, o), max(a, o)] = w * ((mean[a] - mean[o]) ** 2).sum()

    def labels(k):
        own = list(range(len(x)))
        for a, b, _ in merges[:len(x) - k]:
            own = [a if v == b else v for v in own]
        return own
    return [h for _, _, h in merges], labels


@pytest.mark.parametrize(("finish", "cell"), [(1024, 512), (150, 16)])
def test_ward_equals_the_greedy_hierarchy(spark, monkeypatch, finish, cell):
    monkeypatch.setattr(ward, "FINISH", finish)
    monkeypatch.setattr(metric, "CELL", cell)
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, 0.4, (100, 5)) for c in (0.0, 1.5, 4.0)])
    profiles, columns, ids = _frame(spark, x)
    heights, labels = _ward(x)
    tree = ward.merge_tree(ward.kinds_of(profiles, columns))
    found = tree.orderBy("height").collect()
    assert np.allclose([r["height"] for r in found], sorted(heights), atol=1e-6)
    for k in (3, 40):
        own = {r["id"]: r["cluster"] for r in ward.cut_tree(tree, k).collect()}
        assert [own.get(i, i) for i in ids] == [ids[v] for v in labels(k)]


def test_ward_counts_equal_profiles(spark, monkeypatch):
    monkeypatch.setattr(ward, "FINISH", 2)
    rng = np.random.default_rng(6)
    kinds = rng.normal(0, 1, (9, 3))
    x = kinds[rng.integers(0, 9, 60)]
    profiles, columns, ids = _frame(spark, x)
    _, labels = _ward(x)
    got = {r["pid"]: r["cluster"] for r in ward.ward(profiles, columns, 4).collect()}
    assert [got[i] for i in ids] == [ids[v] for v in labels(4)]
    assert len({r["cluster"] for r in ward.ward(profiles, columns, 50).collect()}) == len(np.unique(x, axis=0))
    assert ward.ward(profiles.limit(0), columns, 3).count() == 0


def test_ward_merges_mutual_neighbours_and_keeps_order_with_ties(spark, monkeypatch):
    monkeypatch.setattr(ward, "FINISH", 4)
    rng = np.random.default_rng(7)
    profiles, columns, _ = _frame(spark, rng.integers(0, 2, (120, 6)).astype(float))
    kinds = ward.kinds_of(profiles, columns)
    tree = ward.merge_tree(kinds).collect()
    assert sorted(r["right"] for r in tree) == sorted(r["id"] for r in kinds.collect())[1:]
    size, top = {r["id"]: (r["n"], 0.0) for r in kinds.collect()}, 0.0
    for r in sorted(tree, key=lambda r: r["step"]):
        (n, a), (m, b) = size[r["left"]], size.pop(r["right"])
        assert r["left"] < r["right"] and r["n"] == n + m and r["height"] >= max(a, b)
        size[r["left"]] = (n + m, r["height"])
        top = max(top, r["height"])
    assert len(size) == 1 and top > 0


def _density(x, n, min_samples, radius):
    """DBSCAN without border rows: {row: smallest row of its cluster} by plain search."""
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), 9)
    core = [i for i in range(len(x)) if n[d[i] <= radius].sum() >= min_samples]
    label = {}
    for i in core:
        if i not in label:
            todo = [i]
            while todo:
                j = todo.pop()
                if j not in label:
                    label[j] = i
                    todo += [o for o in core if d[j, o] <= radius]
    return label


@pytest.mark.parametrize(("cell", "few", "kind"), [(512, 4096, "numeric"), (16, 0, "flags")])
def test_density_at_all_radii_from_one_tree(spark, monkeypatch, cell, few, kind):
    monkeypatch.setattr(metric, "CELL", cell)
    monkeypatch.setattr(reach, "FEW", few)
    rng = np.random.default_rng(8)
    if kind == "numeric":
        x = np.concatenate([rng.normal(c, 0.3, (50, 3)) for c in (0, 2, 6)] + [rng.uniform(-4, 10, (20, 3))])
        radii = [0.4, 0.8]
    else:
        x, radii = rng.integers(0, 2, (160, 7)).astype(float) * (rng.random((160, 7)) < 0.6), [1.0, 1.5]
    profiles, columns, ids = _frame(spark, x)
    kinds, back = np.unique(x, axis=0, return_inverse=True)
    first = [min(ids[i] for i in np.flatnonzero(back == j)) for j in range(len(kinds))]
    n = np.bincount(back)
    order = np.argsort(first)
    got = reach.density_levels(profiles, columns, 6, radii)
    rows = {(r["pid"], r["radius"]): r["cluster"] for r in got.collect()}
    assert len(rows) == len(ids) * len(radii)
    for r in radii:
        label = _density(kinds[order], n[order], 6, r)
        place = {int(j): i for i, j in enumerate(order)}
        want = [first[order[label[place[j]]]] if place[j] in label else -1 for j in back.ravel().tolist()]
        assert [rows[i, r] for i in ids] == want
    if kind == "flags":
        return
    large = reach.density_levels(profiles, columns, 6, radii[1:2], min_size=30).groupBy("cluster").count().where("cluster >= 0").collect()
    assert all(r["count"] >= 30 for r in large)


def test_density_gathers_no_vectors_at_the_driver(spark, monkeypatch):
    """Rows are dealt to cells once, and no join of vectors or of all rows is a broadcast."""
    dealt, plans, deal, cut = [], [], metric.deal, reach.cut_plan
    monkeypatch.setattr(metric, "deal", lambda rows: dealt.append(1) or deal(rows))

    def stored(df):
        plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return cut(df)
    monkeypatch.setattr(reach, "cut_plan", stored)
    monkeypatch.setattr(reach, "FEW", 0)
    x = np.random.default_rng(11).integers(0, 2, (120, 8)).astype(float)
    profiles, columns, ids = _frame(spark, x)
    found = reach.density_levels(profiles, columns, 4, [1.0, 1.5, 1.5])
    assert found.count() == 3 * len(ids)
    plans.append((["x"], found._jdf.queryExecution().executedPlan().toString()))
    assert len(dealt) == 1 and any("SortMergeJoin" in p for _, p in plans)
    assert not [c for c, p in plans if "BroadcastHashJoin" in p and ("x" in c or "id" in c)]


def test_density_key_may_be_named_as_its_own_columns(spark):
    profiles, columns, ids = _frame(spark, np.zeros((5, 2)))
    found = reach.density_levels(profiles.withColumnRenamed("pid", "id"), columns, 4, [1.0], "id", min_size=2)
    assert sorted((r["id"], r["radius"], r["cluster"]) for r in found.collect()) == [(i, 1.0, 100) for i in ids]


def test_spanning_tree_weighs_as_little_as_any(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(0, 1, (80, 4))
    profiles, columns, _ = _frame(spark, x)
    tree, cores = reach.spanning_tree(ward.kinds_of(profiles, columns), 4)
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), 9)
    core = np.sort(d, 1)[:, 3]
    assert np.allclose([r["core"] for r in cores.orderBy("id").collect()], core)
    w = np.maximum(np.maximum(d, core[None]), core[:, None])
    inside, least, total = {0}, w[0].copy(), 0.0
    while len(inside) < len(x):  # Prim
        j = min((i for i in range(len(x)) if i not in inside), key=lambda i: least[i])
        total += least[j]
        inside.add(j)
        least = np.minimum(least, w[j])
    assert tree.count() == 79 and abs(tree.agg(F.sum("w")).first()[0] - total) < 1e-6


@pytest.mark.parametrize(("dims", "k", "cell"), [(8, 5, 512), (8, 40, 16), (20, 300, 16), (20, 1000, 64)])
def test_votes_in_many_dimensions(spark, monkeypatch, dims, k, cell):
    monkeypatch.setattr(metric, "CELL", cell)
    rng = np.random.default_rng(10)
    train = np.round(rng.normal(0, 1, (350, dims)), 0 if dims == 8 else 2)
    labels = rng.integers(0, 5, 350)
    points = np.concatenate([train[:40], rng.normal(0, 2, (40, dims))])
    columns = [f"f{i}" for i in range(dims)]
    ddl = ", ".join(f"{c} double" for c in columns)
    left = spark.createDataFrame([(*map(float, v), int(c)) for v, c in zip(train, labels, strict=True)] + [(*[None] * dims, 1)], ddl + ", label int")
    right = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(points)] + [(999, *[None] * dims)], "id long, " + ddl)
    got = {r["id"]: (r["prediction"], r["voters"]) for r in classifiers.nearest_profile_vote(left, right, columns, "label", k, "id").collect()}
    want = {}
    for i, p in enumerate(points):
        d = np.round(np.sqrt(((train - p) ** 2).sum(1)), 9)
        last = np.sort(d)[min(k, len(d)) - 1]
        votes = Counter(labels[d <= last].tolist())
        want[i] = (min(votes, key=lambda c: (-votes[c], c)), sum(votes.values()))
    assert got == want


def test_lambdas_of_a_small_session_by_hand(spark):
    rows = spark.createDataFrame([(1, 0, 0.5, 0), (1, 1, 0.2, 3), (1, 2, 0.1, 0), (2, 0, 0.0, 0), (2, 1, 0.0, 0)], "sid long, pos int, score double, rel int")
    got = {(r["sid"], r["pos"]): (r["rank"], r["lambda"], r["weight"]) for r in lambdas.lambda_gradients(rows, ["pos"]).collect()}
    disc = lambda k: 1 / math.log2(k + 1)
    ideal = 7 * disc(1)
    above = (1 / (1 + math.exp(0.2 - 0.5)), 7 * (disc(1) - disc(2)) / ideal)
    below = (1 / (1 + math.exp(0.2 - 0.1)), 7 * (disc(2) - disc(3)) / ideal)
    want = {(1, 0): (1, -above[0] * above[1], above[0] * (1 - above[0]) * above[1]),
            (1, 2): (3, -below[0] * below[1], below[0] * (1 - below[0]) * below[1])}
    want[1, 1] = (2, -want[1, 0][1] - want[1, 2][1], want[1, 0][2] + want[1, 2][2])
    want |= {(2, 0): (1, 0.0, 0.0), (2, 1): (2, 0.0, 0.0)}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k] == pytest.approx(w, abs=1e-12)


def _trips(seed, sessions):
    """Plans of which the one of middling eta is clicked: no weight per feature can say that."""
    rng, rows = np.random.default_rng(seed), []
    for s in range(sessions):
        n = int(rng.integers(4, 8))
        eta, price = rng.uniform(0, 10, n), rng.uniform(0, 10, n)
        worth = -np.abs(eta - 5) - 0.5 * np.abs(price - 3) + rng.normal(0, 0.2, n)
        rows += [(s, j + 1, j, float(eta[j]), float(price[j]), int(worth.argmax()) + 1) for j in range(n)]
    return rows


def test_lambda_ranker_beats_linear_pairs(spark):
    ddl = "sid long, transport_mode int, pos int, eta double, price double, click_mode int"
    rows = lambdas.with_relevance(spark.createDataFrame(_trips(1, 500), ddl)).cache()
    train, test = rows.where("sid % 3 <> 0"), rows.where("sid % 3 = 0")
    model = lambdas.fit_lambda(train.where("sid % 3 = 1"), ["eta", "price"], ["pos"], rounds=12, held=train.where("sid % 3 = 2"))
    ours = lambdas.ndcg(model.score(test), ["pos"])
    weights = ranker.fit_pairwise(train, ["eta", "price"])
    linear = lambdas.ndcg(test.withColumn("score", ranker.linear_score(weights)), ["pos"])
    assert 1 <= len(model.trees) <= 12
    assert ours > linear + 0.1 and ours > 0.8
    with pytest.raises(ValueError, match="relevant"):
        lambdas.fit_lambda(train.withColumn("rel", F.lit(0)), ["eta"], ["pos"])


def test_ndcg_of_known_orders(spark):
    rows = spark.createDataFrame([(1, 0, 3.0, 3), (1, 1, 2.0, 0), (2, 0, 3.0, 0), (2, 1, 2.0, 3), (3, 0, 1.0, 0)], "sid long, pos int, score double, rel int")
    assert lambdas.ndcg(rows, ["pos"]) == pytest.approx((1 + 1 / math.log2(3)) / 2)
    assert lambdas.ndcg(rows, ["pos"], k=1) == pytest.approx(0.5)
    assert lambdas.ndcg(rows.where("sid = 3"), ["pos"]) is None
