"""Properties and brute-force checks of ranks, samples, folds, neighbours, components and models."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfold.functions.digest import digest60
from wayfold.learn import classifiers, clusters, cross_validation, decompose, ranker, stacking
from wayfold.operators import context, folds, quality, ranks, sampling, scoring, summaries


def numbers(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "sid long, v long")


@pytest.mark.parametrize("spread", [1, 7, 10**12])
def test_cut_points_through_several_passes(spark, spread):
    rng = random.Random(spread)
    # a third of the rows share one value
    values = [rng.randrange(spread) for _ in range(600)] + [spread // 2] * 300
    df = numbers(spark, values).repartition(5)
    want = sorted((v, i) for i, v in enumerate(values))
    at = [0, 1, 449, 450, 899]
    assert ranks.cut_points(df, ["v", "sid"], at, small=3) == {r: want[r] for r in at}


def test_cut_points_refuse_a_rank_outside(spark):
    with pytest.raises(ValueError):
        ranks.cut_points(numbers(spark, [1]), ["v", "sid"], [1])


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    values = rng.normal(size=501)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").union(spark.createDataFrame([(None,)], "v double"))
    got = ranks.quantiles(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0])
    assert np.allclose(got, np.quantile(values, [0.0, 0.25, 0.5, 0.9, 1.0]))
    assert ranks.quantiles(df.where("v IS NULL"), "v", [0.5]) == [None]


def test_dense_index_with_many_buckets(spark):
    df = spark.range(3000).select(F.col("id").alias("sid"), F.when(F.col("id") % 3 > 0, 1).otherwise(2).alias("g"))
    df = df.withColumn("h", digest60("sid"))
    got = ranks.dense_index(df, "h", ["sid"], by=["g"], per_bucket=20).collect()
    for g in (1, 2):
        of = sorted((r["h"], r["sid"]) for r in got if r["g"] == g)
        assert {r["sid"]: r["idx"] for r in got if r["g"] == g} == {sid: i for i, (_, sid) in enumerate(of)}


def test_running_totals_over_blocks(spark):
    df = spark.createDataFrame([(k, k % 5 + 1) for k in range(-40, 500, 3)], "k long, n long").repartition(4)
    got = {r["k"]: r["total"] for r in ranks.running_totals(df, "k", "n", per_block=7).collect()}
    total = 0
    for k in range(-40, 500, 3):
        total += k % 5 + 1
        assert got[k] == total


def test_time_split_puts_unknown_times_last(spark):
    df = spark.sql("SELECT id AS sid, IF(id < 2, NULL, TIMESTAMP_NTZ'2018-10-01 00:00:00') AS req_time FROM range(10)")
    got = {r["sid"]: r["split"] for r in ranks.split_by_time(df, 0.8).collect()}
    assert [s for s, p in got.items() if p == "test"] == [0, 1]
    assert set(r["split"] for r in ranks.split_by_time(df, 1.0).collect()) == {"train"}


def test_split_keeps_sessions_together_without_one_time(spark):
    df = spark.sql("SELECT id % 5 AS sid, TIMESTAMP_NTZ'2018-10-01 00:00:00' + make_dt_interval(id) AS req_time FROM range(20)")
    out = ranks.split_sessions_by_time(df, 0.8, one_time=False)
    assert out.count() == 20
    assert {r[0]: r[1] for r in out.select("sid", "split").distinct().collect()} == {0: "train", 1: "train", 2: "train", 3: "train", 4: "test"}


def _classes(spark, n=900):
    return spark.range(n).select(F.col("id").alias("sid"), F.when(F.col("id") % 3 == 0, 2).otherwise(F.col("id") % 7 + 3).cast("int").alias("click_mode"))


def test_samples_have_exact_sizes_and_leave_others(spark):
    df = _classes(spark)
    sizes = sampling.class_sizes(df, "click_mode")
    for out, want in ((sampling.sample_half(df, 2), sizes[2] // 2), (sampling.sample_double(df, 2), 2 * sizes[2]),
                      (sampling.sample_down(df, 2, 0.3), math.floor(sizes[2] * 0.3)), (sampling.sample_amount(df, 2, 1234), 1234),
                      (sampling.sample_percentage(df, 2, 30), int(30 * 0.01 * sizes[2]) + 1),
                      (sampling.sample_like(df, 2, 4), sizes[4]), (sampling.sample_like(df, 4, 2), None)):
        after = sampling.class_sizes(out, "click_mode")
        if want is None:
            assert after == {**sizes, 4: sizes[2]}
        else:
            assert after == {**sizes, 2: want}


def test_same_seed_same_rows_under_any_partitioning(spark):
    df = _classes(spark)
    rows = lambda d, seed: sorted(tuple(r) for r in sampling.rebalance(d, {2: 100, 3: 50}, seed=seed).collect())
    assert rows(df, 1) == rows(df.repartition(7), 1) != rows(df, 2)


def test_keeping_more_than_there_are_is_an_error(spark):
    with pytest.raises(ValueError):
        sampling.keep_exactly(_classes(spark, 30), "click_mode", {2: 1000})


def test_folds(spark):
    df = _classes(spark)
    equal = folds.folds_equal(df, 5)
    assert Counter(r["fold"] for r in equal.collect()) == {i: 180 for i in range(5)}
    assert quality.check_folds(equal, df).first()["ok"]
    assert not quality.check_folds(equal.where("fold > 0"), df).first()["ok"]
    with pytest.raises(ValueError):
        folds.folds_equal(df, 7)
    sizes = Counter((r["click_mode"], r["fold"]) for r in folds.folds_stratified(df, 4, "click_mode").collect())
    for mode, n in sampling.class_sizes(df, "click_mode").items():
        assert all(sizes[mode, f] in (n // 4, n // 4 + 1) for f in range(4))


def test_checks(spark):
    with pytest.raises(ValueError):
        quality.check_columns(spark.range(1), ["sid"])
    with pytest.raises(ValueError):
        quality.check_same_schema(spark.range(1), spark.range(1).select(F.col("id").cast("int")))
    assert not quality.check_row_count(spark.range(3), spark.range(4)).first()["same"]


def _places(rng, n, span):
    return [(round(115 + rng.random() * span, 2), round(39 + rng.random() * span, 2)) for _ in range(n)]


@pytest.mark.parametrize("span", [0.3, 2.0, 60.0])
def test_nearest_site_matches_brute_force(spark, span):
    rng = random.Random(int(span * 10))
    points, sites = _places(rng, 150, span), _places(rng, 12, span / 3)
    got = context.nearest(spark.createDataFrame(points, "x double, y double"), "x", "y",
                          spark.createDataFrame(sites, "a double, b double"), "a", "b").collect()
    assert len(got) == len(set(points))
    for r in got:
        assert r["dist"] == pytest.approx(min(math.dist((r["x"], r["y"]), s) for s in sites), abs=1e-12)


@pytest.mark.parametrize("k", [1, 5, 10_000])
def test_nearest_vote_matches_brute_force(spark, k):
    rng = random.Random(k)
    # a third of the training rows at one place
    train = [(*p, rng.randrange(3)) for p in _places(rng, 200, 2.0)] + [(116.0, 40.0, 1)] * 100
    points = _places(rng, 60, 2.5)
    got = classifiers.nearest_vote(spark.createDataFrame(train, "x double, y double, l int"),
                                   spark.createDataFrame(points, "x double, y double"), "x", "y", "l", k).collect()
    assert len(got) == len(set(points))
    for r in got:
        far = sorted((round(math.dist((r["x"], r["y"]), t[:2]), 9), t[2]) for t in train)
        edge = far[min(k, len(far)) - 1][0]
        votes = Counter(label for d, label in far if d <= edge)
        assert r["voters"] == sum(votes.values())
        assert r["prediction"] == min(votes, key=lambda v: (-votes[v], v))


def test_density_matches_brute_force(spark):
    rng = random.Random(4)
    people = [(i, *[int(rng.random() < 0.2) for _ in range(9)]) for i in range(60)] + [(100 + i, *[1] * 9) for i in range(20)]
    columns = [f"p{i}" for i in range(9)]
    got = {r["pid"]: r["cluster"] for r in clusters.density(
        spark.createDataFrame(people, ["pid", *columns]), columns, 6).collect()}
    near = {p[0]: [q[0] for q in people if sum(a != b for a, b in zip(p[1:], q[1:])) <= 1] for p in people}
    cores = {p for p, around in near.items() if len(around) >= 6}
    label = {p: p for p in cores}
    changed = True
    while changed:
        changed = False
        for p in cores:
            best = min(label[q] for q in near[p] if q in cores)
            changed, label[p] = changed or best < label[p], min(best, label[p])
    want = {p: label[p] if p in cores else min((label[q] for q in near[p] if q in cores), default=-1) for p in near}
    assert got == want and len(set(want.values())) > 1


def test_components_match_numpy(spark):
    rng = np.random.default_rng(1)
    x = (rng.random((80, 6)) < [0.9, 0.5, 0.4, 0.3, 0.2, 0.1]).astype(float)
    df = decompose.assemble(spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["pid", *"abcdef"]), list("abcdef"), "v")
    got = np.array([[r[f"c_{i}"] for i in range(3)] for r in decompose.add_components(df, "v", 6, 3, "c").orderBy("pid").collect()])
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(x @ vt[:3].T), atol=1e-6)
    assert np.all(np.diff(s) <= 0)
    model, signs = decompose.fit_svd(df, "v", 6, 3)
    axes = model.pc.toArray() * signs
    assert np.allclose(axes.T @ axes, np.eye(3), atol=1e-9)
    assert all(a[np.argmax(np.abs(a))] > 0 for a in axes.T)


def test_standardize_leaves_a_constant_column_centred(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in decompose.standardize(df, ["a", "b"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_metrics_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (3, 3)], "label int, prediction int")
    r = scoring.metrics(df).first()
    assert r["accuracy"] == r["weighted_recall"] == 0.75
    assert r["weighted_f1"] == pytest.approx((2 * 0.8 + 0 + 1) / 4)
    assert r["weighted_precision"] == pytest.approx((2 * 2 / 3 + 0 + 1) / 4)


def test_score_submission_reports_conflicts(spark):
    sub = spark.createDataFrame([(1, 2), (1, 3), (2, 2), (2, 2), (9, 1)], "sid long, prediction int")
    truth = spark.createDataFrame([(1, 2), (2, 2), (3, 1)], "sid long, label int")
    r = scoring.score_submission(sub, truth).first()
    assert (r["not_predicted"], r["not_labelled"], r["conflicting"], r["accuracy"]) == (1, 1, 1, 1.0)


def test_cluster_members_are_bounded_arrays(spark):
    df = spark.range(2500).select(F.col("id").alias("pid"), F.lit(0).alias("cluster"))
    got = summaries.cluster_members(df, block=400).collect()
    assert max(len(r["members"]) for r in got) == 400 and sum(len(r["members"]) for r in got) == 2500


def _planted(spark, sessions=300):
    rng = random.Random(2)
    rows = []
    for sid in range(sessions):
        modes = rng.sample(range(1, 12), 4)
        eta = {m: rng.randrange(100, 1000) for m in modes}
        clicked = min(modes, key=eta.get)
        rows += [(sid, m, pos, float(eta[m]), float(rng.random()), clicked, sid % 2) for pos, m in enumerate(modes)]
    return spark.createDataFrame(rows, "sid long, transport_mode int, pos int, eta double, noise double, click_mode int, fold int")


def test_ranker_finds_a_planted_rule(spark):
    rows = _planted(spark)
    scored = ranker.cv_ranker(rows, ["eta", "noise"], rounds=20)
    best = scoring.best_per_session(scored)
    hits = best.join(rows.select("sid", "click_mode").distinct(), "sid").where("transport_mode = click_mode").count()
    assert hits >= 290
    assert ranker.click_pairs(rows, ["eta"]).count() == 2 * 3 * 300


def test_kmodes_and_kmeans_find_planted_groups(spark):
    rng = random.Random(3)
    base = {0: [1] * 5 + [0] * 5, 1: [0] * 5 + [1] * 5}
    rows = [(i, *[b ^ (rng.random() < 0.05) for b in base[i % 2]]) for i in range(200)]
    columns = [f"p{i}" for i in range(10)]
    df = spark.createDataFrame([tuple(map(int, r)) for r in rows], ["pid", *columns])
    for found in (clusters.kmodes(df, columns, 2), clusters.kmeans(df, columns, 2), clusters.hierarchy(df, columns, 2)):
        got = {r["pid"]: r["cluster"] for r in found.collect()}
        agree = sum(got[i] == got[i % 2] for i in range(200))
        assert len(got) == 200 and got[0] != got[1] and agree >= 190
    best = clusters.sweep(df, columns, [2, 4]).orderBy(F.desc("silhouette")).first()
    assert best["k"] == 2


def test_cross_validation_and_stacking(spark):
    rng = random.Random(6)
    rows = [(i, rng.random(), rng.random(), i % 2) for i in range(400)]
    df = spark.createDataFrame([(s, a, b, f, 1 if a > 0.5 else (2 if b > 0.5 else 0)) for s, a, b, f in rows],
                               "sid long, a double, b double, fold int, click_mode int")
    oof = cross_validation.cv_classifier(df, ["a", "b"], classifiers.tree(3))
    assert oof.count() == 400 == oof.select("sid").distinct().count()
    sums = oof.select(sum(F.col(f"prob_{m}") for m in range(12)).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert sums[0] == pytest.approx(1.0) and sums[1] == pytest.approx(1.0)
    assert scoring.metrics(oof).first()["weighted_f1"] > 0.9
    boosted = cross_validation.cv_classifier(df, ["a", "b"], classifiers.boosted(rounds=2, depth=2))
    assert scoring.metrics(boosted).first()["accuracy"] > 0.8
    stacked = stacking.stack_features({"x": oof, "y": boosted}, df)
    assert "fold" not in " ".join(stacked.columns)
    assert scoring.metrics(stacking.stack_fit(stacked, df, classifiers.tree(3))).first()["accuracy"] > 0.8
