"""Odd values: infinities, NaN, one user, equal clusters, huge prices, null attributes, sparse keys, no shared folder."""

from __future__ import annotations

import math
import random

import pytest

from wayfold import session
from wayfold.functions import planlists
from wayfold.learn import clusters
from wayfold.operators import ranks, scoring, summaries


def test_quantiles_with_infinities(spark):
    rows = [(float(i),) for i in range(1001)] + [(math.inf,), (-math.inf,), (math.nan,), (None,)]
    df = spark.createDataFrame(rows, "v double")
    found = ranks._order_statistics(df, "v", [0, 1, 501, 1002], small=10)
    assert [found[r][0] for r in (0, 1, 501, 1002)] == [-math.inf, 0.0, 500.0, math.inf]


def test_quantiles_of_extreme_spread(spark):
    df = spark.createDataFrame([(x,) for x in [-1.7e308, 1.7e308] + [float(i) for i in range(50)]], "v double")
    assert ranks._order_statistics(df, "v", [25], small=5)[25][0] == 24.0
    big = spark.createDataFrame([(x,) for x in [-(2**63), 2**63 - 1, 2**62, 2**62 + 1, 2**62 + 2, 5, 6]], "v long")
    found = ranks._order_statistics(big, "v", range(7), small=1)
    assert [found[r][0] for r in range(7)] == [-(2**63), 5, 6, 2**62, 2**62 + 1, 2**62 + 2, 2**63 - 1]


@pytest.mark.parametrize(("users", "mean"), [([], None), ([7, 7, 7], 3.0), ([None], None)])
def test_activity_of_one_user_or_none(spark, users, mean):
    row = summaries.activity(spark.createDataFrame([(u,) for u in users], "pid long")).first()
    assert row["mean"] == mean and row["std"] is None


def test_silhouette_of_equal_clusters(spark):
    df = spark.createDataFrame([(c, [1.0, 2.0]) for c in (0, 0, 1, 1, 2)], "c int, x array<double>")
    assert scoring.silhouette(df, "x", "c").first()["silhouette"] == 0.0


def test_huge_prices(spark):
    text = '[' + ', '.join('{"distance": 1, "price": 2100000000, "eta": 1, "transport_mode": 1}' for _ in range(3)) + ']'
    df = spark.createDataFrame([(text,)], "plans string").withColumn("plans", planlists.parse_plans(planlists.F.col("plans")))
    row = planlists.summarize(df).first()
    assert row["mean_price"] == 2.1e9 and row["std_price"] == 0.0


def test_null_attributes(spark):
    rows = [(1, 0, None), (2, 0, None), (3, 0, 1), (4, 1, 0)]
    df = spark.createDataFrame(rows, "pid long, a int, b int")
    assert {r["pid"]: r["cluster"] for r in clusters.density(df, ["a", "b"], 2).collect()} == {1: 1, 2: 1, 3: 1, 4: -1}
    assert clusters.kmodes(df, ["a", "b"], 2).count() == 4
    with pytest.raises(Exception, match="not 0 or 1"):
        clusters.density(spark.createDataFrame([(1, -1)], "pid long, a int"), ["a"], 1).collect()


def test_running_totals_over_sparse_keys(spark):
    keys = [-(2**62), -5, 0, 3, 10**12, 2**62, 2**63 - 1]
    df = spark.createDataFrame([(k, i + 1) for i, k in enumerate(keys)], "k long, n long")
    got = {r["k"]: r["total"] for r in ranks.running_totals(df, "k", "n", per_block=2).collect()}
    assert got == {k: (i + 1) * (i + 2) // 2 for i, k in enumerate(keys)}


def test_no_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


@pytest.mark.parametrize(("shift", "spread"), [(1.5, 0.5), (0.0, 2.0), (900.0, 1.0), (0.0, 0.02)])
def test_nearest_far_and_dense(spark, shift, spread):
    import random

    from wayfold.operators import context

    draw = random.Random(3)
    places = [(116 + shift + draw.random() * spread, 40 + draw.random() * spread) for _ in range(150)]
    sites = [(round(116 + draw.random(), 2), round(39.5 + draw.random(), 2)) for _ in range(400)]
    p, s = spark.createDataFrame(places, "x double, y double"), spark.createDataFrame(sites, "a double, b double")
    got = {(r["x"], r["y"]): r["dist"] for r in context.nearest(p, "x", "y", s, "a", "b").collect()}
    assert got == {(x, y): pytest.approx(min(math.hypot(x - a, y - b) for a, b in sites), abs=1e-9) for x, y in places}
    cells = context.near_cells(p.toDF("_x", "_y"), s.toDF("_sx", "_sy").distinct().selectExpr("*", "1 AS _n")).groupBy("_x", "_y").count().agg({"count": "max"}).first()[0]
    assert cells <= 40


@pytest.mark.parametrize(("shift", "spread", "k"), [(30.0, 0.01, 5), (0.0, 0.001, 40), (0.0, 1.0, 25)])
def test_nearest_votes_far_and_dense(spark, shift, spread, k):
    import random

    from wayfold.learn import classifiers
    from wayfold.operators import context

    draw = random.Random(k)
    spots = sorted({(round(116 + draw.random() * spread, 6), round(40 + draw.random() * spread, 6)) for _ in range(600)})
    places = sorted({(round(116 + shift + draw.random(), 6), round(40 + draw.random(), 6)) for _ in range(60)} | set(spots[:60]))
    train = [(x, y, i % 3) for i, (x, y) in enumerate(spots)]
    got = classifiers.nearest_vote(spark.createDataFrame(train, "x double, y double, l int"),
                                   spark.createDataFrame(places, "x double, y double"), "x", "y", "l", k).collect()
    assert len(got) == len(places)
    for r in got:
        far = sorted(round(math.dist((r["x"], r["y"]), s), 9) for s in spots)
        assert r["voters"] == sum(f <= far[k - 1] for f in far)
    # the cells of a place grow with k, not with the spots
    counted = spark.createDataFrame([(*s, 1) for s in spots], "_sx double, _sy double, _n long")
    cells = context.near_cells(spark.createDataFrame(places, "_x double, _y double"), counted, k, classifiers.VOTE_FINEST,
                               context.FIRST_LEVEL + classifiers.VOTE_LEVELS)
    assert cells.groupBy("_x", "_y").count().agg({"count": "max"}).first()[0] <= 4 * k + 60


def test_districts_of_several_files_are_refused(spark, tmp_path):
    from wayfold.sources import readers

    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text("District,o_lat,o_long\nx,40.0,116.0\n")
    with pytest.raises(ValueError, match="several files"):
        readers.read_districts(spark, str(tmp_path))
    assert readers.read_districts(spark, str(tmp_path / "a.csv")).first()["idx"] == 0


def test_run_files_of_the_same_header_are_one_scan(spark, tmp_path):
    from wayfold.sources import readers

    for i in range(6):
        (tmp_path / f"run_{i}.csv").write_text(("a,b\n1,2\n", "a\n3\n")[i % 2])
    df = readers.read_matching(spark, str(tmp_path), "run")
    assert sorted((r["a"], r["b"]) for r in df.collect()) == sorted([("1", "2")] * 3 + [("3", None)] * 3, key=str)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2


def test_vector_of_many_values(spark):
    from wayfold.functions import encode

    df = spark.createDataFrame([(f"c{i % 1500:04d}",) for i in range(3000)] + [(None,)], "c string")
    hot = encode.one_hot_vector(df, "c", "v").collect()
    assert all(r["v"].size == 1501 and list(r["v"].indices) == [int(r["c"][1:]) if r["c"] else 1500] for r in hot)


def test_broken_folds_are_found(spark):
    from wayfold.operators import quality

    sids = spark.createDataFrame([(i,) for i in range(5)], "sid long")
    row = quality.check_folds(spark.createDataFrame([(0, 0), (0, 1), (1, 0), (2, 1), (9, 1)], "sid long, fold int"), sids).first()
    assert (row["repeated"], row["missing"], row["unknown"], row["ok"]) == (1, 2, 1, False)


def test_rows_with_split_and_components(spark, sf_dir):
    from wayfold import bindings as B
    from wayfold.plans import features

    tables = [B.queries_table(spark, sf_dir), B.plans_table(spark, sf_dir), B.clicks_table(spark, sf_dir), B.profiles_table(spark, sf_dir)]
    plain, full = features.features_row(*tables), features.features_row(*tables, components=True, share=0.8)
    assert {"split", "TFIDF_clustered_0", "PID_MainComp_0"} <= set(full.columns)
    assert full.count() == plain.count()
    per = full.groupBy("sid").agg({"split": "min", "req_time": "max"}).toDF("sid", "split", "t").groupBy("split").agg({"t": "min"}).collect()
    times = {r["split"]: r[1] for r in per}
    assert set(times) == {"train", "test"} and times["train"] < times["test"]


def test_few_and_many_stations_agree(spark, monkeypatch):
    from wayfold.operators import context

    draw = random.Random(5)
    points = [(i, 115 + draw.random() * 4, 39 + draw.random() * 2) for i in range(200)] + [(900, None, 39.5)]
    sites = [(f"s{i}", 39 + draw.random() * 2, 115 + draw.random() * 4) for i in range(60)] + [("gone", None, 116.0)]
    frame = spark.createDataFrame(points, "sid long, o_long double, o_lat double")
    stations = spark.createDataFrame(sites, "subway_name string, o_lat double, o_long double")
    found = []
    for few in (1024, 0):
        monkeypatch.setattr(context, "FEW_SITES", few)
        found.append({r["sid"]: r["dist_nearest_sub"] for r in context.add_nearest_station(frame, stations).collect()})
    assert found[0] == found[1] and found[0][900] is None and len(found[0]) == 201
