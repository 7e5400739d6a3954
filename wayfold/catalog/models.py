"""Models: cross-validated classifiers, rankers, stacking and clusters."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import functions as F

from wayfold import bindings as B
from wayfold.bindings import oracle
from wayfold.catalog import register
from wayfold.catalog.scalars import coords_of, rounded
from wayfold.functions import clock, encode, planlists
from wayfold.functions.digest import BITS, digest60, digest60_sql
from wayfold.learn import classifiers, clusters, cross_validation, decompose, lambdas, ranker, reach, stacking, ward
from wayfold.operators import folds, joins, ranks, sampling, scoring
from wayfold.schemas import MODES, PROFILE_COLUMNS
from wayfold.session import cut_lineage, scratch_path

TRIP = ["o_long", "o_lat", "d_long", "d_lat", "weekday", "hour", "first_mode", "min_dist_mode", "min_price_mode", "min_eta_mode",
        "max_dist", "min_dist", "max_eta", "min_eta", "min_price", "mode_3_available", "mode_5_available", "mode_7_available"]


def _sessions(spark, d, k=2, marked=lambda table: table):
    """Labelled sessions with trip features, ``k`` shuffled folds and what ``marked`` adds, stored once as dealt by session."""
    base = clock.weekday_hour(coords_of(spark, d))
    base = base.join(B.plans_table(spark, d).drop("plan_time"), "sid", "left").join(
        B.clicks_table(spark, d).select("sid", "click_mode"), "sid", "left")
    parsed = base.withColumn("plans", planlists.parse_plans(F.col("plans")))
    wide = planlists.summarize(planlists.add_mode_flags(parsed)).withColumn("first_mode", planlists.first_mode(F.col("plans")))
    table = encode.label_response(wide).select("sid", "pid", "req_time", "click_mode", *TRIP)
    folded = folds.folds_shuffled(table, k, basis=table.select("sid"))
    return cut_lineage(cross_validation.dealt(marked(folded), "sid"))


def _plans(spark, d, k=2):
    """Deduplicated plan rows with click (0 without one), numeric price and mode flags; folds by session."""
    rows = ranks.first_per(B.plan_rows_table(spark, d), ["sid", "transport_mode"], ["pos", "distance", "eta", "price"])
    rows = rows.join(B.clicks_table(spark, d).select("sid", "click_mode"), "sid", "left")
    rows = rows.withColumn("click_mode", F.coalesce("click_mode", F.lit(0)))
    rows = rows.withColumn("price", F.coalesce(encode.number(F.col("price"), "int"), F.lit(0)))
    rows = encode.one_hot(rows, "transport_mode", MODES[1:], prefix="mode")
    return cut_lineage(rows.withColumn("fold", (digest60("sid", seed=3) % k).cast("int")))


_BITS = " || ".join(f"CAST({c} AS VARCHAR)" for c in PROFILE_COLUMNS)
PLAN = ["distance", "eta", "price", *[f"mode_{m}" for m in MODES[1:]]]


def _shown(predicted, *keys, classes=MODES, truth="label"):
    """What SQL can state of a table of predictions: its keys, the sum of the probabilities, that the largest is predicted,
    and that the weighted F1 is above that of the commonest class for all, which no constant model reaches."""
    predicted = cut_lineage(predicted)
    counted = {(r[truth], r["prediction"]): r["count"] for r in predicted.groupBy(truth, "prediction").count().collect()}
    probs = F.array(*[f"prob_{m}" for m in classes])
    total = F.round(F.aggregate(probs, F.lit(0.0), lambda a, p: a + p), 6)
    return predicted.select(*keys, total.alias("total"), (F.get(probs, F.col("prediction")) >= F.array_max(probs) - 1e-9).alias("top"),
                            F.lit(_f1(counted) > _f1(_constant(counted))).alias("better"))


def _constant(counted):
    """The counts if the commonest class were predicted for all."""
    sizes = {}
    for (label, _), n in counted.items():
        sizes[label] = sizes.get(label, 0) + n
    most = max(sizes, key=lambda c: (sizes[c], -c), default=0)
    return {(label, most): n for label, n in sizes.items()}


def _f1(counted):
    """Weighted F1 from counts by label and prediction."""
    total, found = sum(counted.values()), 0.0
    for label in {k for k, _ in counted}:
        hit = counted.get((label, label), 0)
        real, said = (sum(n for k, n in counted.items() if k[i] == label) for i in (0, 1))
        found += real / total * (2 * hit / (real + said) if hit else 0.0)
    return found


OOF = ("sid", "fold", "label")
_FOLDED = f"""SELECT sid, CAST(row_number() OVER (ORDER BY {digest60_sql('sid', seed=0)}, sid) > (count(*) OVER () + 1) // 2 AS INT) AS fold,
    CAST(coalesce(click_mode, 0) AS INT) AS label, CAST(1 AS DOUBLE) AS total, true AS top, true AS better FROM t_coords LEFT JOIN t_clicks USING (sid)"""
OOF_SQL = oracle("t_coords", "t_clicks", body=_FOLDED)


@register("cv_classifier", OOF_SQL)
def _(spark, d):
    return _shown(cross_validation.cv_classifier(_sessions(spark, d), TRIP, classifiers.logistic(rounds=10), scaled=True, laid=True), *OOF)


@register("clf_boosted", OOF_SQL)
def _(spark, d):
    table = _sessions(spark, d)

    def balance(train):
        """As many rows as the training part has, the same number of each class."""
        sizes = sampling.class_sizes(train, "click_mode")
        return cut_lineage(sampling.draw_exactly(train, "click_mode", {m: sum(sizes.values()) // len(sizes) for m in sizes}))
    return _shown(cross_validation.cv_classifier(table, TRIP, classifiers.boosted(rounds=3, depth=3, held=0.2), balance=balance), *OOF)


@register("clf_forest", OOF_SQL)
def _(spark, d):
    return _shown(cross_validation.cv_classifier(_sessions(spark, d), TRIP, classifiers.forest(trees=10, depth=5), laid=True), *OOF)


@register("clf_tree", oracle("t_coords", "t_clicks", body=f"SELECT t.*, depth FROM ({_FOLDED}) t CROSS JOIN (SELECT unnest([3, 5]) AS depth)"))
def _(spark, d):
    table = _sessions(spark, d)
    parts = [cross_validation.cv_classifier(table, TRIP, classifiers.tree(depth), laid=True).withColumn("depth", F.lit(depth)) for depth in (3, 5)]
    return _shown(parts[0].unionByName(parts[1]), *OOF, "depth")


@register("clf_mlp", oracle("t_coords", "t_clicks", body=f"SELECT t.*, layers FROM ({_FOLDED}) t CROSS JOIN (SELECT unnest([3, 4]) AS layers)"))
def _(spark, d):
    table = _sessions(spark, d)
    nets = [classifiers.net(len(TRIP), hidden, rounds=60) for hidden in (classifiers.SMALL_NET, classifiers.LARGE_NET)]
    found = cross_validation.cv_settings(table, TRIP, nets[0], [{nets[0].layers: n.getLayers()} for n in nets], scaled=True, laid=True)
    parts = [part.withColumn("layers", F.lit(len(n.getLayers()) - 2)) for part, n in zip(found, nets)]
    return _shown(parts[0].unionByName(parts[1]), *OOF, "layers")


@register("clf_knn", oracle("t_coords", "t_clicks", body="""WITH labelled AS (SELECT o_long, o_lat, click_mode FROM t_coords JOIN t_clicks USING (sid)),
    spots AS (SELECT o_long, o_lat, count(*) AS n FROM labelled GROUP BY ALL),
    places AS (SELECT DISTINCT o_long, o_lat FROM t_coords),
    pairs AS (SELECT p.o_long, p.o_lat, s.o_long AS sx, s.o_lat AS sy, n, round(sqrt((p.o_long - s.o_long) * (p.o_long - s.o_long)
    + (p.o_lat - s.o_lat) * (p.o_lat - s.o_lat)), 9) AS dist FROM places p CROSS JOIN spots s),
    reach AS (SELECT *, sum(n) OVER (PARTITION BY o_long, o_lat ORDER BY dist) AS upto, sum(n) OVER (PARTITION BY o_long, o_lat, dist) AS same FROM pairs),
    voters AS (SELECT o_long, o_lat, sx, sy FROM reach WHERE upto - same < 50),
    ballots AS (SELECT v.o_long, v.o_lat, click_mode, count(*) AS m FROM voters v JOIN labelled l ON l.o_long = sx AND l.o_lat = sy GROUP BY ALL)
    SELECT o_long, o_lat, arg_min(click_mode, -m * 100 + click_mode) AS prediction, CAST(sum(m) AS BIGINT) AS voters
    FROM ballots GROUP BY o_long, o_lat"""))
def _(spark, d):
    points = coords_of(spark, d)
    train = points.join(B.clicks_table(spark, d).select("sid", "click_mode"), "sid")
    return classifiers.nearest_vote(train, points, "o_long", "o_lat", "click_mode", 50)


@register("clf_knn_profiles", oracle("t_queries", "t_clicks", "t_profiles", body=f"""WITH users AS (SELECT pid, {_BITS} AS bits FROM t_profiles),
    votes AS (SELECT bits, click_mode, count(*) AS m FROM t_queries JOIN t_clicks USING (sid) JOIN users USING (pid) GROUP BY ALL),
    spots AS (SELECT bits, sum(m) AS n FROM votes GROUP BY bits), kinds AS (SELECT DISTINCT bits FROM users),
    pairs AS (SELECT k.bits, s.bits AS other, n, hamming(k.bits, s.bits) AS dist FROM kinds k CROSS JOIN spots s),
    reach AS (SELECT *, sum(n) OVER (PARTITION BY bits ORDER BY dist) AS upto, sum(n) OVER (PARTITION BY bits, dist) AS same FROM pairs),
    ballots AS (SELECT r.bits, click_mode, sum(m) AS m FROM reach r JOIN votes v ON v.bits = r.other WHERE upto - same < 200 GROUP BY ALL),
    chosen AS (SELECT bits, arg_min(click_mode, -m * 100 + click_mode) AS prediction, CAST(sum(m) AS BIGINT) AS voters FROM ballots GROUP BY bits)
    SELECT pid, prediction, voters FROM users JOIN chosen USING (bits)"""))
def _(spark, d):
    """The mode that the sessions of the users with the most similar profiles click, over all 66 attributes."""
    profiles = B.profiles_table(spark, d)
    clicked = B.queries_table(spark, d).select("sid", "pid").join(B.clicks_table(spark, d).select("sid", "click_mode"), "sid")
    train = joins.identified(clicked).join(profiles, "pid")
    return classifiers.nearest_profile_vote(train, profiles, PROFILE_COLUMNS, "click_mode", 200, "pid")


@register("hyper_grid")
def _(spark, d):
    make = partial(classifiers.boosted, rounds=2, held=0.2)
    grid = {"rate": [0.1, 0.3], "depth": [2, 3]}
    return rounded(cross_validation.hyper_grid(_sessions(spark, d), TRIP, make, grid, laid=True), ["weighted_f1", "accuracy"])


_RANK_FOLD = f"CAST({digest60_sql('sid', seed=3)} % 2 AS INT)"


@register("rank_pairwise", oracle("t_dedup", body=f"SELECT sid, {_RANK_FOLD} AS fold, transport_mode, true AS scored, true AS apart FROM t_dedup"))
def _(spark, d):
    scored = ranker.cv_ranker(_plans(spark, d), PLAN, rounds=10)
    finite = F.col("score").isNotNull() & ~F.isnan("score") & (F.abs("score") < float("inf"))
    # equal weights of zero, or any constant, would score all plans alike
    spread = scored.groupBy("fold").agg((F.stddev_pop("score") > 1e-9).alias("apart"))
    return scored.join(F.broadcast(spread), "fold").select("sid", "fold", "transport_mode", finite.alias("scored"), "apart")


# First scores for the gradients: distance and eta in exact binary fractions.
_FIRST_SCORE = "(eta % 64 - distance % 32) / CAST(32 AS DOUBLE)"
_FIRST_SHOWN = ["transport_mode"]


@register("rank_lambdas", oracle("t_dedup", "t_clicks", body=f"""WITH s AS (SELECT sid, transport_mode, {_FIRST_SCORE} AS score,
    CASE WHEN click_mode = transport_mode THEN 7.0 ELSE 0.0 END AS gain FROM t_dedup LEFT JOIN t_clicks USING (sid)),
    r AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY score DESC, transport_mode) AS rank,
          max(gain) OVER (PARTITION BY sid) AS ideal FROM s),
    p AS (SELECT a.sid, a.transport_mode, CASE WHEN a.gain > b.gain THEN 1 ELSE -1 END AS way,
          CASE WHEN a.gain > b.gain THEN 1 / (1 + exp(a.score - b.score)) ELSE 1 / (1 + exp(b.score - a.score)) END AS pull,
          abs((a.gain - b.gain) * (1 / log2(a.rank + 1) - 1 / log2(b.rank + 1))) / a.ideal AS swap
          FROM r a JOIN r b ON a.sid = b.sid AND a.gain <> b.gain)
    SELECT r.sid, r.transport_mode, CAST(rank AS INT) AS rank, round(coalesce(l, 0), 6) AS lambda, round(coalesce(w, 0), 6) AS weight
    FROM r LEFT JOIN (SELECT sid, transport_mode, sum(way * pull * swap) AS l, sum(pull * (1 - pull) * swap) AS w FROM p GROUP BY ALL) g
    ON r.sid = g.sid AND r.transport_mode = g.transport_mode"""))
def _(spark, d):
    """Lambda and derivative of every shown plan under a given first score."""
    rows = ranks.first_per(B.plan_rows_table(spark, d), ["sid", "transport_mode"], ["pos", "distance", "eta", "price"])
    rows = rows.join(B.clicks_table(spark, d).select("sid", "click_mode"), "sid", "left").withColumn("score", F.expr(_FIRST_SCORE))
    done = lambdas.lambda_gradients(lambdas.with_relevance(rows), _FIRST_SHOWN)
    return done.select("sid", "transport_mode", "rank", F.round(F.col("lambda") + 0.0, 6).alias("lambda"), F.round("weight", 6).alias("weight"))


@register("rank_lambda", oracle("t_dedup", "t_clicks", body=f"""SELECT {_RANK_FOLD} AS fold, count(DISTINCT sid) AS sessions, true AS better
    FROM t_dedup JOIN t_clicks USING (sid) WHERE click_mode = transport_mode GROUP BY 1"""))
def _(spark, d):
    """Per half of the sessions: do trees fitted to its lambdas order it better than no model does?"""
    rows = cut_lineage(lambdas.with_relevance(_plans(spark, d)))

    def judged(fold):
        own = rows.where(F.col("fold") == fold)
        model = lambdas.fit_lambda(own, PLAN, _FIRST_SHOWN, rounds=3, depth=4)
        before = lambdas.ndcg(own.withColumn("score", F.lit(0.0)), _FIRST_SHOWN)
        after = lambdas.ndcg(model.score(own), _FIRST_SHOWN)
        return fold, own.where("rel > 0").select("sid").distinct().count(), after > before

    with ThreadPoolExecutor(2) as pool:
        parts = list(pool.map(judged, (0, 1)))
    return spark.createDataFrame(parts, "fold int, sessions long, better boolean")


@register("rank_final_predict", oracle("t_dedup", body=f"SELECT sid, count(*) AS shown, true AS listed FROM t_dedup WHERE {_RANK_FOLD} = 1 GROUP BY sid"))
def _(spark, d):
    """Sessions of the other half, clicked or not, ranked by stored weights: is one of the modes shown on top?"""
    rows = _plans(spark, d)
    scored = ranker.final_fit_predict(rows.where("fold = 0"), rows.where("fold = 1").drop("click_mode"), PLAN, scratch_path(spark, "ranker"), rounds=10)
    best = scoring.best_per_session(scored, order=B.SHOWN).select("sid", F.col("transport_mode").alias("prediction"))
    listed = F.max(F.col("prediction") == F.col("transport_mode")).alias("listed")
    return scored.join(best, "sid").groupBy("sid").agg(F.count(F.lit(1)).alias("shown"), listed)


TEST_SQL = oracle("t_coords", body=f"""SELECT sid, CAST(1 AS DOUBLE) AS total, true AS top, true AS better FROM t_coords
    WHERE {digest60_sql('sid', seed=0)} >= {int(0.75 * 2**BITS)}""")


@register("final_fit_predict", TEST_SQL)
def _(spark, d):
    table = folds.split_random(_sessions(spark, d))
    train, test = table.where("split = 'train'"), table.where("split = 'test'")
    done = cross_validation.final_fit_predict(train, test, TRIP, classifiers.forest(10, 5), scratch_path(spark, "model"))
    return _shown(done.join(test.select("sid", F.col("click_mode").alias("label")), "sid"), "sid")


@register("stack_fit", OOF_SQL)
def _(spark, d):
    table = _sessions(spark, d)
    base = {f"depth{n}": cross_validation.cv_classifier(table, TRIP, classifiers.tree(n), laid=True) for n in (3, 5)}
    stacked = stacking.stack_features(base, B.clicks_table(spark, d), extra=table.select("sid", *TRIP))
    return _shown(stacking.stack_fit(stacked, table, classifiers.logistic(rounds=10), scaled=True), *OOF)


@register("stack_final_predict", TEST_SQL)
def _(spark, d):
    """Base models out of fold on the training sessions and refitted for the others; the second model is stored and predicts these."""
    table = _sessions(spark, d, marked=lambda rows: decompose.assemble(folds.split_random(rows), TRIP).drop("pid", "req_time", *TRIP))
    train, test = table.where("split = 'train'"), table.where("split = 'test'")
    clicks = B.clicks_table(spark, d)
    trip = lambda part: decompose.spread(part, TRIP).select("sid", *TRIP)
    base = {f"depth{n}": classifiers.tree(n) for n in (3, 5)}
    own = {name: cross_validation.cv_classifier(train, TRIP, one, laid=True, vector="features") for name, one in base.items()}
    new = {name: cross_validation.final_fit_predict(train, test, TRIP, one, scratch_path(spark, name), laid=True, vector="features")
           for name, one in base.items()}
    stacked = stacking.stack_features(own, clicks, extra=trip(train))
    unseen = stacking.stack_features(new, clicks, extra=trip(test)).drop("click_mode")
    done = stacking.stack_final(stacked, unseen, classifiers.logistic(rounds=10), scratch_path(spark, "stack"))
    return _shown(done.join(test.select("sid", F.col("click_mode").alias("label")), "sid"), "sid")


@register("predict_user_cluster", oracle("t_coords", "t_clicks", "t_profiles", body=f"""SELECT t.sid, fold, total, top, better FROM ({_FOLDED}) t
    JOIN t_coords c ON t.sid = c.sid JOIN t_profiles p ON c.pid = p.pid"""))
def _(spark, d):
    labels = clusters.kmeans(B.profiles_table(spark, d), PROFILE_COLUMNS, 4, rounds=5)
    table = cut_lineage(joins.identified(_sessions(spark, d)).join(labels, "pid"))
    found = cross_validation.cv_classifier(table, TRIP, classifiers.forest(5, 5), label="cluster", classes=range(4))
    return _shown(found, "sid", "fold", classes=range(4))


@register("rank_scores")
def _(spark, d):
    scored = ranker.cv_ranker(_plans(spark, d), PLAN, rounds=10).withColumn("score", F.round("score", 6))
    best = scoring.best_per_session(scored, order=B.SHOWN).withColumnRenamed("transport_mode", "prediction")
    truth = scored.select("sid", F.col("click_mode").alias("label")).distinct()
    return rounded(scoring.metrics(best.join(truth, "sid")), ["weighted_f1", "accuracy", "weighted_recall", "weighted_precision"])


@register("clu_kmeans")
def _(spark, d):
    return clusters.kmeans(B.profiles_table(spark, d), PROFILE_COLUMNS, 8)


@register("clu_sweep")
def _(spark, d):
    return rounded(clusters.sweep(B.profiles_table(spark, d), PROFILE_COLUMNS, [2, 4, 8, 16, 36], rounds=5), ["silhouette", "cost"])


@register("clu_kmodes")
def _(spark, d):
    return clusters.kmodes(B.profiles_table(spark, d), PROFILE_COLUMNS, 4, rounds=10)


@register("clu_hier")
def _(spark, d):
    return clusters.hierarchy(B.profiles_table(spark, d), PROFILE_COLUMNS, 8)


# What SQL can state of a hierarchy: a mean is its members' mean, and a cut has as many clusters as asked for.
@register("clu_ward", oracle("t_profiles", body=f"""WITH kinds AS (SELECT {_BITS} AS bits, min(pid) AS first, count(*) AS users FROM t_profiles GROUP BY 1)
    SELECT CAST(k AS INT) AS k, CAST(least(k, (SELECT count(*) FROM kinds)) AS BIGINT) AS clusters, (SELECT sum(users) FROM kinds)::BIGINT AS users,
    (SELECT min(first) FROM kinds) AS least, true AS named, true AS adds_up FROM (SELECT unnest([8, 36]) AS k)"""))
def _(spark, d):
    """Cuts of the Ward hierarchy: clusters, users, whether each is named after its smallest user and whether costs add up."""
    return _ward_cuts(B.profiles_table(spark, d))


def _ward_cuts(profiles):
    kinds = cut_lineage(ward.kinds_of(profiles, PROFILE_COLUMNS))
    tree = ward.merge_tree(kinds)
    total = tree.agg(F.sum(F.col("height") * F.col("height") / 2)).first()[0] or 0.0
    parts = []
    for k in (8, 36):
        named = kinds.join(ward.cut_tree(tree, k), "id", "left").withColumn("cluster", F.coalesce("cluster", "id"))
        # within a cluster: the sum of squares less the square of the sum over the count, per attribute
        cells = named.select("cluster", "id", "n", F.posexplode("x").alias("i", "v"))
        inner = cells.groupBy("cluster", "i").agg(F.sum(F.col("n") * F.col("v") * F.col("v")).alias("q"), F.sum(F.col("n") * F.col("v")).alias("s"),
                                                  F.sum("n").alias("n"), F.min("id").alias("least"))
        part = inner.groupBy("cluster").agg(F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("cost"), F.max("n").alias("n"), F.min("least").alias("least"))
        top = tree.orderBy(F.desc("height"), F.desc("step"), "left", "right").limit(k - 1).agg(F.sum(F.col("height") * F.col("height") / 2)).first()[0] or 0.0
        # what the merges below the cut have cost is what the clusters deviate from their means
        parts.append(part.agg(F.lit(k).alias("k"), F.count("*").alias("clusters"), F.sum("n").alias("users"), F.min("least").alias("least"),
                              F.min(F.col("cluster") == F.col("least")).alias("named"),
                              (F.abs(F.sum("cost") - F.lit(total - top)) <= 1e-6 * F.lit(total) + 1e-6).alias("adds_up")))
    return reduce(lambda a, b: a.unionByName(b), parts)




@register("clu_density", oracle("t_profiles", body=f"""WITH RECURSIVE users AS (SELECT pid, {_BITS} AS bits FROM t_profiles),
    kinds AS (SELECT bits, count(*) AS n, min(pid) AS first FROM users GROUP BY bits),
    near AS (SELECT a.bits, b.bits AS other, b.n FROM kinds a JOIN kinds b ON hamming(a.bits, b.bits) <= 1),
    cores AS (SELECT bits FROM near GROUP BY bits HAVING sum(n) >= 20),
    links AS (SELECT bits, other FROM near WHERE bits IN (FROM cores) AND other IN (FROM cores)),
    reach AS (SELECT bits, bits AS other FROM cores UNION SELECT r.bits, l.other FROM reach r JOIN links l ON r.other = l.bits),
    named AS (SELECT r.bits, min(first) AS cluster FROM reach r JOIN kinds k ON r.other = k.bits GROUP BY r.bits),
    border AS (SELECT near.bits, min(cluster) AS cluster FROM near JOIN named ON near.other = named.bits GROUP BY near.bits)
    SELECT pid, coalesce(n.cluster, b.cluster, -1) AS cluster FROM users u LEFT JOIN named n ON u.bits = n.bits
    LEFT JOIN border b ON u.bits = b.bits"""))
def _(spark, d):
    return clusters.density(B.profiles_table(spark, d), PROFILE_COLUMNS, 20)


_RADII = [3.5, 3.8, 4.0]
_CORE_AT = "(SELECT bits, min(dist) AS core FROM (SELECT bits, dist, sum(n) OVER (PARTITION BY bits ORDER BY dist) AS upto FROM near) WHERE upto >= 20 GROUP BY bits)"


@register("clu_density_levels", oracle("t_profiles", body=f"""WITH RECURSIVE users AS (SELECT pid, {_BITS} AS bits FROM t_profiles),
    kinds AS (SELECT bits, count(*) AS n, min(pid) AS first FROM users GROUP BY bits),
    near AS (SELECT a.bits, b.bits AS other, b.n, round(sqrt(hamming(a.bits, b.bits)), 9) AS dist FROM kinds a CROSS JOIN kinds b),
    core AS {_CORE_AT},
    radii AS (SELECT unnest([3.5, 3.8, 4.0])::DOUBLE AS radius),
    links AS MATERIALIZED (SELECT radius, n.bits, other FROM near n JOIN core a ON a.bits = n.bits JOIN core b ON b.bits = other
              JOIN radii ON dist <= radius AND a.core <= radius AND b.core <= radius),
    reach AS (SELECT radius, core.bits, core.bits AS other FROM core JOIN radii ON core <= radius
              UNION SELECT r.radius, r.bits, l.other FROM reach r JOIN links l ON l.radius = r.radius AND l.bits = r.other),
    named AS (SELECT radius, r.bits, min(first) AS cluster FROM reach r JOIN kinds k ON k.bits = r.other GROUP BY ALL)
    SELECT pid, radius, coalesce(cluster, -1) AS cluster FROM users CROSS JOIN radii LEFT JOIN named USING (radius, bits)"""))
def _(spark, d):
    """Density clusters of the profiles at three radii, all from one spanning tree."""
    return reach.density_levels(B.profiles_table(spark, d), PROFILE_COLUMNS, 20, _RADII)


@register("cluster_table")
def _(spark, d):
    profiles = B.profiles_table(spark, d)
    return clusters.cluster_table({
        "kmeans_4": clusters.kmeans(profiles, PROFILE_COLUMNS, 4, rounds=5),
        "kmeans_16": clusters.kmeans(profiles, PROFILE_COLUMNS, 16, rounds=5),
        "hier_4": clusters.hierarchy(profiles, PROFILE_COLUMNS, 4, rounds=5)})
