"""A session ranker by lambda gradients: boosted trees that push clicked plans up by what a swap would change in NDCG."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfold.learn.decompose import assemble
from wayfold.operators.joins import inside_fold, outside_fold
from wayfold.session import cut_lineage

#: Relevance of the clicked plan.
CLICKED = 3


def with_relevance(rows: DataFrame, clicked: int = CLICKED) -> DataFrame:
    return rows.withColumn("rel", F.when(F.col("click_mode") == F.col("transport_mode"), F.lit(clicked)).otherwise(F.lit(0)))


def _gain(rel: Column) -> Column:
    return F.pow(F.lit(2.0), rel) - 1


def _discount(rank: Column) -> Column:
    return 1 / F.log2(rank + 1.0)


def _ideal(rels: Column) -> Column:
    """DCG of the best order of a session's relevances."""
    ordered = F.reverse(F.array_sort(rels))
    return F.aggregate(F.transform(ordered, lambda r, i: _gain(r) * _discount(i + 1)), F.lit(0.0), lambda a, v: a + v)


def lambda_gradients(rows: DataFrame, order: Sequence[str], score: str = "score", session: str = "sid") -> DataFrame:
    """``rows`` with ``rank``, ``lambda`` and ``weight`` (its derivative), from the scores and ``rel`` of each session.

    Ranks follow the score, ties ``order``.  For a pair of which the first is more relevant, with ``d`` the difference of
    their scores, the pull is ``1 / (1 + exp(d))`` times what swapping the two would change in NDCG; the first gets it, the
    second its negative.  A session without a relevant row pulls nothing.  A session's rows are seen together, which is
    at most one per mode after :func:`wayfold.operators.ranks.first_per`; it is one shuffle by session, and no join.
    """
    whole = Window.partitionBy(session)
    ranked = rows.withColumn("rank", F.row_number().over(whole.orderBy(F.desc(score), *order)))
    me = F.struct(F.col(score).alias("s"), F.col("rel").alias("r"), F.col("rank").alias("k"))
    ranked = ranked.withColumn("_all", F.collect_list(me).over(whole))
    ideal = _ideal(F.transform("_all", lambda o: o["r"]))
    ranked = ranked.withColumn("_ideal", ideal)

    def swap(o: Column) -> Column:
        return F.abs((_gain(F.col("rel")) - _gain(o["r"])) * (_discount(F.col("rank")) - _discount(o["k"]))) / F.col("_ideal")

    def pull(o: Column) -> Column:  # the chance that the less relevant one of the two is above
        way = F.when(F.col("rel") > o["r"], F.lit(1.0)).otherwise(F.lit(-1.0))
        return 1 / (1 + F.exp(way * (F.col(score) - o["s"])))

    others = F.filter("_all", lambda o: o["r"] != F.col("rel"))
    up = F.aggregate(others, F.lit(0.0), lambda a, o: a + F.when(F.col("rel") > o["r"], F.lit(1.0)).otherwise(F.lit(-1.0)) * pull(o) * swap(o))
    bend = F.aggregate(others, F.lit(0.0), lambda a, o: a + pull(o) * (1 - pull(o)) * swap(o))
    return ranked.withColumn("lambda", up).withColumn("weight", bend).drop("_all", "_ideal")


def ndcg(rows: DataFrame, order: Sequence[str], k: int = 10, score: str = "score", session: str = "sid") -> float | None:
    """Mean NDCG at ``k`` over the sessions that hold a relevant row."""
    ranked = rows.withColumn("_k", F.row_number().over(Window.partitionBy(session).orderBy(F.desc(score), *order)))
    found = ranked.groupBy(session).agg(F.sum(F.when(F.col("_k") <= k, _gain(F.col("rel")) * _discount(F.col("_k"))).otherwise(F.lit(0.0))).alias("dcg"),
                                        F.collect_list("rel").alias("rels"))
    best = F.aggregate(F.transform(F.slice(F.reverse(F.array_sort("rels")), 1, k), lambda r, i: _gain(r) * _discount(i + 1)), F.lit(0.0), lambda a, v: a + v)
    return found.withColumn("best", best).where("best > 0").agg(F.avg(F.col("dcg") / F.col("best"))).first()[0]


class LambdaRanker:
    """Trees, each fitted to the lambdas that the ones before it leave; a leaf moves by its lambdas over their derivatives."""

    def __init__(self, features: Sequence[str], rate: float, trees: Sequence[DecisionTreeRegressionModel]) -> None:
        self.features, self.rate, self.trees = list(features), rate, list(trees)

    def score(self, rows: DataFrame) -> DataFrame:
        scored = assemble(rows, self.features).withColumn("score", F.lit(0.0))
        for tree in self.trees:
            scored = tree.transform(scored).withColumn("score", F.col("score") + self.rate * F.col("prediction")).drop("prediction")
        return scored.drop("features")


def fit_lambda(rows: DataFrame, features: Sequence[str], order: Sequence[str], rounds: int = 20, depth: int = 4, rate: float = 0.2, leaf: int = 5,
               seed: int = 1, held: DataFrame | None = None, patience: int = 5) -> LambdaRanker:
    """Fit to sessions ``rows`` with ``rel``; with ``held`` sessions, keep the trees up to their best NDCG@10.

    A round is one shuffle by session for the gradients and one distributed tree fit, whose leaf value is the weighted mean
    of lambda over derivative, that is the sum of the one over the sum of the other.
    """
    scored = cut_lineage(assemble(rows, features).select("sid", *order, "rel", "features", F.lit(0.0).alias("score")))
    trees, best = [], (-1.0, 0)
    for n in range(rounds):
        step = lambda_gradients(scored, order).where("weight > 0").select("features", "weight", (F.col("lambda") / F.col("weight")).alias("target"))
        if not n and step.isEmpty():
            raise ValueError("no session has a relevant row beside another")
        tree = DecisionTreeRegressor(labelCol="target", weightCol="weight", maxDepth=depth, minInstancesPerNode=leaf, seed=seed).fit(cut_lineage(step))
        trees.append(tree)
        scored = cut_lineage(tree.transform(scored).withColumn("score", F.col("score") + rate * F.col("prediction")).drop("prediction"))
        if held is not None:
            now = ndcg(LambdaRanker(features, rate, trees).score(held), order) or 0.0
            best = max(best, (now, -n))
            if n + best[1] >= patience:
                break
    return LambdaRanker(features, rate, trees[:1 - best[1]] if held is not None else trees)


def cv_lambda(rows: DataFrame, features: Sequence[str], order: Sequence[str], **how) -> DataFrame:
    """Out-of-fold score of every shown plan; ``rows`` carry their ``fold`` and ``click_mode``."""
    rows = with_relevance(rows)
    parts = [fit_lambda(outside_fold(rows, fold), features, order, **how).score(inside_fold(rows, fold))
             for fold in sorted(r[0] for r in rows.select("fold").distinct().collect())]
    return reduce(DataFrame.unionByName, parts)
