"""Ward hierarchy: clusters that are each other's nearest merge, all such pairs at once, round by round."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.operators import metric
from wayfold.session import cut_plan

#: So many clusters are merged to the end in one place: their means and counts, not their rows.
FINISH = 4096
TREE = "left long, right long, height double, n long, step int"


def kinds_of(profiles: DataFrame, columns: Sequence[str], key: str = "pid") -> DataFrame:
    """Distinct profiles ``(id, x, n)``: the smallest user, the attributes as doubles, the number of users; null counts as 0."""
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    return profiles.groupBy(x.alias("x")).agg(F.min(key).cast("long").alias("id"), F.count(F.lit(1)).alias("n")).select("id", "x", "n")


def _costs(q: np.ndarray, qn: np.ndarray, c: np.ndarray, cn: np.ndarray) -> np.ndarray:
    """What merging adds to the squared deviations from the means, to nine digits."""
    return np.round(metric.squares(q, c) * (qn[:, None] * cn[None] / (qn[:, None] + cn[None])), metric.DIGITS)


def _pair_costs(q: np.ndarray, qn: np.ndarray, c: np.ndarray, cn: np.ndarray) -> np.ndarray:
    """As :func:`_costs`, of the rows of both side by side."""
    total = np.zeros(len(q))
    for a, b in zip(q.T, c.T, strict=True):
        total += (a - b) * (a - b)
    return np.round(total * (qn * cn / (qn + cn)), metric.DIGITS)


def _cheapest(q: np.ndarray, qn: np.ndarray, own: np.ndarray, c: np.ndarray, cn: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of ``q`` that has another one in ``c`` its number, the cheapest other one and the cost, the smaller id on ties.

    A matrix product comes first: digits are worked out only for what may be the cheapest.
    """
    cost = metric.rough_squares(q, c)
    cost *= qn[:, None] * cn[None] / (qn[:, None] + cn[None])
    cost[own[:, None] == ids[None]] = np.inf
    off = metric.rough_error(q, c) * np.minimum(qn, cn.max()) + 2e-9
    row, col = np.nonzero((cost <= (cost.min(1) + 2 * off)[:, None]) & np.isfinite(cost))
    exact = _pair_costs(q[row], qn[row], c[col], cn[col])
    order = np.lexsort((ids[col], exact, row))
    first = order[np.diff(row[order], prepend=-1) != 0]
    return row[first], col[first], exact[first]


def _nearest(asking: DataFrame, clusters: DataFrame) -> DataFrame:
    """``(id, nn, cost)``: the cluster that is cheapest to merge with, the smaller id on ties."""
    placed, cells = metric.deal(clusters.select("id", "x", "n"))
    schema = pa.schema([("id", pa.int64()), ("nn", pa.int64()), ("cost", pa.float64())])
    ddl = "id long, nn long, cost double"

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids, own = left["id"].to_numpy(), right["id"].to_numpy()
        q, qn = metric.matrix(right["x"]), right["n"].to_numpy().astype(float)
        c, cn = metric.matrix(left["x"]), left["n"].to_numpy().astype(float)
        row, col, cost = _cheapest(q, qn, own, c, cn, ids)
        return pa.table([own[row], ids[col], cost], schema=schema)

    best = lambda df: df.groupBy("id").agg(F.min(F.struct("cost", "nn")).alias("b")).select("id", "b.nn", "b.cost")
    asking = asking.select("id", "x", "n")
    if len(cells.points) <= 8:
        return best(metric.search(asking, placed, cells, lambda t, d: np.full(len(d), np.inf), compare, ddl))
    # the own cell first: its best cost bounds how far a cheaper cluster may be, were it a single row
    near = best(metric.search(asking, placed, cells, lambda t, d: cells.least(d).min(1), compare, ddl))
    asking = asking.join(near.select("id", "cost"), "id", "left")

    def radius(t: pa.Table, d: np.ndarray) -> np.ndarray:
        n, cost = t["n"].to_numpy().astype(float), t["cost"].to_numpy(zero_copy_only=False).astype(float)
        return np.where(np.isnan(cost), np.inf, np.sqrt((cost + 1e-9) * (n + 1) / n) * (1 + 1e-9) + 1e-9)
    return best(metric.search(asking, placed, cells, radius, compare, ddl))


def _finish(clusters: DataFrame, step: int) -> list[tuple]:
    """The merges of the last few clusters, always the cheapest pair first."""
    rows = sorted(clusters.select("id", "x", "n", "height").collect(), key=lambda r: r["id"])
    if not rows:
        return []
    ids, n, high = [r["id"] for r in rows], np.array([float(r["n"]) for r in rows]), [r["height"] for r in rows]
    x = np.array([r["x"] for r in rows])
    out, alive = [], np.ones(len(ids), bool)
    near, least = np.zeros(len(ids), np.int64), np.full(len(ids), np.inf)

    def look(some: np.ndarray) -> None:
        """The cheapest partner of each of some clusters, the first one on ties: ids ascend."""
        there = np.flatnonzero(alive)
        for start in range(0, len(some), 256):
            part = some[start:start + 256]
            least[part] = np.inf
            row, col, cost = _cheapest(x[part], n[part], part, x[there], n[there], there)
            near[part[row]], least[part[row]] = there[col], cost

    look(np.arange(len(ids)))
    for _ in range(len(ids) - 1):
        a = int(least.argmin())
        a, b = min(a, int(near[a])), max(a, int(near[a]))
        high[a] = max(float(least[a]), high[a], high[b])
        out.append((ids[a], ids[b], float(np.sqrt(2 * high[a])), int(n[a] + n[b]), step))
        x[a] = (n[a] * x[a] + n[b] * x[b]) / (n[a] + n[b])
        n[a] += n[b]
        alive[b], least[b] = False, np.inf
        lost = np.flatnonzero(alive & ((near == a) | (near == b)))
        look(np.union1d(lost, [a]))
        # the merged cluster may cost others as little as the one they know
        others = np.flatnonzero(alive)
        cost = _costs(x[a:a + 1], n[a:a + 1], x[others], n[others])[0]
        better = (others != a) & ((cost < least[others]) | ((cost == least[others]) & (a < near[others])))
        near[others[better]], least[others[better]] = a, cost[better]
        step += 1
    return out


def merge_tree(kinds: DataFrame) -> DataFrame:
    """The Ward hierarchy of rows ``(id, x, n)``: one row per merge, ``(left, right, height, n, step)``.

    A cluster is named after its smallest id; ``right`` is absorbed by ``left``, so every id but the last is absorbed once.
    ``height`` is the distance of linkage tables, the root of twice what the merge adds to the squared deviations; no
    merge is lower than those below it.  Merges never come nearer to a third cluster than the nearer of their parts was,
    so all pairs of mutual neighbours may merge at once, and a neighbour once found stays until it merges itself: a round
    looks for new neighbours of the clusters that lost theirs only.  Clusters are rows ``(id, x, n)`` of mean and count;
    neighbours come from :mod:`wayfold.operators.metric`, and no table of pairs is kept.
    """
    clusters = cut_plan(kinds.select("id", "x", "n").withColumn("height", F.lit(0.0)))
    known, merges, step = None, [], 0
    while clusters.count() > FINISH:
        lost = clusters if known is None else clusters.join(known.select("id"), "id", "left_anti")
        found = _nearest(lost, clusters)
        known = cut_plan(found if known is None else known.unionByName(found))
        mutual = known.select(F.col("id").alias("nn"), F.col("nn").alias("id"))
        pairs = known.join(mutual, ["id", "nn"], "left_semi").where("id < nn").select(F.col("id").alias("left"), F.col("nn").alias("right"), "cost")
        side = lambda s: clusters.select(F.col("id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("x", "n", "height")])  # noqa: E731,B023
        joined = pairs.join(side("left"), "left").join(side("right"), "right")
        total = F.col("n_left") + F.col("n_right")
        mean = F.zip_with("x_left", "x_right", lambda a, b: (F.col("n_left") * a + F.col("n_right") * b) / (F.col("n_left") + F.col("n_right")))
        merged = cut_plan(joined.select("left", "right", F.greatest("cost", "height_left", "height_right").alias("cost"), mean.alias("x"), total.alias("n")))
        merges.append(merged.select("left", "right", F.sqrt(2 * F.col("cost")).alias("height"), "n", F.lit(step).alias("step")))
        gone = merged.select(F.explode(F.array("left", "right")).alias("id"))
        known = known.join(gone, "id", "left_anti").join(gone.withColumnRenamed("id", "nn"), "nn", "left_anti").select("id", "nn", "cost")
        clusters = cut_plan(clusters.join(gone, "id", "left_anti").unionByName(
            merged.select(F.col("left").alias("id"), "x", "n", F.col("cost").alias("height"))))
        step += 1
    tree = clusters.sparkSession.createDataFrame(_finish(clusters, step), TREE)
    for part in merges:
        tree = tree.unionByName(part)
    return cut_plan(tree)


def cut_tree(tree: DataFrame, k: int) -> DataFrame:
    """``(id, cluster)`` of every id that is absorbed when the highest ``k - 1`` merges are undone; others name themselves.

    Links to the absorbing cluster are followed two at a time, so the rounds grow with the logarithm of the depth.
    """
    undone = tree.orderBy(F.desc("height"), F.desc("step"), "left", "right").limit(k - 1).select("right")
    links = cut_plan(tree.join(F.broadcast(undone), "right", "left_anti").select(F.col("right").alias("id"), F.col("left").alias("cluster")))
    while True:
        further = links.select(F.col("id").alias("cluster"), F.col("cluster").alias("_up"))
        links = cut_plan(links.join(further, "cluster", "left").select("id", F.coalesce("_up", "cluster").alias("cluster"),
                                                                         F.col("_up").isNotNull().alias("_moved")))
        if links.where("_moved").isEmpty():
            return links.select("id", "cluster")
        links = links.drop("_moved")


def ward(profiles: DataFrame, columns: Sequence[str], k: int, key: str = "pid") -> DataFrame:
    """``(pid, cluster)``: the Ward hierarchy of the profiles cut at ``k`` clusters, each named after its smallest user.

    Equal profiles are one row with a count; with fewer kinds of profile than ``k`` every kind is a cluster.
    """
    kinds = cut_plan(kinds_of(profiles, columns, key))
    labels = cut_tree(merge_tree(kinds), k)
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    named = kinds.join(labels, "id", "left").select("x", F.coalesce("cluster", "id").alias("cluster"))
    return profiles.select(F.col(key), x.alias("x")).join(named, "x").select(key, "cluster")
