"""Density clusters at all radii: a minimum spanning tree over mutual reachability, cut wherever wanted."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.learn.ward import kinds_of
from wayfold.operators import metric
from wayfold.session import cut_plan

#: With so many components at most, the edges that join them are handled in one place.
FEW = 4096


def _cores(kinds: DataFrame, placed: DataFrame, cells: metric.Cells, min_samples: int) -> DataFrame:
    near = metric.last_distances(kinds, placed, cells, min_samples)
    return near.select(F.col("query").alias("id"), F.when(F.col("n") >= min_samples, F.col("last")).otherwise(F.lit(float("inf"))).alias("core"))


def core_distances(kinds: DataFrame, min_samples: int) -> DataFrame:
    """``(id, core)``: the distance within which a row has ``min_samples`` users, its own included; infinite if there are fewer."""
    placed, cells = metric.deal(kinds)
    return _cores(kinds, placed, cells, min_samples)


def _outgoing(asking: DataFrame, placed: DataFrame, cells: metric.Cells) -> DataFrame:
    """``(id, to, w, comp, other)``: of every block the nearest row of another component by mutual reachability, within each query's ``bound``."""
    schema = pa.schema([("id", pa.int64()), ("to", pa.int64()), ("w", pa.float64()), ("comp", pa.int64()), ("other", pa.int64())])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids, own = left["id"].to_numpy(), right["id"].to_numpy()
        core, mine = left["core"].to_numpy(), right["core"].to_numpy()
        theirs, comp = left["comp"].to_numpy(), right["comp"].to_numpy()
        w = metric.squares(metric.matrix(right["x"]), metric.matrix(left["x"]))
        np.maximum(w, (core * core)[None], out=w)
        same = comp[:, None] == theirs[None]
        w[same] = np.inf
        least = np.maximum(w.min(1), mine * mine)
        # roots and rounding only for what may be the nearest; a row of the own component never is, even where all are infinitely far
        row, col = np.nonzero((w <= (least * (1 + 1e-8) + 2e-9 * np.sqrt(least) + 1e-18)[:, None]) & ~same)
        gap = np.where(np.isfinite(w[row, col]), np.round(np.sqrt(w[row, col]), metric.DIGITS), np.inf)
        gap = np.maximum(np.maximum(gap, core[col]), mine[row])
        order = np.lexsort((ids[col], gap, row))
        first = order[np.r_[True, row[order][1:] != row[order][:-1]]] if len(order) else order
        row, col, gap = row[first], col[first], gap[first]
        # beyond its bound a query has not seen all cells, so what it met there need not be the nearest
        some = gap <= right["bound"].to_numpy()[row]
        row, col = row[some], col[some]
        return pa.table([own[row], ids[col], gap[some], comp[row], theirs[col]], schema=schema)

    return metric.search(asking, placed, cells, lambda t, d: t["bound"].to_numpy(), compare, "id long, to long, w double, comp long, other long")


def _joined(best: DataFrame, comps: int) -> DataFrame:
    """``(comp, into)``: the component each one becomes part of, from one edge ``(comp, other)`` each."""
    if comps <= FEW:
        up = {r["comp"]: r["other"] for r in best.select("comp", "other").collect()}
        into = {}
        for c in up:
            path = []
            while c not in into and up[up[c]] != c:
                path.append(c)
                c = up[c]
            root = into.get(c, min(c, up[c]))
            into[c] = root
            into.update(dict.fromkeys(path, root))
        return best.sparkSession.createDataFrame(list(into.items()), "comp long, into long")
    # two components that chose the same edge point at one another: the smaller one is a root
    links = best.select("comp", F.col("other").alias("into"))
    back = links.select(F.col("comp").alias("into"), F.col("into").alias("_back"))
    links = cut_plan(links.join(back, "into").select("comp", F.when((F.col("_back") == F.col("comp")) & (F.col("comp") < F.col("into")), F.col("comp")).otherwise(
        F.col("into")).alias("into")))
    while True:
        further = links.select(F.col("comp").alias("into"), F.col("into").alias("_up"))
        links = cut_plan(links.join(further, "into").select("comp", F.col("_up").alias("into"), (F.col("_up") != F.col("into")).alias("_moved")))
        if links.where("_moved").isEmpty():
            return links.select("comp", "into")
        links = links.drop("_moved")


def _looked_up(rows: DataFrame, names: DataFrame, on: str | list[str], most: int | None = None, how: str = "inner") -> DataFrame:
    """The rows joined with ``names``, which the driver gathers only if they are ``most`` rows and those are few."""
    return rows.join(F.broadcast(names) if most is not None and most <= FEW else names.hint("merge"), on, how)


def spanning_tree(kinds: DataFrame, min_samples: int) -> tuple[DataFrame, DataFrame]:
    """Edges ``(a, b, w)`` and cores ``(id, core)`` of rows ``(id, x, n)``.

    An edge weighs the larger of its length and of its ends' core distances, so the rows that hang together by edges up to
    a radius are the density clusters of that radius, for every radius.  In each round every component takes its lightest
    edge outwards (grouped minimum; ties by ids, so that no circle closes).  A row keeps the nearest foreign row that it
    knows until that row's component becomes its own, and looks again only if it could still beat its component's best.

    Rows are dealt to cells once.  What changes from round to round are numbers, ``(id, to, w, comp, other)`` of every row;
    vectors meet them in one join a round, and no join gathers rows at the driver but names of few components.
    """
    placed, cells = metric.deal(kinds)
    cores = cut_plan(_cores(kinds, placed, cells, min_samples))
    points = cut_plan(_looked_up(placed, cores, "id"))
    now = points.withColumns({"comp": F.col("id"), "bound": F.lit(float("inf"))})
    comps, known, edges = points.count(), None, []
    while comps > 1:
        found = _outgoing(now.where("bound IS NOT NULL").select("id", "x", "core", "comp", "bound"), now.drop("bound"), cells)
        # rows that did not look or found nothing within the bound keep what they had, as a lower limit
        found = found.withColumn("old", F.lit(0))
        found = found if known is None else found.unionByName(known.withColumn("old", F.lit(1)))
        least = F.min(F.struct("old", "w", "to", "comp", "other")).alias("b")
        known = cut_plan(found.groupBy("id").agg(least).select("id", "b.to", "b.w", "b.comp", "b.other"))
        edge = F.struct("w", F.least("id", "to").alias("a"), F.greatest("id", "to").alias("b"), "other")
        best = cut_plan(known.where("comp <> other").groupBy("comp").agg(F.min(edge).alias("e")).select("comp", "e.other", "e.a", "e.b", "e.w"))
        edges.append(best.select("a", "b", "w"))
        into = _joined(best, comps)
        named = _looked_up(known, into, "comp", comps).drop("comp").withColumnRenamed("into", "comp")
        known = cut_plan(_looked_up(named, into.withColumnRenamed("comp", "other"), "other", comps).select("id", "to", "w", "comp", F.col("into").alias("other")))
        comps = into.select("into").distinct().count()
        if comps > 1:
            # what still leads outwards bounds the search; what a row knew before is the least it can find now
            bound = known.where("comp <> other").groupBy("comp").agg(F.min("w").alias("bound"))
            bounded = _looked_up(known, bound, "comp", comps, "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
            asking = bounded.select("id", "comp", F.when((F.col("comp") == F.col("other")) & (F.col("w") <= F.col("bound")), F.col("bound")).alias("bound"))
            now = cut_plan(_looked_up(points, asking, "id"))
    tree = points.sparkSession.createDataFrame([], "a long, b long, w double")
    for part in edges:
        tree = tree.unionByName(part.distinct())
    return cut_plan(tree), cores


def cut_levels(tree: DataFrame, cores: DataFrame, radii: Sequence[float], min_size: int = 1, sizes: DataFrame | None = None) -> DataFrame:
    """``(level, id, cluster)`` of the rows that are dense at the radius of that place in ``radii``; see :func:`cut_at`.

    All radii are followed in the same rounds.
    """
    def at(limit: str):
        return F.explode(F.array_compact(F.array(*[F.when(F.col(limit) <= F.lit(float(r)), F.lit(i)) for i, r in enumerate(radii)]))).alias("level")

    links = tree.select("a", "b", at("w"))
    both = cut_plan(links.select("level", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("l")).select("level", "l.a", "l.b"))
    named = cut_plan(cores.select(at("core"), "id").withColumn("cluster", F.col("id")))
    while True:
        beside = _looked_up(both, named.select("level", F.col("id").alias("b"), F.col("cluster").alias("theirs")), ["level", "b"]).groupBy("level", "a").agg(F.min("theirs").alias("theirs"))
        least = _looked_up(named, beside.withColumnRenamed("a", "id"), ["level", "id"], how="left").select("level", "id", "cluster", F.least("cluster", "theirs").alias("offer"))
        # the name's own row learns the smaller name too, so that paths halve
        told = least.select("level", F.explode(F.array("id", "cluster")).alias("id"), "offer").groupBy("level", "id").agg(F.min("offer").alias("offer"))
        taken = cut_plan(_looked_up(named, told, ["level", "id"]).select("level", "id", F.col("cluster").alias("before"), F.least("cluster", "offer").alias("cluster")))
        up = taken.select("level", F.col("id").alias("cluster"), F.col("cluster").alias("_up"))
        after = cut_plan(_looked_up(taken, up, ["level", "cluster"]).select("level", "id", "before", F.col("_up").alias("cluster")))
        named = after.select("level", "id", "cluster")
        if after.where("before <> cluster").isEmpty():
            break
    if min_size <= 1:
        return named
    counted = _looked_up(named, sizes, "id") if sizes is not None else named.withColumn("n", F.lit(1))
    large = counted.groupBy("level", "cluster").agg(F.sum("n").alias("n")).where(F.col("n") >= min_size).select("level", "cluster")
    return _looked_up(named, large, ["level", "cluster"], how="left_semi").select("level", "id", "cluster")


def cut_at(tree: DataFrame, cores: DataFrame, radius: float, min_size: int = 1, sizes: DataFrame | None = None) -> DataFrame:
    """``(id, cluster)`` of the rows that are dense at ``radius``: those joined by edges up to it, named after the smallest id.

    A cluster of fewer than ``min_size`` rows (users, with ``sizes`` ``(id, n)``) is none; rows of no cluster are left out.
    """
    return cut_levels(tree, cores, [radius], min_size, sizes).drop("level")


def density_levels(profiles: DataFrame, columns: Sequence[str], min_samples: int, radii: Sequence[float], key: str = "pid", min_size: int = 1) -> DataFrame:
    """``(pid, radius, cluster)`` for every radius from one tree; noise is -1.  Attributes may be any numbers; null counts as 0."""
    kinds = cut_plan(kinds_of(profiles, columns, key))
    tree, cores = spanning_tree(kinds, min_samples)
    levels = cut_levels(tree, cores, radii, min_size, kinds.select("id", "n"))
    # one row a kind, with its cluster at each radius; a vector crosses one join
    wide = levels.groupBy("id").agg(*[F.min(F.when(F.col("level") == i, F.col("cluster"))).alias(f"_{i}") for i in range(len(radii))])
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    owned = _looked_up(profiles.select(F.col(key), x.alias("x")), kinds.select("x", F.col("id").alias("_id")), "x")
    at = [F.struct(F.lit(float(r)).alias("radius"), F.coalesce(f"_{i}", F.lit(-1)).alias("cluster")) for i, r in enumerate(radii)]
    return _looked_up(owned.drop("x"), wide.withColumnRenamed("id", "_id"), "_id", how="left").select(key, F.inline(F.array(*at)))
