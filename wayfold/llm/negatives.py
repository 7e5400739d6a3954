"""Hard negatives: exact score windows around anchors, searched in a multiway hyperplane tree."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from wayfold.llm.frames import stored
from wayfold.llm.hypertree import SLACK, Tree, asked, lifted
from wayfold.llm.integers import Keys, exact, matrix, products

SCALE = 256
#: Rows that a leaf is meant to hold, and rows of a leaf that one task compares at a time; bounds of the tree and of the
#: sample it is built from; lengths of vector that get a tree (others have one leaf).
LEAF, BLOCK, LEAVES, SAMPLE, TREES = 4096, 8192, 4096, 8192, 8


class _Index:
    """The trees by length of vector, and how scores become keys and distances.

    For distances all components are divided by ``2 ** bits``, which none exceeds.
    """

    def __init__(self, rows: DataFrame) -> None:
        size = F.transform("x", lambda e: F.abs(e.cast("double")))
        known = rows.agg(F.max("dim"), F.max(F.array_max(size))).first()
        self.dim, largest = known[0] or 0, (int(known[1] or 0) + 1) * SCALE
        self.bits = largest.bit_length()
        self.keys = Keys(largest, self.dim or 1)
        self.trees: dict[int, Tree] = {}
        #: What all squared lengths are raised to: not less than any (a component of floor(256 x) is at most 256 |x| + 1).
        self.square: dict[int, float] = {}
        part = F.transform(size, lambda e: e * F.lit(2.0 ** (8 - self.bits)) + F.lit(2.0 ** -self.bits))
        square = F.aggregate(part, F.lit(0.0), lambda t, e: t + e * e)
        for r in rows.groupBy("dim").agg(F.count("*").alias("n"), F.max(square).alias("square")).orderBy(F.desc("n"), "dim").limit(TREES).collect():
            if r["n"] <= LEAF:
                continue
            hashed = F.pmod(F.xxhash64("vec_id"), F.lit(-(-r["n"] // SAMPLE)))
            some = rows.filter((F.col("dim") == r["dim"]) & (hashed == 0)).select("x").limit(2 * SAMPLE).toArrow()
            if some.num_rows:
                self.square[r["dim"]] = r["square"] * (1 + SLACK)
                u = self.scaled(exact(matrix(some["x"], r["dim"]), SCALE))
                self.trees[r["dim"]] = Tree(lifted(u, self.square[r["dim"]]), r["n"], max(LEAF, -(-r["n"] // LEAVES)))

    def scaled(self, v: np.ndarray) -> np.ndarray:
        if v.dtype == object:
            return np.array([e / 2**self.bits for e in v.ravel().tolist()]).reshape(v.shape)
        return np.ldexp(v, -self.bits)

    def ratio(self, score: int) -> float:
        """A score as an inner product of scaled vectors."""
        return score / 2 ** (2 * self.bits)

    def leaf_of(self, dim: int, x: np.ndarray, ranges: bool = False) -> np.ndarray:
        tree = self.trees.get(dim)
        return tree.route(lifted(self.scaled(exact(x, SCALE)), self.square[dim]), ranges) if tree else np.zeros(len(x), np.int64)

    def measure(self, routed: DataFrame) -> None:
        """Ranges of every split, from all rows: each partition's own, merged by grouping."""
        def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for dim, part in _by_dim(pa.Table.from_batches([batch])):
                    self.leaf_of(dim, matrix(part["x"], dim), True)
            out = [(dim, at, i, j, split.low[i, j], split.high[i, j]) for dim, tree in self.trees.items() for at, split in enumerate(tree.splits)
                   for i, j in zip(*np.nonzero(split.high >= 0), strict=True)]
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int32()] * 4 + [pa.float64()] * 2
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["dim", "at", "i", "j", "low", "high"])

        if self.trees:
            parts = routed.select("dim", "x").mapInArrow(ranges, "dim int, at int, i int, j int, low double, high double")
            for r in parts.groupBy("dim", "at", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
                split = self.trees[r["dim"]].splits[r["at"]]
                split.low[r["i"], r["j"]], split.high[r["i"], r["j"]] = r["low"], r["high"]


def _by_dim(rows: pa.Table) -> Iterator[tuple[int, pa.Table]]:
    dims = rows["dim"].to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, rows.filter(pa.array(dims == dim))


def participants(vectors: DataFrame, is_anchor: Column, *, vec_id: str, embedding: str, label: str) -> DataFrame:
    """``(vec_id, label, asks, dim, x)`` of the rows that take part: no null id or label, a vector of finite components."""
    kind = vectors.schema[embedding].dataType.elementType.simpleString()
    x = F.col(embedding) if kind in ("float", "double") else F.col(embedding).cast("array<double>")
    finite = lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False))
    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                          F.coalesce(is_anchor, F.lit(False)).alias("asks"), x.alias("x")).filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("x", finite) & (F.size("x") > 0), F.lit(False))).select(
        "vec_id", "label", "asks", F.size("x").alias("dim"), "x")


_WINDOW = pa.struct([("rank", pa.int32()), ("id", pa.int64()), ("key", pa.binary())])
_ASK = pa.schema([("anchor_id", pa.int64()), ("vkey", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("leaf", pa.int32()),
                  ("block", pa.int32()), ("x", pa.list_(pa.float64())), ("windows", pa.list_(_WINDOW))])
_ASK_DDL = ("anchor_id long, vkey long, label long, dim int, leaf int, block int, x array<double>, "
            "windows array<struct<rank: int, id: long, key: binary>>")
_KEYS = ["dim", "leaf", "block"]


def _sent(asking: DataFrame, sizes: dict[tuple[int, int], int], index: _Index, reach: Callable[[int], tuple[int | None, int | None]]) -> DataFrame:
    """Each query once for every block of the leaves that its annuli meet.

    ``reach`` turns the score of a window into its highest and lowest score (None: no limit).
    """
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dim(pa.Table.from_batches([batch])):
                u = index.scaled(exact(matrix(part["x"], dim), SCALE))
                square, own = index.square.get(dim, 0.0), np.einsum("ij,ij->i", u, u)
                windows = part["windows"].to_pylist()
                inner, outer = np.ones((2, len(u), max(1, max(map(len, windows)))))
                outer[:] = 0
                for i, w in enumerate(windows):
                    for j, one in enumerate(w):
                        most, least = reach(one["key"] and index.keys.score(one["key"]))
                        inner[i, j] = own[i] + square - 2 * index.ratio(most) if most is not None else -np.inf
                        outer[i, j] = own[i] + square - 2 * index.ratio(least) if least is not None else np.inf
                tree = index.trees.get(dim)
                hit = tree.meeting(asked(u), inner, outer, own + square) if tree else (outer >= inner).any(1)[:, None]
                for leaf in np.flatnonzero(hit.any(0)).tolist():
                    who = part.filter(pa.array(hit[:, leaf]))
                    for block in range(sizes.get((dim, leaf), 0)):
                        place = [pa.array(np.full(who.num_rows, x, np.int32)) for x in (dim, leaf, block)]
                        sent = pa.table([*[who[c] for c in ("anchor_id", "vkey", "label")], *place, who["x"], who["windows"]],
                                        names=_ASK.names).cast(_ASK)
                        yield from sent.to_batches()

    return asking.mapInArrow(send, _ASK_DDL)


def _compared(best: Callable, schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A comparison of one block with its queries, 256 at a time; ``best`` yields a query's columns from its scores."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in schema]
        if left.num_rows and right.num_rows:
            left = left.sort_by("vec_id")
            dim = left["dim"][0].as_py()
            ids, labels, c = left["vec_id"].to_numpy(), left["label"].to_numpy(), exact(matrix(left["x"], dim), SCALE)
            for at in range(0, right.num_rows, 256):
                part = right.slice(at, 256)
                scores = products(exact(matrix(part["x"], dim), SCALE), c)
                queries = zip(*[part[n].to_pylist() for n in ("anchor_id", "vkey", "label", "windows")], strict=True)
                for row, (anchor, vkey, label, windows) in enumerate(queries):
                    for found in best(scores[row], ids, labels, anchor, label, windows):
                        n = len(found[0])
                        for where, x in zip(out, ([anchor] * n, [vkey] * n, *found), strict=True):
                            where.extend(x)
        return pa.table([pa.array(x, f.type) for x, f in zip(out, schema, strict=True)], schema=schema)
    return run


def _first(scores: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Of ``rows`` (in order of id) the ``k`` with the highest scores, ties by place."""
    if len(rows) > 4 * k and scores.dtype != object:
        rows = rows[scores[rows] >= np.partition(scores[rows], -k)[-k]]
    order = sorted(range(len(rows)), key=lambda i: (-int(scores[rows[i]]), i))[:k]
    return rows[order]


def hard_negatives(vectors: DataFrame, is_anchor: Column, *, positives: int = 5, negatives: int = 5, percent: int = 80,
                   vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for every anchor row.

    A score is the integer inner product of floor(256 x).  An anchor's positives are its ``positives`` other rows of the
    same label with the highest scores; for each, the first ``negatives`` rows of another label whose score is at least
    ``percent`` per cent of the positive's and at most the positive's.  Ties go to the smaller id.

    Vectors get one more component that brings all to one length, so that a score is a distance from the anchor and a
    window of scores an annulus around it.  A tree of split points (:class:`~wayfold.llm.hypertree.Tree`, built from a
    bounded sample) deals the rows to leaves; each split point stores the range of its distances to every sibling's
    subtree over all rows, and a sibling whose ranges meet no annulus is left out.  Leaves are compared exactly, large
    ones in blocks of bounded size.  Positives first ask the anchor's own block, which bounds the radius for the rest.
    Where vectors have no structure nothing can be left out, and every anchor meets every block.

    Defined results: rows with a null id or label, or a vector that is null, empty or holds a null or non-finite
    component take no part; rows with the anchor's id are not its other rows; equal anchor rows are one anchor, unequal
    ones with the same id are answered each; vectors of other lengths are not compared; scores are exact at any size,
    one beyond a long is used but returned as null; an empty table gives an empty table; other columns are not carried.
    """
    rows = stored(participants(vectors, is_anchor, vec_id=vec_id, embedding=embedding, label=label), "vectors")
    index = _Index(rows)
    keys = index.keys

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, dims = np.zeros(batch.num_rows, np.int32), batch["dim"].to_numpy()
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                leaf[own] = index.leaf_of(dim, matrix(batch["x"].take(pa.array(own)), dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    # the number that deals a leaf's rows to its blocks is written with them, so that it is the same whenever it is read
    routed = stored(rows.mapInArrow(deal, StructType([*rows.schema.fields, StructField("leaf", IntegerType())])).withColumn("salt", F.monotonically_increasing_id()), "leaves")
    index.measure(routed)
    sizes = {(r["dim"], r["leaf"]): -(-r["n"] // BLOCK) for r in routed.groupBy("dim", "leaf").agg(F.count("*").alias("n")).collect()}
    many = rows.sparkSession.createDataFrame([(*k, n) for k, n in sizes.items()], "dim int, leaf int, blocks int")
    routed = routed.join(F.broadcast(many), ["dim", "leaf"]).withColumn("block", F.pmod(F.xxhash64("salt"), F.col("blocks")).cast("int"))
    blocks = routed.select("vec_id", "label", "x", *_KEYS).groupBy(*_KEYS)
    anchors = stored(routed.filter("asks").groupBy(F.col("vec_id").alias("anchor_id"), F.xxhash64("label", "x").alias("vkey"), "label", "dim", "leaf",
                                                   F.col("x").cast("array<double>").alias("x")).agg(F.min("block").alias("block")), "anchors")

    def nearest(scores, ids, labels, anchor, label, windows):
        same = (labels == label) & (ids != anchor)
        if windows[0]["key"] is not None:
            same &= scores >= keys.score(windows[0]["key"])
        best = _first(scores, np.flatnonzero(same), positives)
        yield ids[best].tolist(), keys.of(scores[best])

    found = pa.schema([("anchor_id", pa.int64()), ("vkey", pa.int64()), ("id", pa.int64()), ("key", pa.binary())])
    found_ddl = "anchor_id long, vkey long, id long, key binary"
    who = ["anchor_id", "vkey"]

    def ranked(df: DataFrame, by: list[str], most: int) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("key"), "id")
        return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)

    def window(rank: Column, of: Column, key: Column) -> Column:
        return F.struct(rank.cast("int").alias("rank"), of.cast("long").alias("id"), key.cast("binary").alias("key"))

    null = F.lit(None)
    columns = _ASK.names[:-1]
    first = anchors.select(*columns, F.array(window(null, null, null)).alias("windows"))
    home = blocks.cogroup(first.groupBy(*_KEYS)).applyInArrow(_compared(nearest, found), found_ddl)
    bound = ranked(home, who, positives).filter(F.col("rank") == positives).select(*who, F.col("key").alias("bound"))
    second = anchors.join(bound, who, "left").select(*columns, F.array(window(null, null, F.col("bound"))).alias("windows"))
    second = _sent(second, sizes, index, lambda score: (None, score))
    same = ranked(blocks.cogroup(second.groupBy(*_KEYS)).applyInArrow(_compared(nearest, found), found_ddl), who, positives)
    windows = same.groupBy(*who).agg(F.collect_list(window(F.col("rank"), F.col("id"), F.col("key"))).alias("windows"))
    third = stored(anchors.join(windows, who).select(*columns, "windows"), "windows")

    def inside(scores, ids, labels, anchor, label, windows):
        other = (labels != label) & (ids != anchor)
        for w in windows:
            most = keys.score(w["key"])
            best = _first(scores, np.flatnonzero(other & (scores <= most) & (scores >= -(-percent * most // 100))), negatives)
            n = len(best)
            yield [w["rank"]] * n, [w["id"]] * n, [w["key"]] * n, ids[best].tolist(), keys.of(scores[best])

    mined = pa.schema([*list(found)[:2], ("place", pa.int32()), ("positive_id", pa.int64()), ("positive_key", pa.binary()), *list(found)[2:]])
    third = _sent(third, sizes, index, lambda score: (score, -(-percent * score // 100)))
    pairs = blocks.cogroup(third.groupBy(*_KEYS)).applyInArrow(
        _compared(inside, mined), "anchor_id long, vkey long, place int, positive_id long, positive_key binary, id long, key binary")
    return ranked(pairs, [*who, "place"], negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("positive_key").alias("positive_score"),
        F.col("key").alias("negative_score")).mapInArrow(
        keys.reader("positive_score", "negative_score"), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
