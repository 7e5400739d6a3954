"""Exact top-k inner products behind bounds from segment means and deviations, coarse to fine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfold.llm.integers import Keys, exact, matrix, products

SCALE = 1024
#: Rows of one unit of work: candidates, and queries that meet them.
CANDIDATES, QUERIES = 8192, 4096
#: Segments of the two bounds.
LEVELS = (4, 16)


def participants(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(vec_id, dim, x)`` of the rows that take part: with an id, and a vector of finite components."""
    kind = vectors.schema[embedding].dataType.elementType.simpleString()
    x = F.col(embedding) if kind in ("float", "double") else F.col(embedding).cast("array<double>")
    finite = lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False))
    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x")).filter(
        F.col("vec_id").isNotNull() & F.coalesce(F.forall("x", finite) & (F.size("x") > 0), F.lit(False))).select("vec_id", F.size("x").alias("dim"), "x")


def _features(v: np.ndarray, segments: int) -> np.ndarray:
    """Root-weighted mean and deviation of each segment: their dot product bounds the inner product from above.

    In a segment of m components the squared distance is at least m (difference of means)^2 + m (difference of
    deviations)^2; with the norms known, that is this bound on the inner product.
    """
    cuts = np.linspace(0, v.shape[1], min(segments, v.shape[1]) + 1).astype(int)
    size = np.diff(cuts)
    mean = np.add.reduceat(v, cuts[:-1], axis=1) / size
    square = np.add.reduceat(v * v, cuts[:-1], axis=1) / size
    deviation = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.concatenate([mean, deviation], 1) * np.sqrt(np.tile(size, 2))


def _unit(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int):
    """For each query, indexes and exact scores of its best ``k`` candidates, ties to the smaller id."""
    if q.dtype == object or c.dtype == object or int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * q.shape[1] >= 2**53:
        # beyond whole doubles every product is made, in longs or Python integers
        for me in range(len(q)):
            score = products(q[me:me + 1], c)[0].tolist()
            order = sorted((i for i in range(len(score)) if c_ids[i] != q_ids[me]), key=lambda i: (-score[i], c_ids[i]))[:k]
            yield me, np.array(order, np.int64), [score[i] for i in order]
        return
    coarse, fine = ([_features(x.astype(np.float64), s) for x in (q, c)] for s in LEVELS)
    slack = 1 + 1e-9
    for at in range(0, len(q), 256):
        bound = coarse[0][at:at + 256] @ coarse[1].T
        bound[q_ids[at:at + 256, None] == c_ids[None]] = -np.inf
        for i in range(len(bound)):
            own = bound[i]
            open_ = np.flatnonzero(own > -np.inf)
            if not len(open_):
                continue
            me = at + i
            if len(open_) > 4 * k:
                # a first threshold from the candidates that promise most, then only what may still reach it
                seeds = open_[np.argpartition(-own[open_], 4 * k)[:4 * k]]
                least = np.partition(c[seeds] @ q[me], -k)[-k]
                edge = least - abs(float(least)) * 1e-9 - 1e-6
                open_ = open_[own[open_] * slack >= edge]
                open_ = open_[(fine[1][open_] @ fine[0][me]) * slack >= edge]
            score = c[open_] @ q[me]
            if len(score) > k:
                top = score >= np.partition(score, -k)[-k]
                open_, score = open_[top], score[top]
            order = np.lexsort((c_ids[open_], -score))[:k]
            yield me, open_[order], score[order].astype(np.int64).tolist()


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` largest integer inner products of each query row.

    Every row but those with the query's own id is a candidate; ties go to the smaller id.  Queries and candidates are
    dealt into hashed groups of bounded size and every pair of groups is one unit, which sends back ``k`` rows a query;
    neither side is ever whole in one place.

    Defined results: vectors that are null or empty or hold null or non-finite components take no part, nor do rows with
    a null id; vectors of other lengths are no candidates; equal query rows are one query; queries that share an id but not
    the vector are answered each, under that id; scores are exact and in order at any size, one beyond a long (which takes
    components beyond some 10 ** 8) is returned as null; an empty table gives an empty table; other columns are not carried.
    """
    all_rows = participants(vectors, vec_id=vec_id, embedding=embedding)
    queries = participants(vectors.filter(is_query), vec_id=vec_id, embedding=embedding).distinct().withColumn("key", F.xxhash64("x"))
    known = all_rows.agg(F.max(F.array_max(F.transform("x", lambda e: F.abs(e.cast("double"))))), F.max("dim")).first()
    keys = Keys((int(known[0] or 0) + 1) * SCALE, known[1] or 1)
    n, asked = all_rows.count(), queries.count()
    deal, ask = -(-n // CANDIDATES) or 1, -(-asked // QUERIES) or 1
    salt = F.xxhash64("vec_id", "x")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    candidates = all_rows.withColumn("g", F.pmod(salt, F.lit(deal)).cast("int")).withColumn("h", every(ask))
    queries = queries.withColumn("h", F.pmod(salt, F.lit(ask)).cast("int")).withColumn("g", every(deal))
    schema = pa.schema([("query_id", pa.int64()), ("key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.binary())])

    def unit(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        left = left.sort_by("vec_id")
        dim = left["dim"][0].as_py()
        c_ids, q_ids, vkeys = left["vec_id"].to_numpy(), right["vec_id"].to_numpy(), right["key"].to_numpy()
        out: list[list] = [[] for _ in schema]
        for me, best, score in _unit(q_ids, exact(matrix(right["x"], dim), SCALE), c_ids, exact(matrix(left["x"], dim), SCALE), k):
            n = len(best)
            for where, x in zip(out, ([int(q_ids[me])] * n, [int(vkeys[me])] * n, c_ids[best].tolist(), keys.made(score)), strict=True):
                where.extend(x)
        return pa.table([pa.array(x, f.type) for x, f in zip(out, schema, strict=True)], schema=schema)

    found = candidates.groupBy("dim", "g", "h").cogroup(queries.groupBy("dim", "g", "h")).applyInArrow(
        unit, "query_id long, key long, vec_id long, score binary")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score").mapInArrow(keys.reader("score"), "query_id long, rank int, vec_id long, score long")
