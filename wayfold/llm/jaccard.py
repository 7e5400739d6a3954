"""Exact Jaccard join on word n-grams with adaptive multi-match prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm import flat, sketch
from wayfold.llm.frames import chunk_count, chunk_of, stored, text_bytes
from wayfold.llm.graph import components

MAX_MATCHES = 16
#: Set elements compared in the time one posting is probed.
PROBE = 8
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SALTS = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def shingle_sets(texts: pa.ChunkedArray | pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per slice of texts: its first row, the sorted distinct shingle hashes of each text end to end, and their bounds."""
    data, offsets = flat.flatten(texts)
    for low, high in flat.slices(offsets):
        part, places = _LOWER[data[offsets[low]:offsets[high]]], offsets[low:high + 1] - offsets[low]
        starts, ends, firsts = flat.word_bounds(part, places)
        words = flat.span_hashes(part, starts, ends)
        at = flat.windows_inside(firsts, width)
        tokens, own = flat.window_hashes(words, width, at), flat.owners(firsts, at)
        counts = np.diff(firsts)
        for few in range(1, width):  # a shorter text is one shingle
            short = np.flatnonzero(counts == few)
            if len(short):
                heads = firsts[short]
                whole = flat.mix(flat.window_hashes(words, few, heads, 1) + np.uint64(few))
                tokens, own = np.concatenate([tokens, whole]), np.concatenate([own, short])
        if len(own) > len(at):
            order = np.argsort(own, kind="stable")
            tokens, own = tokens[order], own[order]
        bounds = np.searchsorted(own, np.arange(high - low + 1))
        for first, last in zip(bounds[:-1], bounds[1:], strict=True):
            tokens[first:last].sort()
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (own[1:] != own[:-1])
        tokens, own = tokens[new], own[new]
        yield low, tokens, np.searchsorted(own, np.arange(high - low + 1))


def _digests(docs: DataFrame, width: int) -> DataFrame:
    """``(id, n, d1, d2)``: set size and a 128-bit digest of the set of every row."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64())])

    def digest(batches):
        for batch in batches:
            for low, tokens, bounds in shingle_sets(batch["text"], width):
                sums = [np.append(np.uint64(0), np.cumsum(flat.mix(tokens ^ s))) for s in _SALTS]
                yield pa.record_batch([batch["id"].slice(low, len(bounds) - 1), pa.array(np.diff(bounds)), *[
                    pa.array((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64)) for s in sums]], schema=schema)
    return docs.select("id", "text").mapInArrow(digest, "id long, n long, d1 long, d2 long")


def _prefix(estimates: np.ndarray, percent: int) -> tuple[int, int]:
    """Length of the one-match prefix and the number of matches to ask for, given a set's sorted frequencies.

    With ``m`` matches the prefix is ``m - 1`` longer.  Probing costs the postings met, counted for a partner of the same
    size; at most postings / m documents can share ``m`` of them, and each of these costs a comparison of the sets.
    The prefix kept is that for the smallest partner.
    """
    n = len(estimates)
    least = -(-percent * n // 100)
    same = n - -(-2 * percent * n // (100 + percent)) + 1
    met = np.cumsum(estimates.astype(np.int64) - 1)
    asked = np.arange(1, min(MAX_MATCHES, least) + 1)
    cost = met[same + asked - 2] * (1 + n / PROBE / asked)
    return n - least + 1, int(asked[np.argmin(cost)])


def _sets(docs: DataFrame, heads: DataFrame, width: int, percent: int, bits: int, inner: int) -> DataFrame:
    """Class heads that may have partners: their set, and the prefix tokens that some other head may hold."""
    def chosen(group: pa.Table, right: pa.Table):
        group = group.filter(pa.array(np.isin(group["id"].to_numpy(), sketch.heads_of(right))))
        return group["id"].to_numpy(), shingle_sets(group["text"], width)

    def count(group: pa.Table, right: pa.Table) -> pa.Table:
        found = [sketch.cells(t, bits) for _, t, _ in chosen(group, right)[1]] if group.num_rows else []
        return sketch.mail(list(sketch.send([np.concatenate(found)], group["chunk"][0].as_py(), inner)) if found else [])

    dealt, named = docs.groupBy("chunk"), sketch.heads_mail(heads)
    back = sketch.merge(dealt.cogroup(named.groupBy("chunk")).applyInArrow(count, sketch.MAIL), inner)
    longs = pa.list_(pa.int64())
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("lone", pa.int64()), ("typical", pa.float64()), ("asked", pa.int32()), ("prefix", longs),
                        ("place", pa.list_(pa.int32())), ("tokens", longs)])

    def choose(group: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[] for _ in schema]
        if group.num_rows:
            known = sketch.Returned(right, 0, inner)
            ids, slices = chosen(group, right)
            for low, tokens, bounds in slices:
                estimates = known.estimates(sketch.cells(tokens, bits))
                alone = np.append(0, np.cumsum(estimates == 1))
                sizes = np.diff(bounds)
                # as many lone tokens as the shortest prefix is long: no partner can exist
                lone = alone[bounds[1:]] - alone[bounds[:-1]]
                probed = lone < sizes - -(-percent * sizes // 100) + 1
                for i in np.flatnonzero(probed & (sizes > 0)):
                    own, est = tokens[bounds[i]:bounds[i + 1]], estimates[bounds[i]:bounds[i + 1]]
                    order = np.argsort(est, kind="stable")
                    one, asked = _prefix(est[order], percent)
                    order = order[:one + asked - 1]
                    shared = np.flatnonzero(est[order] > 1)
                    for where, value in zip(out, (ids[low + i], len(own), lone[i], est.mean(), asked, own[order[shared]].view(np.int64),
                                                  shared, own.view(np.int64)), strict=True):
                        where.append(value)
        return pa.table([pa.array(values, f.type) for values, f in zip(out, schema, strict=True)], schema=schema)

    return dealt.cogroup(named.union(back).groupBy("chunk")).applyInArrow(
        choose, "id long, n long, lone long, typical double, asked int, prefix array<long>, place array<int>, tokens array<long>")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets are similar enough, by exact intersection."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("tokens").alias(f"t{x}"))
    both = F.size(F.array_intersect("ta", "tb"))
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(
        100 * both >= percent * (F.col("na") + F.col("nb") - both)).select("a", "b")


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Links between class heads that connect all that are similar, without every pair inside a dense group."""
    postings = sets.select("id", "n", "lone", "typical", "asked", F.explode(F.arrays_zip("prefix", "place")).alias("p")).select(
        "id", "n", "lone", "typical", "asked", F.col("p.prefix").alias("token"), F.col("p.place").alias("place"))
    tokens = postings.groupBy("token").agg(F.max(F.struct("typical", (-F.col("id")).alias("id"))).alias("pivot"), F.min("id").alias("x"), F.max("id").alias("y"))
    tokens = tokens.filter("x < y").select("token", (-F.col("pivot.id")).alias("pivot"))
    shared = stored(postings.join(tokens, "token"), "postings")
    # each document against the one of most frequent tokens that it shares most with, which joins dense groups at a
    # linear price: the text that near copies come from has no token of its own
    stars = shared.filter("id <> pivot").groupBy("id", "pivot").count().groupBy("id").agg(
        F.max(F.struct("count", (-F.col("pivot")).alias("b"))).alias("top")).select(F.col("id").alias("a"), (-F.col("top.b")).alias("b"))
    star_links = stored(_linked(stars, sets, percent), "stars")
    labels = components(star_links)
    # the join proper: only tokens that still meet in more than one group, only pairs of different groups
    placed = shared.drop("pivot").join(labels, "id", "left").withColumn("grp", F.coalesce("label", "id")).drop("label")
    mixed = placed.groupBy("token").agg(F.min("grp").alias("x"), F.max("grp").alias("y")).filter("x < y").select("token")
    placed = placed.join(mixed, "token")
    side = lambda x: placed.select("token", *[F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "lone", "asked", "place", "grp")])
    asked = F.least("asked_a", "asked_b")
    # the overlap that the two sizes ask for, and what each side may miss of it
    overlap = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    near: Column = (F.col("id_a") > F.col("id_b")) & (F.col("grp_a") != F.col("grp_b"))
    for x in "ab":
        missed = F.col(f"n_{x}") - overlap
        near &= (F.col(f"lone_{x}") <= missed) & (F.col(f"place_{x}") < missed + asked)
    pairs = side("a").join(side("b"), "token").filter(near).groupBy(F.col("id_a").alias("a"), F.col("id_b").alias("b")).agg(
        F.count("*").alias("met"), F.max(asked).alias("asked")).filter("met >= asked").select("a", "b")
    return star_links.union(_linked(pairs, sets, percent))


def components_by_jaccard(docs: DataFrame, *, width: int = 3, percent: int = 90, doc_id: str = "doc_id",
                          text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of every row: groups of documents linked by Jaccard similarity.

    A document's set holds its distinct shingles of ``width`` words, A-Z lower-cased; a shorter text is one shingle.
    Two documents link when ``100 * intersection >= percent * union``; ``component_id`` is the smallest id reachable.

    Equal sets are one class, whose smallest id stands for it.  Token frequencies come from a sketch that is never too
    low (:mod:`wayfold.llm.sketch`); tokens are ordered by it, rarest first.  Each class picks how many prefix tokens
    (``asked``) a partner must share: more tokens make the prefix longer and the comparisons fewer.  A pair is compared
    if it shares as many tokens as the smaller of its two numbers within the prefixes of that number, which no similar
    pair can miss; the prefix of a pair follows from the overlap that their sizes ask for.  A class whose shortest prefix
    holds lone tokens only is never probed.

    Defined results: a text that is null or has no word has an empty set and is linked with nothing; a null id gets a
    null component; rows that share an id are one document; an empty table gives an empty table.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    total = text_bytes(rows, "text")
    chunks, bits = chunk_count(total, sketch.chunk_bytes(total)), sketch.plane_bits(total // 6)
    known = stored(_digests(rows, width), "digests")
    classes = known.filter("n > 0 AND id IS NOT NULL").groupBy("d1", "d2", "n").agg(
        F.min("id").alias("head"), F.count("*").alias("copies"))
    classes = stored(classes, "classes")
    heads = classes.select(F.col("head").alias("id")).withColumn("chunk", chunk_of(F.col("id"), chunks))
    dealt = rows.filter("id IS NOT NULL").withColumn("chunk", chunk_of(F.col("id"), chunks))
    sets = stored(_sets(dealt, heads, width, percent, bits, sketch.block_bits(bits, chunks)), "sets")
    labels = components(_links(sets, percent))
    named = classes.join(labels.withColumnRenamed("id", "head"), "head", "left").select(
        "d1", "d2", "n", "copies", "head", F.coalesce("label", "head").alias("label")).filter("copies > 1 OR label <> head")
    # ids that stand in several classes (rows sharing an id) and ids that do not stand for their own class
    done = _attach(known, named, known.count())
    return done.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("label").alias("component_id"))


def _attach(rows: DataFrame, named: DataFrame, total: int) -> DataFrame:
    """Each row with its class's label.  Classes of more than a 500th of all rows, hence under 500, are broadcast."""
    keys = ["d1", "d2", "n"]
    often = F.col("copies") > max(total // 500, 1)
    hot = F.broadcast(named.filter(often).select(*keys, F.col("label").alias("hot")))
    rows = rows.join(hot, keys, "left")
    # rows already served get a key of their own: they find nothing below and do not gather in one task
    rows = rows.withColumn("k", F.when(F.col("hot").isNull(), F.col("d1")).otherwise(F.xxhash64("id")))
    cold = named.filter(~often).select(F.col("d1").alias("k"), "d2", "n", "label")
    own = F.when(F.col("id").isNotNull(), F.coalesce("hot", "label", "id"))
    return rows.join(cold, ["k", "d2", "n"], "left").select("id", "n", own.alias("label"))
