"""Prefix trie of conversations as a burst trie: containers of suffixes under heads, burst where they are too large."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm.frames import stored

#: Turns that a container may hold before it bursts, and containers' turns in a shard of the sweep.  The first grows with
#: the corpus so that at most 2 ** BURSTS heads ever burst, which is what the driver and the broadcasts see of the trie.
CONTAINER, SHARD, BURSTS = 4096, 4, 17
#: Depths that one burst may skip where all suffixes of a container go on alike: powers of two.
RUNS = (1, 2, 4, 8, 16, 32, 64)
_EMPTY = hashlib.sha256(b"").hexdigest()
NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string")
_SWEPT = pa.schema([*[(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
                    ("ends_sha256", pa.string()), ("top", pa.int64())])


def sequences(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, t)``: each conversation's turns in order as ``(a, b, w)``: a 128-bit digest of role and text, and its words.

    Turns are ordered by ``turn`` (null first), equal ones by role and then digest; rows without an id are left out, a
    null role or text is empty.  A conversation is one row of 20 bytes a turn; texts stay behind.
    """
    said = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in (role, text)]
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)

    def number(at: int) -> Column:  # 64 bits whose signed order is that of the digits
        return F.conv(F.substring("digest", at, 16), 16, -10).cast("long").bitwiseXOR(F.lit(-(2**63)))

    rows = conversations.filter(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), *said)
    rows = rows.select("conv_id", "turn", F.col(role).alias("role"), digest.alias("digest"),
                       F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("int").alias("w"))
    step = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", number(1).alias("a"), number(17).alias("b"), "w")
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(step)).alias("t")).select(
        "conv_id", F.transform("t", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["w"].alias("w"))).alias("t"))


def branched(seqs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations rebuilt as branches: the first ``h`` turns of conversation ``c - c % every``, then ``c``'s own after its
    first ``h``, with ``h`` the CRC-32 of ``c``'s digits modulo ``most``."""
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = seqs.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("t", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    none = F.slice("t", 1, 0)
    own = F.slice("t", h + 1, F.size("t"))
    return seqs.withColumn("base", base).join(heads, "base", "left").select(
        "conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), h), own).alias("t"))


def _end_digests(members: DataFrame) -> DataFrame:
    """``(key, sha)``: of each set of equal sequences, the digest of its sorted ids, comma-joined.

    Ids go by blocks of 4096 numbers, each one string, and a task reads the blocks of a key one after the other; so a key
    that a third of all conversations share is neither sorted nor held in one place.
    """
    blocks = members.groupBy("key", F.shiftright("conv_id", 12).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            keys, shas = [], []
            for key, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if key != at:
                    if at is not None:
                        keys.append(at)
                        shas.append(total.hexdigest())
                    at, total = key, hashlib.sha256(ids.encode())
                else:
                    total.update(b"," + ids.encode())
            yield pa.record_batch([pa.array(keys, pa.string()), pa.array(shas, pa.string())], ["key", "sha"])
        if at is not None:
            yield pa.record_batch([pa.array([at]), pa.array([total.hexdigest()])], ["key", "sha"])

    return blocks.repartition("key").sortWithinPartitions("key", "block").select("key", "ids").mapInArrow(digest, "key string, sha string")


def _sweep(group: pa.Table) -> pa.Table:
    """All nodes at and below the heads of a shard's containers, from their sorted suffixes.

    A suffix is its container's number followed by the ranks of its turns.  A place of a sorted suffix beyond what it
    shares with the one before it opens a node; ordered by place, then by suffix, the places of one node lie together.
    """
    t = group["t"].combine_chunks()
    flat, lens = t.flatten(), pc.list_value_length(t).to_numpy().astype(np.int64)
    a, b, w = (flat.field(c).to_numpy(zero_copy_only=False) for c in "abw")
    h1, h2, depth, top, up, m, n = (group[c].to_numpy() for c in ("h1", "h2", "depth", "top", "up", "m", "n"))
    first = np.cumsum(lens) - lens

    def ranks(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        order = np.lexsort((y, x))
        new = np.ones(len(x), bool)
        new[1:] = (x[order][1:] != x[order][:-1]) | (y[order][1:] != y[order][:-1])
        out = np.empty(len(x), np.int64)
        out[order] = np.cumsum(new) - 1
        return out

    # the element in front of a suffix stands for the head; its words are those of the turn that leads there
    size = lens - depth + 1
    begin = np.cumsum(size) - size
    own = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(own)) - begin[own]
    turn = first[own] + depth[own] + place - 1
    leads = (place > 0) | (depth[own] > 0)
    words = np.zeros(len(own), np.int64)
    words[leads] = w[turn[leads]]
    symbol = ranks(h1, h2)[own]
    if len(a):
        symbol[place > 0] = ranks(a, b)[turn[place > 0]]
    raw = symbol.astype(">u4").tobytes()
    keys = [raw[4 * i:4 * (i + j)] for i, j in zip(begin.tolist(), size.tolist(), strict=True)]
    order = np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)
    # the same, sorted
    depth, top, up, m, n, size, began = depth[order], top[order], up[order], m[order], n[order], size[order], begin[order]
    begin = np.cumsum(size) - size
    own = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(own)) - begin[own]
    at = began[own] + place
    symbol, words = symbol[at], words[at]
    before = np.maximum(own - 1, 0)
    shared = (own > 0) & (place < size[before])
    shared[shared] = symbol[shared] == symbol[(begin[before] + place)[shared]]
    alike = np.minimum.reduceat(np.where(shared, len(own), place), begin)
    new = place >= alike[own]
    # nodes, by place and then by suffix
    level = np.argsort(place, kind="stable")
    starts = np.flatnonzero(new[level])
    node = np.empty(len(own), np.int64)
    node[level] = np.cumsum(new[level]) - 1
    opener = level[starts]
    convs = np.add.reduceat(n[own[level]], starts)
    least = np.minimum.reduceat(m[own[level]], starts)
    is_head = place[opener] == 0
    parent = np.where(is_head, -1, node[opener - 1])
    children = np.bincount(parent[~is_head], minlength=len(starts))
    leaves, saved = (children == 0).astype(np.int64), (convs - 1) * words[opener]
    cuts = np.searchsorted(place[opener], np.arange(place.max(initial=0) + 2))
    for low, high in zip(cuts[-2:0:-1], cuts[:1:-1], strict=True):
        np.add.at(leaves, parent[low:high], leaves[low:high])
        np.add.at(saved, parent[low:high], saved[low:high])
    ends = np.full(len(starts), _EMPTY, object)
    ends[node[begin + size - 1]] = np.array(group["sha"].to_pylist(), object)[order]
    suffix = own[opener]
    rooted = is_head & (top[suffix] < 0)
    above = np.where(is_head, up[suffix], least[parent])
    numbers = [pa.array(least), pa.array(depth[suffix] + place[opener]), pa.array(above, mask=rooted), pa.array(convs), pa.array(children),
               pa.array(leaves), pa.array(saved)]
    return pa.table([*numbers, pa.array(ends, pa.string()), pa.array(top[suffix], mask=~is_head)], schema=_SWEPT)


def _bursting(rows: DataFrame, limit: int) -> list:
    """The containers that hold more than ``limit`` turns of several sequences, with what their trie nodes need."""
    same = []
    for s in RUNS:
        run = F.xxhash64(F.expr(f"slice(t, depth + 1, {s})"))
        same += [F.min(run).alias(f"x{s}"), F.max(run).alias(f"y{s}")]
    sizes = rows.groupBy("h1", "h2", "depth", "top").agg(
        F.count("*").alias("seqs"), F.sum(F.size("t") - F.col("depth") + 1).alias("turns"), F.sum("n").alias("convs"), F.min("m").alias("m"),
        F.min(F.size("t") - F.col("depth")).alias("least"), *same)
    return sizes.filter((F.col("turns") > limit) & (F.col("seqs") > 1)).collect()


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """One row per node of the trie of all prefixes of the sequences ``(conv_id, t)``, the empty one included.

    ``conv_id`` is a node's smallest member (a conversation that starts with the node's turns), which names the node
    together with ``depth``; ``parent_conv_id`` (null at the root) names the parent.  ``n_convs`` counts members,
    ``n_children`` children, ``n_leaves`` childless nodes of the subtree; ``saved_tokens`` sums, over the subtree, the
    words of each node's last text times its members but one; ``ends_sha256`` digests the ids of the members that end
    there.

    Equal sequences are one, with a count.  All start in the container of the root.  A container of more than
    :data:`CONTAINER` turns of several sequences bursts: its head becomes a node of the upper trie, and its suffixes go
    to containers by their next turn; where all go on alike, up to 64 turns are skipped at once.  The rest is dealt into
    shards by container, sorted there and swept into nodes (:func:`_sweep`).  The upper trie is small: a head that
    bursts has more turns below it than a container may hold.

    Defined results: an empty sequence is a member of the root alone; an empty table gives no node; sequences with the
    same id count as one each.
    """
    key = F.sha2(F.array_join(F.transform("t", lambda x: F.concat_ws(".", x["a"], x["b"])), ","), 256)
    members = stored(seqs.select("conv_id", "t", key.alias("key")), "trie-members")
    classes = members.groupBy("key").agg(F.min("conv_id").alias("m"), F.count("*").alias("n"), F.first("t").alias("t"))
    zero = [F.lit(0).cast("long").alias(c) for c in ("h1", "h2", "depth")]
    rows = stored(classes.join(_end_digests(members), "key").select(
        "m", "n", "t", "sha", *zero, F.lit(-1).cast("long").alias("top"), F.lit(0).cast("long").alias("up")), "trie-classes")
    spark = rows.sparkSession
    total = rows.agg(F.sum(F.size("t") + 1)).first()[0] or 0
    limit = max(CONTAINER, total >> BURSTS)
    upper: list[dict] = []
    settled = []
    while burst := _bursting(rows, limit):
        moves = []
        for r in burst:
            run = max([s for s in RUNS if s <= r["least"] and r[f"x{s}"] == r[f"y{s}"]], default=0)
            above = r["top"]
            for j in range(run + 1):
                upper.append({"m": r["m"], "depth": r["depth"] + j, "above": above, "convs": r["convs"], "children": 0, "leaves": 0,
                              "saved": 0, "sha": _EMPTY})
                above = len(upper) - 1
            moves.append((r["h1"], r["h2"], run, above, r["m"]))
        named = spark.createDataFrame(moves, "h1 long, h2 long, run long, to long, by long")
        settled.append(rows.join(F.broadcast(named), ["h1", "h2"], "left_anti"))
        inside = rows.join(F.broadcast(named), ["h1", "h2"])
        for r in inside.filter(F.size("t") == F.col("depth") + F.col("run")).select("to", "sha").collect():
            upper[r["to"]]["sha"] = r["sha"]
        # words of the turns that the burst heads end with, from their smallest member
        for r in inside.filter("m = by").select("to", "run", F.expr("transform(slice(t, CAST(greatest(depth, 1) AS INT), CAST(run + 1 AS INT)), x -> x.w)").alias("w"),
                                                (F.col("depth") == 0).alias("root")).collect():
            for j, words in enumerate(([0] if r["root"] else []) + r["w"]):
                if j <= r["run"]:
                    node = upper[r["to"] - r["run"] + j]
                    node["saved"] = (node["convs"] - 1) * words
        step = F.expr("slice(t, CAST(depth + 1 AS INT), CAST(run + 1 AS INT))")
        rows = stored(inside.filter(F.size("t") > F.col("depth") + F.col("run")).select(
            "m", "n", "t", "sha", F.xxhash64("h1", "h2", step).alias("h1"), F.xxhash64(F.lit(1), "h2", step, "h1").alias("h2"),
            (F.col("depth") + F.col("run") + 1).alias("depth"), F.col("to").alias("top"), F.col("by").alias("up")), "trie-burst")
    for part in settled:
        rows = rows.unionByName(part)
    shards = -(-total // (limit * SHARD)) or 1
    swept = rows.withColumn("shard", F.pmod(F.xxhash64("h1", "h2"), F.lit(shards))).groupBy("shard").applyInArrow(
        lambda group: _sweep(group), NODES + ", top long")
    if not upper:
        return swept.drop("top")
    swept = stored(swept, "trie-nodes")
    for r in swept.filter("top >= 0").groupBy("top").agg(F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")).collect():
        node = upper[r["top"]]
        node["children"], node["leaves"], node["saved"] = node["children"] + r["c"], node["leaves"] + r["l"], node["saved"] + r["s"]
    for node in reversed(upper):
        if node["above"] >= 0:
            parent = upper[node["above"]]
            parent["children"] += 1
            parent["leaves"] += node["leaves"]
            parent["saved"] += node["saved"]
    heads = [(x["m"], x["depth"], upper[x["above"]]["m"] if x["above"] >= 0 else None, x["convs"], x["children"], x["leaves"], x["saved"], x["sha"])
             for x in upper]
    return swept.drop("top").union(spark.createDataFrame(heads, NODES))
