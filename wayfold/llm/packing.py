"""Packing of tokenised documents into fixed-length sequences: dominance reduction, then best fit, on a size histogram."""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfold.llm import flat
from wayfold.llm.frames import stored

CAPACITY = 2048
#: Rows of one size that are numbered together.
NUMBERED = 1 << 16

Bin = tuple[int, list[tuple[int, int]]]


class Tokens:
    """Ids of a tokenizer file without special tokens added.

    A byte-level BPE without a normaliser is read into the faster of two libraries with the same results; any other
    file, and a text that spells a special token, goes to the library that the file is for.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.own, self.fast = Tokenizer.from_file(path), None
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        self.special = [t["content"] for t in said.get("added_tokens") or []]
        before = said.get("pre_tokenizer") or {}
        if said["model"]["type"] == "BPE" and not said.get("normalizer") and before.get("type") == "ByteLevel" and not (
                before.get("add_prefix_space", True)) and before.get("use_regex", True) and not said["model"].get("dropout"):
            import tiktoken

            spelled = _byte_letters()
            ranks = {bytes(spelled[c] for c in word): i for word, i in said["model"]["vocab"].items() if word not in self.special}
            # fixed value: the pattern of byte-level BPE words
            words = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.fast = tiktoken.Encoding("byte_level", pat_str=words, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.own.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte: itself where it prints, else the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


def cut_pieces(docs: DataFrame, path: str, *, capacity: int = CAPACITY, end_id: int = 0, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: each document's ids and the end id, cut where longer than a sequence.

    The first piece takes the remainder, so that all others are full.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        known = tokens(path)
        for batch in batches:
            _, offsets = flat.flatten(batch["text"])
            for low, high in flat.slices(offsets):
                out: list[list] = [[] for _ in schema]
                for i in range(low, high):
                    ids = np.append(known.ids(batch["text"][i].as_py() or ""), np.array([end_id], "<u4"))
                    first = len(ids) % capacity or capacity
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    name = batch["id"][i].as_py()
                    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        for where, x in zip(out, (name, k, a, b - a, zlib.crc32(ids[a:b].tobytes())), strict=True):
                            where.append(x)
                yield pa.record_batch([pa.array(x, f.type) for x, f in zip(out, schema, strict=True)], schema=schema)
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _reduce(count: np.ndarray, capacity: int) -> list[Bin]:
    """Sequences that some best packing holds, taken out of ``count`` (Martello and Toth's dominance criterion).

    For an item ``s`` let ``b`` be the largest item that fits beside it.  ``{s}`` is fixed if nothing fits; ``{s, b}`` if
    it fills the sequence, if no two items fit beside ``s``, or if no three do and no two together exceed ``b``: every
    other sequence with ``s`` can then be exchanged for it without loss.  Sizes are handled with their counts, until
    nothing changes.
    """
    fixed: list[Bin] = []
    changed = True
    while changed:
        changed = False
        for s in range(capacity, 0, -1):
            while count[s]:
                count[s] -= 1  # one item of size s is looked at; the rest stand beside it
                there = np.flatnonzero(count)
                count[s] += 1
                room = capacity - s
                fits = there[there <= room]
                if not len(fits):
                    fixed.append((int(count[s]), [(s, 1)]))
                    count[s] = 0
                    changed = True
                    break
                b = int(fits[-1])
                times = int(count[s] // 2 if b == s else min(count[s], count[b]))
                if b != room:
                    small = np.repeat(fits[:3], np.minimum(count[fits[:3]] - (fits[:3] == s), 3))[:3]
                    two = len(small) < 2 or small[:2].sum() > room
                    if not two and not ((len(small) < 3 or small[:3].sum() > room) and _best_two(count, fits, s, room) <= b):
                        break
                fixed.append((times, [(s, 2)] if b == s else [(s, 1), (b, 1)]))
                count[s] -= times
                count[b] -= times
                changed = True
    return fixed


def _best_two(count: np.ndarray, fits: np.ndarray, s: int, room: int) -> int:
    """The largest sum of two items that fit together beside one item of size ``s``."""
    best, i, j = 0, 0, len(fits) - 1
    while i <= j:
        x, y = int(fits[i]), int(fits[j])
        if x + y > room or (i == j and count[x] - (x == s) < 2):
            j -= 1
            continue
        best = max(best, x + y)
        i += 1
    return best


def _best_fit(count: np.ndarray, capacity: int) -> list[Bin]:
    """Best-fit decreasing over sizes with counts: bins of equal content are handled together."""
    open_: dict[int, list[Bin]] = {}
    rooms: list[int] = []

    def put(room: int, one: Bin) -> None:
        if one[0]:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append(one)

    for s in range(capacity, 0, -1):
        left = int(count[s])
        while left:
            at = bisect_left(rooms, s)
            if at < len(rooms):
                room = rooms[at]
                bins, content = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            else:
                room, bins, content = capacity, left, []
            each = room // s
            whole = min(bins, left // each)
            put(room - each * s, (whole, [*content, (s, each)]))
            left -= whole * each
            rest = min(left, each - 1) if whole < bins else 0
            if rest:
                put(room - rest * s, (1, [*content, (s, rest)]))
                left -= rest
            if content:
                put(room, (bins - whole - bool(rest), content))
    return [one for bins in open_.values() for one in bins]


class Plan:
    """Where the n-th piece of each size goes, as arrays; their length depends on the capacity, not on the corpus."""

    def __init__(self, sizes: dict[int, int], capacity: int) -> None:
        count = np.zeros(capacity + 1, np.int64)
        for s, n in sizes.items():
            count[s] = n
        bins = [(int(count[capacity]), [(capacity, 1)])] if count[capacity] else []
        count[capacity] = 0
        bins += _reduce(count, capacity)
        self.reduced = sum(n for n, _ in bins)
        bins += _best_fit(count, capacity)
        used = np.zeros(capacity + 1, np.int64)
        rows, self.sequences = [], 0
        for n, content in bins:
            offset = 0
            for s, each in content:
                rows.append((s, int(used[s]), self.sequences, each, offset))
                used[s] += n * each
                offset += s * each
            self.sequences += n
        rows.sort()
        self.table = np.array(rows, np.int64).reshape(-1, 5)

    def place(self, size: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = size << 44 | number
        at = np.searchsorted(self.table[:, 0] << 44 | self.table[:, 1], key, "right") - 1
        s, first, sequence, each, offset = self.table[at].T
        inside = number - first
        return sequence + inside // each, offset + inside % each * s


def pack(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: as few sequences of ``capacity`` as dominance and best fit give.

    ``pieces`` needs ``doc_id``, ``piece`` and ``length`` (1 to ``capacity``).  The driver sees one count per length, at
    most ``capacity`` numbers, and plans with these.  Pieces of a length are numbered in even hashed groups of about
    :data:`NUMBERED`, so a length that a third of all pieces have does not gather in one task.

    Defined results: an empty table gives an empty table; repeated rows are packed each; rows of one length may
    exchange places.
    """
    sizes = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = pieces.sparkSession.sparkContext.broadcast(Plan(sizes, capacity))  # see Plan: bounded by the capacity
    groups = -(-max(sizes.values(), default=1) // NUMBERED)
    split = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    before = split.groupBy("length", "part").count().withColumn(
        "base", F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count")).drop("count")
    inside = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece")) - 1
    numbered = split.withColumn("inside", inside).join(before, ["length", "part"]).withColumn("number", F.col("base") + F.col("inside"))
    names = [*pieces.columns, "number"]
    schema = numbered.select(*pieces.columns).schema.add("sequence_id", "long").add("offset", "long")

    def assign(batches):
        for batch in batches:
            sequence, offset = plan.value.place(batch["length"].to_numpy(), batch["number"].to_numpy())
            yield pa.record_batch([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=schema.names)
    return numbered.select(*names).mapInArrow(assign, schema)


def pack_documents(docs: DataFrame, path: str, *, capacity: int = CAPACITY, end_id: int = 0, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Every piece of every document with its place; see :func:`cut_pieces` and :func:`pack`.

    A null or empty text is the end id alone; equal texts and rows with one id or none are packed each; other columns
    are not carried.  Texts are tokenised once; the pieces are a table in the shared folder.
    """
    return pack(stored(cut_pieces(docs, path, capacity=capacity, end_id=end_id, doc_id=doc_id, text=text), "pieces"), capacity=capacity)
