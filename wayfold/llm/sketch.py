"""A count-min sketch that grows with the corpus and is never held in one place.

Documents are dealt into chunks.  Each chunk turns its hashes into cells of one or more planes and sends, per block of
cells, its distinct cells and how often it met those that it met more than once.  One task merges one block, so a plane
may have any number of blocks.  What comes back to a chunk are its own cells whose merged count is two or more, with that
count.  A count is never below the true one; a cell that does not come back was met once.

Every chunk writes to about every block.  Chunks and blocks therefore both grow with the square root of the corpus (up to
:data:`MOST_CHUNK` and :data:`MOST_BITS`), so that the number of mails grows in proportion to it, and cells travel as Rice
codes of their gaps, whose length hardly depends on how many share a mail: about 12 bits a hash and plane.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a chunk at least and at most, bytes of corpus for each square byte of chunk, bits of a block's cells.
LEAST_CHUNK, MOST_CHUNK, SPREAD_CHUNK, LEAST_BITS, MOST_BITS = 1 << 20, 64 << 20, 6 << 10, 20, 26
#: What is sent to and from a chunk; ``kind`` is the plane for cells, else what the sender says.
MAIL = "chunk int, kind int, block int, id long, a binary, b binary, c binary"
MAIL_ARROW = pa.schema([("chunk", pa.int32()), ("kind", pa.int32()), ("block", pa.int32()), ("id", pa.int64()),
                        ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])
HEADS = -1


def chunk_bytes(total_bytes: int) -> int:
    """Bytes of text for each chunk of a corpus."""
    return min(max(LEAST_CHUNK, math.isqrt(total_bytes * SPREAD_CHUNK)), MOST_CHUNK)


def block_bits(bits: int, chunks: int) -> int:
    """Bits of a cell number inside its block: a quarter as many blocks as chunks, within bounds."""
    return min(max(LEAST_BITS, bits - max(0, (chunks - 1).bit_length() - 2)), MOST_BITS, bits)


def plane_bits(expected: int, spread: int = 4) -> int:
    """Bits of a cell number: about ``spread`` cells for each expected hash, at least one block."""
    return max(LEAST_BITS, int(max(expected, 1) * spread - 1).bit_length())


def cells(hashes: np.ndarray, bits: int, plane: int = 0) -> np.ndarray:
    """The cell of each 64-bit hash in a plane of ``2 ** bits`` cells."""
    if plane:
        hashes = hashes * np.uint64(0xC2B2AE3D27D4EB4F)
        hashes ^= hashes >> np.uint64(29)
        hashes *= np.uint64(0x9E3779B185EBCA87)
    return hashes >> np.uint64(64 - bits)


def rice(sorted_: np.ndarray) -> bytes:
    """Distinct sorted numbers below 2 ** 32 as Rice codes of the gaps between them."""
    gaps = np.diff(sorted_.astype(np.int64), prepend=-1) - 1
    n = len(gaps)
    k = max(0, min(16, int(gaps.mean()).bit_length() - 1)) if n else 0
    ones = np.cumsum((gaps >> k) + 1) - 1
    unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    unary[ones] = 1
    rest = np.unpackbits((gaps & ((1 << k) - 1)).astype(">u2").view(np.uint8).reshape(-1, 2), axis=1)[:, 16 - k:]
    return np.array([n, len(unary)], "<u4").tobytes() + bytes([k]) + np.packbits(np.concatenate([unary, rest.ravel()])).tobytes()


def unrice(code: bytes) -> np.ndarray:
    n, long = np.frombuffer(code, "<u4", 2).tolist()
    k = code[8]
    bits = np.unpackbits(np.frombuffer(code, np.uint8, offset=9), count=long + n * k)
    high = np.diff(np.flatnonzero(bits[:long]), prepend=-1) - 1
    rest = np.zeros((n, 16), np.uint8)
    rest[:, 16 - k:] = bits[long:].reshape(n, k)
    return np.cumsum((high << k) + np.packbits(rest, axis=1).view(">u2").ravel() + 1) - 1


def mail(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=MAIL_ARROW)


def heads_mail(heads: DataFrame) -> DataFrame:
    """Rows of ``(chunk, id)`` as mail to the chunks."""
    null = F.lit(None)
    return heads.select("chunk", F.lit(HEADS).alias("kind"), null.cast("int").alias("block"), "id",
                        *[null.cast("binary").alias(c) for c in "abc"])


def heads_of(right: pa.Table) -> np.ndarray:
    return right.filter(pc.equal(right["kind"], HEADS))["id"].to_numpy()


def send(planes: list[np.ndarray], chunk: int, block: int) -> Iterator[dict]:
    """Mail to the merging tasks from one chunk; ``planes`` are its cell numbers, repeats included, ``block`` a block's bits.

    ``a`` are the cells, ``b`` which of them were met more than once, ``c`` how often.
    """
    for plane, at in enumerate(planes):
        at = np.sort(at)
        new = np.ones(len(at), bool)
        new[1:] = at[1:] != at[:-1]
        one = np.flatnonzero(new)
        counts = np.diff(np.append(one, len(at))).astype(np.uint32)
        at = at[one]
        blocks = (at >> np.uint64(block)).astype(np.int64)
        inside = (at & np.uint64((1 << block) - 1)).astype(np.uint32)
        cuts = np.append(np.flatnonzero(np.diff(blocks, prepend=-1)), len(at))
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            own = counts[first:last]
            again = np.flatnonzero(own > 1)
            yield {"chunk": chunk, "kind": plane, "block": int(blocks[first]), "a": rice(inside[first:last]),
                   "b": rice(again) if len(again) else None, "c": own[again].tobytes() if len(again) else None}


def merge(sent: DataFrame, bits: int, counted: bool = True) -> DataFrame:
    """Mail back to the chunks: those of their cells that were met twice or more over all chunks, if ``counted`` with counts.

    ``bits`` are those of a block.  Counts stop at 2 ** 32 - 1 (255 where only two or more matters).
    """
    kind = np.uint32 if counted else np.uint8

    def block(group: pa.Table) -> pa.Table:
        total = np.zeros(1 << bits, kind)
        most = np.iinfo(kind).max
        codes, own, place = (group[c] for c in ("a", "chunk", "block"))
        for code, again, times in zip(codes, group["b"], group["c"], strict=True):
            at = unrice(code.as_py())
            add = np.ones(len(at), kind)
            if again.is_valid:
                add[unrice(again.as_py())] = np.minimum(np.frombuffer(times.as_py(), np.uint32), most)
            total[at] += np.minimum(add, most - total[at])
        out = []
        for code, chunk, number, plane in zip(codes, own, place, group["kind"], strict=True):
            at = unrice(code.as_py())
            at = at[total[at] >= 2]
            if len(at):
                out.append({"chunk": chunk.as_py(), "kind": plane.as_py(), "block": number.as_py(), "a": rice(at),
                            "c": total[at].tobytes() if counted else None})
        return mail(out)
    return sent.groupBy("kind", "block").applyInArrow(block, MAIL)


class Returned:
    """The cells of one plane that came back to a chunk."""

    def __init__(self, right: pa.Table, plane: int, bits: int) -> None:
        rows = sorted(right.filter(pc.equal(right["kind"], plane)).to_pylist(), key=lambda r: r["block"])
        parts = [unrice(r["a"]).astype(np.uint64) + np.uint64(r["block"] << bits) for r in rows]
        self.cells = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        counts = [np.frombuffer(r["c"], np.uint32) for r in rows if r["c"] is not None]
        self.counts = np.concatenate(counts) if counts else np.full(len(self.cells), 2, np.uint32)
        self._mask = np.uint64((1 << 22) - 1)
        self._maybe = np.zeros(1 << 22, bool)
        self._maybe[self.cells & self._mask] = True

    def estimates(self, at: np.ndarray) -> np.ndarray:
        """The count of each cell: what came back, else 1."""
        found = np.ones(len(at), np.uint32)
        seen = np.flatnonzero(self._maybe[at & self._mask])
        if len(seen):
            place = np.minimum(np.searchsorted(self.cells, at[seen]), len(self.cells) - 1)
            same = self.cells[place] == at[seen]
            found[seen[same]] = self.counts[place[same]]
        return found
