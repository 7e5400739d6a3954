"""Exact removal of repeated word windows behind a count-min prefilter."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm import flat, sketch
from wayfold.llm.frames import chunk_count, chunk_of, packed, text_bytes, unpacked

WIDTH = 13
#: Kind of the mail about exactly grouped windows, and what it says of a chunk's window: every document loses it,
#: or every one but the smallest id of the chunk.
CODES = -2
ALL, BUT_LOWEST = 1, 2


def _windows(texts: pa.ChunkedArray, width: int):
    """Per slice of texts: first row, bytes, text offsets, word starts, first word per text, word hashes, windows, their hashes."""
    data, offsets = flat.flatten(texts)
    for low, high in flat.slices(offsets):
        part, places = data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        starts, ends, firsts = flat.word_bounds(part, places)
        words = flat.span_hashes(part, starts, ends)
        at = flat.windows_inside(firsts, width)
        yield low, part, places, starts, firsts, words, at, flat.window_hashes(words, width, at)


class _Estimated:
    """A chunk's windows that the sketch takes for repeated: once each, with the smallest and largest id holding them.

    The order is by both hashes, so that it is the same in every pass over the chunk.
    """

    def __init__(self, group: pa.Table, right: pa.Table, width: int, bits: int, inner: int) -> None:
        group = group.filter(pa.array(np.isin(group["id"].fill_null(-1).to_numpy(), sketch.heads_of(right)) & group["id"].is_valid().to_numpy()))
        ids, known = group["id"].to_numpy(), [sketch.Returned(right, p, inner) for p in (0, 1)]
        hits: list[list[np.ndarray]] = [[], [], []]
        for low, _, _, _, firsts, words, at, h1 in _windows(group["text"], width):
            twice = known[0].estimates(sketch.cells(h1, bits)) >= 2
            twice[twice] = known[1].estimates(sketch.cells(h1[twice], bits, 1)) >= 2
            at = at[twice]
            for where, x in zip(hits, (h1[twice], flat.window_hashes(words, width, at, 1), ids[low + flat.owners(firsts, at)]), strict=True):
                where.append(x)
        h1, h2, own = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in hits)
        order = np.lexsort((own, h2, h1))
        h1, h2, own = h1[order], h2[order], own[order]
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(h1)) - 1
        self.h1, self.h2, self.low, self.high = h1[first], h2[first], own[first].astype(np.int64), own[last].astype(np.int64)


def remove_repeats(docs: DataFrame, *, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text",
                   spacing: str = "one") -> DataFrame:
    """Remove every word covered by a window of ``width`` words that also starts in a document with a smaller id.

    The result has the input's columns and ``n_words``, ``n_removed`` and ``kept_text``.  ``spacing="one"`` joins the
    kept words by one space; ``"original"`` keeps the white space behind each kept word, and a text that loses nothing
    as it is.

    First pass: every chunk of documents sends its windows to a sketch of two planes (see :mod:`wayfold.llm.sketch`);
    counts are only ever too high, so no repeat is lost.  Second pass: windows estimated repeated in both planes go,
    once per chunk with the smallest and largest id holding them, to an exact grouping by a 128-bit hash; what comes
    back says of each whether all of the chunk's documents lose it or all but its smallest id.  A window that all
    documents share costs one entry per chunk.  Of equal texts only the smallest id takes part.

    Defined results: a null text has no words (``kept_text`` is then empty, or null with original spacing); texts of
    fewer than ``width`` words lose nothing; rows with the same id do not repeat each other; a row with a null id
    neither loses words nor takes any; an empty table gives an empty table; carried columns named as an output are
    replaced.
    """
    total = text_bytes(docs, text)
    chunks, bits = chunk_count(total, sketch.chunk_bytes(total)), sketch.plane_bits(total // 6)
    inner = sketch.block_bits(bits, chunks)
    part_bits = max(0, (chunks - 1).bit_length() - 2)
    dealt = packed(docs, text, id=F.col(doc_id).cast("long")).withColumn(
        "chunk", chunk_of(F.coalesce("id", F.crc32(F.coalesce("text", F.lit("")))), chunks))
    # of equal texts the smallest id speaks for all: the others lose every word to it
    heads = dealt.filter("id IS NOT NULL AND text IS NOT NULL").groupBy(F.sha2("text", 256)).agg(F.min("id").alias("id"))
    named = sketch.heads_mail(heads.select("id").distinct().withColumn("chunk", chunk_of(F.col("id"), chunks)))

    def count(group: pa.Table, right: pa.Table) -> pa.Table:
        if not group.num_rows:
            return sketch.mail([])
        keep = group.filter(pa.array(np.isin(group["id"].fill_null(-1).to_numpy(), sketch.heads_of(right)) & group["id"].is_valid().to_numpy()))
        found = [w[-1] for w in _windows(keep["text"], width)]
        planes = [[sketch.cells(h, bits, p) for h in found] for p in (0, 1)]
        return sketch.mail(list(sketch.send([np.concatenate(p) for p in planes], group["chunk"][0].as_py(), inner)) if found else [])

    groups = dealt.groupBy("chunk")
    back = named.union(sketch.merge(groups.cogroup(named.groupBy("chunk")).applyInArrow(count, sketch.MAIL), inner, counted=False))

    def estimated(group: pa.Table, right: pa.Table) -> pa.Table:
        if not group.num_rows:
            return sketch.mail([])
        mine = _Estimated(group, right, width, bits, inner)
        parts = (mine.h1 >> np.uint64(64 - part_bits)).astype(np.int64) if part_bits else np.zeros(len(mine.h1), np.int64)
        cuts = np.append(np.flatnonzero(np.diff(parts, prepend=-1)), len(parts))
        return sketch.mail([{"chunk": group["chunk"][0].as_py(), "kind": CODES, "block": int(parts[i]),
                             "a": np.concatenate([mine.h1[i:j], mine.h2[i:j]]).tobytes(), "b": mine.low[i:j].tobytes(),
                             "c": np.packbits(mine.high[i:j] > mine.low[i:j]).tobytes()} for i, j in zip(cuts[:-1], cuts[1:], strict=True)])

    def exact(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        hashes = [np.frombuffer(r["a"], np.uint64).reshape(2, -1) for r in rows]
        h1, h2 = np.concatenate(hashes, axis=1)
        low = np.concatenate([np.frombuffer(r["b"], np.int64) for r in rows])
        several = np.concatenate([np.unpackbits(np.frombuffer(r["c"], np.uint8), count=x.shape[1]) for r, x in zip(rows, hashes, strict=True)])
        order = np.lexsort((low, h2, h1))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
        least = np.empty(len(h1), np.int64)
        least[order] = low[order][np.maximum.accumulate(np.where(new, np.arange(len(h1)), 0))]
        code = np.where(low > least, ALL, np.where(several > 0, BUT_LOWEST, 0)).astype(np.uint8)
        ends = np.cumsum([x.shape[1] for x in hashes])
        return sketch.mail([{"chunk": r["chunk"], "kind": CODES, "block": r["block"], "a": c.tobytes()}
                            for r, c in zip(rows, np.split(code, ends[:-1]), strict=True)])

    exactly = groups.cogroup(back.groupBy("chunk")).applyInArrow(estimated, sketch.MAIL).groupBy("block").applyInArrow(exact, sketch.MAIL)
    schema = dealt.select("id", "text", "row").schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")

    def cut(group: pa.Table, right: pa.Table) -> pa.Table:
        ids = group["id"].fill_null(-(2**63)).to_numpy()
        copy = group["id"].is_valid().to_numpy() & ~np.isin(ids, sketch.heads_of(right))
        codes = sorted(right.filter(pc.equal(right["kind"], CODES)).to_pylist(), key=lambda r: r["block"])
        g1 = np.zeros(0, np.uint64)
        if codes:
            mine = _Estimated(group, right, width, bits, inner)
            code = np.concatenate([np.frombuffer(r["a"], np.uint8) for r in codes])
            g1, g2, code, lowest = mine.h1[code > 0], mine.h2[code > 0], code[code > 0], mine.low[code > 0]
        words, removed, kept = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), []
        valid = group["text"].is_valid().to_numpy()
        for low, part, places, starts, firsts, hashed, at, h1 in _windows(group["text"], width):
            rows = len(places) - 1
            words[low:low + rows] = np.diff(firsts)
            drop = np.zeros(int(firsts[-1]) + 1, np.int64)
            owner = flat.owners(firsts, at)
            hit = copy[low + owner]
            if len(g1) and len(at):
                place = np.minimum(np.searchsorted(g1, h1), len(g1) - 1)
                same = np.flatnonzero(g1[place] == h1)
                place = place[same]
                meant = (g2[place] == flat.window_hashes(hashed, width, at[same], 1)) & (
                    (code[place] == ALL) | (ids[low + owner[same]] != lowest[place])) & (ids[low + owner[same]] != -(2**63))
                hit[same[meant]] = True
            drop[at[hit]] += 1
            drop[at[hit] + width] -= 1
            gone_words = np.cumsum(drop)[:-1] > 0
            removed[low:low + rows] = np.diff(np.append(0, np.cumsum(gone_words))[firsts])
            raw = part.tobytes()
            for i in range(rows):
                own = raw[places[i]:places[i + 1]]
                if spacing == "one":
                    parts = own.split()
                    if removed[low + i]:
                        parts = compress(parts, ~gone_words[firsts[i]:firsts[i + 1]])
                    kept.append(b" ".join(parts))
                elif not valid[low + i]:
                    kept.append(None)
                elif not removed[low + i]:
                    kept.append(own)
                else:
                    begin = np.append(starts[firsts[i]:firsts[i + 1]] - places[i], len(own))
                    stays = ~gone_words[firsts[i]:firsts[i + 1]]
                    kept.append(own[:begin[0]] + b"".join(own[a:b] for a, b, s in zip(begin[:-1], begin[1:], stays, strict=True) if s))
        out = pa.array(kept, pa.binary()).cast(pa.string())
        result = group.select(["id", "text", "row"])
        return result.append_column("n_words", pa.array(words)).append_column("n_removed", pa.array(removed)).append_column("kept_text", out)

    done = groups.cogroup(back.union(exactly).groupBy("chunk")).applyInArrow(cut, schema)
    return unpacked(done, "n_words", "n_removed", "kept_text", text=text)
