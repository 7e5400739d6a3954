"""SentencePiece BPE encoding and decoding in vectorised merge rounds."""

from __future__ import annotations

import codecs
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType

from wayfold.llm import flat
from wayfold.llm.frames import packed, unpacked

MARK = "▁"
NONE = np.iinfo(np.int32).max
#: Words remembered by a worker, at most so long in characters; both only bound its memory.
REMEMBERED, LONGEST = 300_000, 48
codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Vocabulary:
    """A SentencePiece BPE model as arrays: symbols of characters, ranks of pieces, and which pairs make a piece."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        pieces = {model.id_to_piece(i): i for i in plain}
        self.bytes_ids = np.full(256, self.unknown, np.int32)
        for i in range(size):
            if model.is_byte(i):
                self.bytes_ids[int(model.id_to_piece(i)[1:-1], 16)] = i
        # single characters of pieces that are no piece themselves get symbols beyond the vocabulary
        symbols = dict(pieces)
        for c in sorted({c for p in pieces for c in p} - pieces.keys()):
            symbols[c] = size + len(symbols) - len(pieces)
        self.size = size
        self.of_char = np.full(0x110000, -1, np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        scores = np.array([model.get_score(i) for i in range(size)])
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in plain}, reverse=True))}
        self.rank = np.full(size, NONE, np.int32)
        for i in plain:
            self.rank[i] = order[scores[i]]
        pairs = sorted(((symbols[p[:k]] << 20) | symbols[p[k:]], i) for p, i in pieces.items() for k in range(1, len(p))
                       if p[:k] in symbols and p[k:] in symbols)
        self.keys = np.array([k for k, _ in pairs], np.int64)
        self.made = np.array([i for _, i in pairs], np.int32)
        # a piece may be merged at all its places in one round unless a piece that starts or ends with it comes first
        together = np.ones(size, bool)
        for p, i in pieces.items():
            for k in range(1, len(p)):
                for q in (p[:k], p[k:]):
                    j = pieces.get(q)
                    if j is not None and self.rank[j] >= self.rank[i]:
                        together[j] = False
        ranks, counts = np.unique(self.rank[plain], return_counts=True)
        together[np.isin(self.rank, ranks[counts > 1])] = False
        self.together = together
        # no piece continues with a space behind another character: words can be merged alone
        inner = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        newline = any("\n" in p for p in pieces)
        self.words = re.compile(r"(?s).+" if inner else r" *[^ ]+| +" if newline else r"\n| *[^ \n]+| +")
        texts = [b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i)
                 else bytes([int(model.id_to_piece(i)[1:-1], 16)]) if model.is_byte(i)
                 else model.id_to_piece(i).replace(MARK, " ").encode() for i in range(size)]
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(texts), np.uint8)
        self.silent = np.array([model.is_control(i) for i in range(size)])
        self.spaced = np.array([t.startswith(b" ") for t in texts]) & (np.arange(size) != self.unknown)
        self.memory: dict[str, bytes] = {}

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word: in every round each word merges its best pair, leftmost first, until none is left."""
        chars = np.frombuffer("".join(words).replace(" ", MARK).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words)), sizes)
        symbol = self.of_char[chars].astype(np.int64)
        place = np.arange(len(chars))  # the first character of each symbol
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbol):
            key = (symbol[:-1] << 20) | symbol[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            fits = (self.keys[at] == key) & (word[1:] == word[:-1]) & (symbol[:-1] >= 0) & (symbol[1:] >= 0)
            made = np.append(np.where(fits, self.made[at], 0), 0)
            rank = np.append(np.where(fits, self.rank[made[:-1]], NONE), NONE)
            heads = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.append(heads, len(word))))
            active = best < NONE
            if not active.all():
                done.append((word[~active], place[~active], symbol[~active]))
                symbol, word, place, rank, best, made = (x[active] for x in (symbol, word, place, rank, best, made))
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == best)
            owner = word[hit]
            first = np.diff(owner, prepend=-1) != 0
            # places that overlap (runs of one symbol) are taken every second time
            run = np.arange(len(hit)) - np.maximum.accumulate(np.where(first | (np.diff(hit, prepend=-2) != 1), np.arange(len(hit)), 0))
            hit = hit[first | (self.together[made[hit]] & (run % 2 == 0))]
            symbol[hit] = made[hit]
            stays = np.ones(len(symbol), bool)
            stays[hit + 1] = False
            symbol, word, place = symbol[stays], word[stays], place[stays]
        word, place, symbol = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (word, place, symbol)
        order = np.argsort(place, kind="stable")
        word, place, symbol = word[order], place[order], symbol[order]
        ids = symbol.astype(np.int32)
        odd = np.flatnonzero((symbol < 0) | (symbol >= self.size))
        if len(odd):  # characters without a piece become their bytes
            spelled = [self.bytes_ids[list(chr(chars[place[i]]).encode())] for i in odd]
            counts = np.ones(len(ids), np.int64)
            counts[odd] = [len(s) for s in spelled]
            word = np.repeat(word, counts)
            ids = np.repeat(ids, counts)
            firsts = (np.cumsum(counts) - counts)[odd]
            for f, s in zip(firsts, spelled, strict=True):
                ids[f:f + len(s)] = s
        return np.split(ids, np.searchsorted(word, np.arange(1, len(words))))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with begin and end, as little-endian unsigned 32-bit integers."""
        split = [self.words.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        memory = self.memory
        new = list({w for ws in split for w in ws} - memory.keys())
        found: dict[str, bytes] = {}
        at = 0
        while at < len(new):
            stop, size = at, 0
            while stop < len(new) and size < 400_000:
                size += len(new[stop])
                stop += 1
            found.update(zip(new[at:stop], (x.astype("<u4").tobytes() for x in self.merge(new[at:stop])), strict=True))
            at = stop
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        if found:
            both = lambda w: memory[w] if w in memory else found[w]
            if len(memory) + len(found) > REMEMBERED:
                out = [begin + b"".join(map(both, ws)) + end for ws in split]
                memory.clear()
                memory.update((w, x) for w, x in list(found.items())[:REMEMBERED // 2] if len(w) <= LONGEST)
                return out
            short = {w: x for w, x in found.items() if len(w) <= LONGEST}
            memory.update(short)
            if len(short) < len(found):
                return [begin + b"".join(map(both, ws)) + end for ws in split]
        return [begin + b"".join(map(memory.__getitem__, ws)) + end for ws in split]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Text of each run of ids; ids outside the vocabulary are an error."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        raw = self.flat[at].tobytes()
        cuts = np.append(0, ends)[bounds].tolist()
        loud = np.flatnonzero(~self.silent[ids])
        heads = np.append(loud, len(ids))[np.searchsorted(loud, bounds[:-1])] if len(ids) else bounds[:-1]
        out = []
        for i, head in enumerate(heads.tolist()):
            own = raw[cuts[i]:cuts[i + 1]]
            if head < bounds[i + 1] and self.spaced[ids[head]]:
                own = own[1:]  # the space that encoding puts in front
            out.append(own.decode("utf-8", "each_byte"))
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, *, text: str = "text", layout: str = "array", keep_text: bool = True) -> DataFrame:
    """The input's columns and ``ids``: what the library's encoder gives for the whole text, with begin and end ids.

    ``layout="array"`` gives ``array<int>``, ``"bytes"`` little-endian unsigned 32-bit integers in a binary.  ``path`` is
    the model file, present on every executor.  Words that no piece can cross are merged once per batch: each word is
    a run of symbols in flat arrays; every round finds the best pair of each word by a segmented minimum, merges it and
    compacts.  Where no longer piece could come first, all places of a word's best pair merge in one round.

    Defined results: a null or empty text has the begin and end ids only; equal texts get equal ids; an empty table
    gives an empty table; a carried column named ``ids`` is replaced.
    """
    frame = packed(docs, text)
    kind = BinaryType() if layout == "bytes" else ArrayType(IntegerType())
    schema = frame.select(*(["text"] if keep_text else []), "row").schema.add("ids", kind)

    def run(batches):
        model = vocabulary(path)
        for batch in batches:
            _, offsets = flat.flatten(batch["text"])
            for low, high in flat.slices(offsets):
                rows = batch.slice(low, high - low)
                out = model.encode([t or "" for t in rows["text"].to_pylist()])
                if layout == "bytes":
                    ids = pa.array(out, pa.binary())
                else:
                    ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(x) // 4 for x in out])), pa.int32()),
                                                   pa.array(np.frombuffer(b"".join(out), "<i4")))
                yield pa.record_batch([*([rows["text"]] if keep_text else []), rows["row"], ids], names=schema.names)
    return unpacked(frame.mapInArrow(run, schema), "ids", text=text if keep_text else None)


def decode(docs: DataFrame, path: str, *, ids: str = "ids") -> DataFrame:
    """The input's columns and ``decoded``, the library's text of the ids (an array or little-endian binary).

    Defined results: null ids give null, no ids an empty text; invalid byte pieces become U+FFFD one by one; a carried
    column named ``decoded`` is replaced.
    """
    frame = packed(docs, ids)
    schema = StructType(frame.schema.fields[:]).add("decoded", "string")

    def run(batches):
        model = vocabulary(path)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                rows = batch.slice(low, 256)
                given = rows["text"].to_pylist() if pa.types.is_binary(rows["text"].type) else [
                    None if x is None else np.array(x, "<u4").tobytes() for x in rows["text"].to_pylist()]
                bounds = np.append(0, np.cumsum([len(x or b"") // 4 for x in given]))
                texts = model.decode(np.frombuffer(b"".join(x or b"" for x in given), "<u4").astype(np.int64), bounds)
                texts = [None if x is None else t for x, t in zip(given, texts, strict=True)]
                yield pa.record_batch([rows["text"], rows["row"], pa.array(texts, pa.string())], names=schema.names)
    return unpacked(frame.mapInArrow(run, schema), "decoded", text=ids)
