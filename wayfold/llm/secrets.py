"""Secret scan: fixed patterns, and a character network over further candidates in their context."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfold.llm import cnn, flat
from wayfold.llm.frames import packed, unpacked

ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"[0-9a-f]{16,}")
_HINTS = (b"passw", b"secret", b"token", b"key")
#: What the patterns drop or do not reach, and the network is asked about: short access keys and hex runs, and words that
#: announce a secret with a short value or another separator.
SHORT_ACCESS = re.compile(rb"AKIA[A-Z0-9]{2,}")
SHORT_HEX = re.compile(rb"(?<![A-Za-z0-9])(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{8,15}(?![A-Za-z0-9])")
ANNOUNCED = re.compile(rb"""(?:password|passwd|pwd|secret|token|api[_ -]?key|key)["']?(?:\x20*(?:[:=]>?|->|\|)|\x20+is)\x20*["']?([A-Za-z0-9+/_.=-]{4,})""", re.IGNORECASE)
KINDS = ("assign", "access", "hex", "net")
#: Families of candidates, each with a threshold of its own: announced values, access keys, hex runs, other long runs.
FAMILIES = 4
#: Shortest run of key characters that is a candidate of its own, and least length of an assigned value.
RUN, VALUE = 16, 12
_KEY = np.zeros(256, bool)
_KEY[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: Window of the network: context before, candidate with context behind.
BEFORE, LENGTH = 32, 112
#: Bound of the training sample: documents looked through, findings of each label.
DOCUMENTS, FINDINGS = 40_000, 4_000
RECALL = 0.99

#: Start, end and kind; of a candidate: start, end and family.
Span = tuple[int, int, int]


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the maximal runs of at least :data:`RUN` key characters, none across two texts."""
    inside = _KEY[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = ends - starts >= RUN
    return starts[long], ends[long]


def scan(data: np.ndarray, offsets: np.ndarray) -> tuple[list[list[Span]], list[list[Span]]]:
    """Pattern spans and further candidates of each text, as (start, end, kind) in bytes of the text.

    Hex runs and access keys consist of key characters and so lie within the long runs; assignments are searched in
    the texts that hold one of their words.  A candidate is a long run with a letter and a digit that no pattern touches.
    """
    rows = len(offsets) - 1
    base: list[list[Span]] = [[] for _ in range(rows)]
    more: list[list[Span]] = [[] for _ in range(rows)]
    raw = data.tobytes()
    for i in range(rows):
        own = raw[offsets[i]:offsets[i + 1]]
        low = own.lower()
        if any(h in low for h in _HINTS) or b"pwd" in low:
            base[i] += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(own) if m.end(1) - m.start(1) >= VALUE]
            more[i] += [(m.start(), m.end(), 0) for m in ANNOUNCED.finditer(own)]
        if b"AKIA" in own:
            more[i] += [(m.start(), m.end(), 1) for m in SHORT_ACCESS.finditer(own)]
        more[i] += [(m.start(), m.end(), 2) for m in SHORT_HEX.finditer(own)]
    starts, ends = _runs(data, offsets)
    owner = np.searchsorted(offsets, starts, "right") - 1
    digits, letters = np.append(0, np.cumsum(_DIGIT[data])), np.append(0, np.cumsum(_LETTER[data]))
    mixed = (digits[ends] > digits[starts]) & (letters[ends] > letters[starts])
    for s, e, i, both in zip(starts.tolist(), ends.tolist(), owner.tolist(), mixed.tolist(), strict=True):
        run, at = raw[s:e], s - int(offsets[i])
        for kind, pattern in ((1, ACCESS), (2, HEX)):
            base[i] += [(at + m.start(), at + m.end(), kind) for m in pattern.finditer(run)]
        if both:
            more[i].append((at, at + e - s, 3))
    for i in range(rows):
        base[i].sort(key=lambda x: (x[0], x[2]))
        if more[i]:
            more[i] = _apart(sorted(more[i], key=lambda x: (x[0], -x[1], x[2])), base[i])
    return base, more


def _apart(candidates: list[Span], base: list[Span]) -> list[Span]:
    """Of sorted candidates those that touch no base span and none taken before them."""
    starts = [a for a, _, _ in base]
    reach = list(accumulate((b for _, b, _ in base), max))
    out: list[Span] = []
    free = 0
    for s, e, family in candidates:
        # of the base spans that start before this one ends, the farthest end tells whether any reaches into it
        before = bisect_left(starts, e)
        if s >= free and (not before or reach[before - 1] <= s):
            out.append((s, e, family))
            free = e
    return out


def _pictures(data: np.ndarray, offsets: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Windows of (text, start, end): ASCII outside the candidate as it is, inside with the high bit; other bytes are 1."""
    if not spans:
        return np.zeros((0, LENGTH), np.uint8)
    rows, starts, ends = (np.array(x, np.int64) for x in zip(*spans, strict=True))
    at = (offsets[rows] + starts - BEFORE)[:, None] + np.arange(LENGTH)
    inside = (at >= offsets[rows][:, None]) & (at < offsets[rows + 1][:, None])
    symbols = np.where(data < 128, np.maximum(data, 1), 1).astype(np.uint8)
    x = np.where(inside, symbols[np.clip(at, 0, len(data) - 1)], 0).astype(np.uint8)
    within = inside & (at >= (offsets[rows] + starts)[:, None]) & (at < (offsets[rows] + ends)[:, None])
    return x | (within.astype(np.uint8) << 7)


class SecretModel:
    """The network, its calibration, and each family's threshold on the calibrated probability.

    ``recall`` and ``precision`` are those of held-out findings that neither the fit, the calibration nor the thresholds saw.
    """

    def __init__(self, net: cnn.ConvNet | None, thresholds: Sequence[float] = (1.0,) * FAMILIES, recall: float | None = None,
                 precision: float | None = None) -> None:
        self.net, self.thresholds, self.recall, self.precision = net, np.array(thresholds), recall, precision

    def keep(self, data: np.ndarray, offsets: np.ndarray, spans: list[list[Span]]) -> list[list[Span]]:
        """The candidates that the network takes for secrets."""
        listed = [(i, s, e, f) for i, own in enumerate(spans) for s, e, f in own]
        out: list[list[Span]] = [[] for _ in spans]
        if self.net is None or not listed:
            return out
        for at in range(0, len(listed), 4096):
            part = listed[at:at + 4096]
            p = cnn.softmax(self.net.scores(_pictures(data, offsets, [x[:3] for x in part])))[:, 1]
            for (i, s, e, family), score in zip(part, p, strict=True):
                if score >= self.thresholds[family]:
                    out[i].append((s, e, 3))
        return out


def train(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", documents: int = DOCUMENTS, findings: int = FINDINGS,
          recall: float = RECALL, seed: int = 3) -> SecretModel:
    """Fit on findings labelled by the patterns, from about ``documents`` documents picked by a hash of their id.

    Positive: every base finding (of an assignment whole and its value alone); half of them with their left context
    blanked, so that the value itself must be told, too.  Negative: the candidates that the patterns drop, and pieces of
    running text of a secret's length.  At most ``findings`` of each label.  Findings are dealt by a hash: three fifths
    fit the network, one calibrates its probability and sets each family's threshold to the highest that keeps ``recall``
    of that family's positives (of all positives, where a family has none), one measures recall and precision.  What is
    drawn from a text follows from the text alone.  Without a positive or a negative finding there is no network.
    """
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text")).filter("text IS NOT NULL")
    total = rows.count()
    step = F.lit(10_000_000)
    sample = rows.filter(F.pmod(F.xxhash64(F.coalesce("id", "text")), step) < int(min(1, documents / max(total, 1)) * 10_000_000))
    schema = pa.schema([("label", pa.int32()), ("family", pa.int32()), ("key", pa.int64()), ("picture", pa.binary())])

    def labelled(batches):
        for batch in batches:
            data, offsets = flat.flatten(batch["text"])
            for low, high in flat.slices(offsets):
                part, places = data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
                base, more = scan(part, places)
                spans, labels, families, keys, blank = [], [], [], [], []
                raw = part.tobytes()
                for i, (own, others) in enumerate(zip(base, more, strict=True)):
                    first, length = int(places[i]), int(places[i + 1] - places[i])
                    draw = np.random.default_rng([seed, zlib.crc32(raw[first:first + length])])
                    mine = [(s, e, kind, 1) for s, e, kind in own] + [(s, e, f, 0) for s, e, f in others]
                    for s, e, kind in own:
                        if kind == 0:
                            mine.append((s + ASSIGN.match(raw[first + s:first + e]).start(1), e, 3, 1))
                    size = int(draw.integers(RUN, 48))
                    if length > size:
                        s = int(draw.integers(0, length - size))
                        if not any(a < s + size and s < b for a, b, _ in own):
                            mine.append((s, s + size, 3, 0))
                    for s, e, family, label in mine:
                        spans.append((i, s, e))
                        labels.append(label)
                        families.append(family)
                    keys.append(draw.integers(0, 2**62, len(mine)))
                    blank.append(draw.random(len(mine)) < 0.5)
                x = _pictures(part, places, spans)
                if len(x):
                    x[np.concatenate(blank), :BEFORE] = 0
                yield pa.record_batch([pa.array(labels, pa.int32()), pa.array(families, pa.int32()), pa.array(np.concatenate(keys), pa.int64()),
                                       pa.array([r.tobytes() for r in x], pa.binary())], schema=schema)

    found = sample.select("text").mapInArrow(labelled, "label int, family int, key long, picture binary")
    sizes = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return SecretModel(None)
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, int(min(1, findings / n) * 10_000_000))])
    drawn = found.filter(F.pmod("key", step) < share[F.col("label")]).collect()
    return fit_findings(sorted((r["key"], r["label"], r["family"], bytes(r["picture"])) for r in drawn), recall, seed)


def fit_findings(found: list[tuple[int, int, int, bytes]], recall: float = RECALL, seed: int = 3) -> SecretModel:
    """The model of ``(key, label, family, picture)`` findings in order of their keys."""
    x = np.stack([np.frombuffer(r[3], np.uint8) for r in found])
    y, family = np.array([r[1] for r in found]), np.array([r[2] for r in found])
    place = np.empty(len(y), np.int64)
    for label in (0, 1):  # every part has its share of either label
        place[y == label] = np.arange((y == label).sum()) % 5
    fitted, tuned, held = place < 3, place == 3, place == 4
    if not tuned[y == 1].any():  # a handful of findings serves for all three
        fitted = tuned = np.ones(len(y), bool)
    net = cnn.ConvNet(2, widths=(3, 5), filters=12, seed=seed).fit(x[fitted], y[fitted], epochs=4).calibrate(x[tuned], y[tuned])
    p = cnn.softmax(net.scores(x))[:, 1]
    thresholds = []
    for f in range(FAMILIES):
        own = tuned & (y == 1) & (family == f)
        known = np.sort(p[own if own.any() else tuned & (y == 1)])
        thresholds.append(float(known[int((1 - recall) * len(known))]))
    if not held[y == 1].any():
        return SecretModel(net, thresholds)
    kept = p >= np.array(thresholds)[family]
    hits = float((kept & held & (y == 1)).sum())
    return SecretModel(net, thresholds, hits / (held & (y == 1)).sum(), hits / max(1.0, float((kept & held).sum())))


def find_secrets(docs: DataFrame, model: SecretModel, *, text: str = "text", mask: str | None = None) -> DataFrame:
    """The input's columns, ``n_assign``, ``n_access``, ``n_hex``, ``n_confirmed``, ``base`` and ``spans``; with ``mask``, the text masked.

    The network scores every candidate in its context, those of the patterns too: ``n_confirmed`` counts the pattern spans
    that it would have found alone, and of the others it adds what reaches its family's threshold.  ``base`` lists the pattern spans and ``spans`` all spans as ``kind:start:end`` in code points, by start, then kind.
    With ``mask`` every span (overlapping ones as one) is replaced by it in the text column.

    Defined results: a null or empty text has no span and stays as it is; equal texts get equal spans; an empty table
    gives an empty table; carried columns named as an output are replaced.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: tables of the network
    frame = packed(docs, text)
    counts = ["n_assign", "n_access", "n_hex", "n_confirmed"]
    schema = StructType(frame.schema.fields[:])
    for c in counts:
        schema = schema.add(c, "long")
    schema = schema.add("base", "string").add("spans", "string")

    def said(spans: list[Span], own: bytes) -> str:
        if not spans:
            return ""
        places = sorted({p for s, e, _ in spans for p in (s, e)})
        points, at, before = {}, 0, 0
        for p in places:
            at += len(own[before:p].decode("utf-8", "replace")) if before < p else 0
            points[p], before = at, p
        return ",".join(f"{KINDS[k]}:{points[s]}:{points[e]}" for s, e, k in spans)

    def masked(spans: list[Span], own: bytes) -> bytes:
        out, at = [], 0
        for s, e, _ in spans:
            if s >= at:
                out += [own[at:s], mask.encode()]
            at = max(at, e)
        return b"".join(out) + own[at:]

    def search(batches):
        model = known.value
        for batch in batches:
            data, offsets = flat.flatten(batch["text"])
            columns: list[list] = [[] for _ in range(6)]
            texts: list[bytes | None] = []
            valid = batch["text"].is_valid().to_pylist()
            for low, high in flat.slices(offsets):
                part, places = data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
                base, more = scan(part, places)
                added, confirmed = model.keep(part, places, more), model.keep(part, places, base)
                raw = part.tobytes() if mask else b""
                for i, (own, extra) in enumerate(zip(base, added, strict=True)):
                    for k in range(3):
                        columns[k].append(sum(x[2] == k for x in own))
                    columns[3].append(len(confirmed[i]))
                    spans = sorted(own + extra, key=lambda x: (x[0], x[2])) if extra else own
                    body = part[places[i]:places[i + 1]].tobytes() if spans else b""
                    columns[4].append(said(own, body))
                    columns[5].append(said(spans, body))
                    if mask:
                        body = raw[places[i]:places[i + 1]]
                        texts.append(None if not valid[low + i] else masked(spans, body) if spans else body)
            text_out = pa.array(texts, pa.binary()).cast(pa.string()) if mask else batch["text"]
            yield pa.record_batch([text_out, batch["row"], *[pa.array(c, pa.int64()) for c in columns[:4]],
                                   *[pa.array(c, pa.string()) for c in columns[4:]]], names=["text", "row", *counts, "base", "spans"])
    return unpacked(frame.mapInArrow(search, schema), *counts, "base", "spans", text=text)
