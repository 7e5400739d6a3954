"""Quality rules: text counts, and a linear-chain conditional random field that labels lines content or boilerplate."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm import flat
from wayfold.llm.frames import packed, unpacked

# fixed values: the counted symbols, sentence ends, and the limits of the base rules
SYMBOLS, ENDS, FEWEST_WORDS, MOST_REPEATED = b"#*$%&|<>", b".!?:;\"')", 50, 50
#: Bound of the training sample: labelled documents of each quality, lines of a document that are learned from.
DOCUMENTS, LINES = 1500, 64
CONTENT_SHARE = 0.5
FEATURES = ("bias", "empty", "length", "symbols", "repeats", "duplicate", "ended", "digits", "word_length")
_FLAGS = np.zeros((3, 256), bool)
_FLAGS[0, list(SYMBOLS)] = _FLAGS[1, list(ENDS)] = _FLAGS[2, 48:58] = True


def measure(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Counts of each text; then for all lines in order their features, their number of words, and each text's first line."""
    rows = len(offsets) - 1
    starts, ends, firsts = flat.word_bounds(data, offsets)
    hashes = flat.span_hashes(data, starts, ends)
    total = lambda flags: np.append(0, np.cumsum(flags))
    points = total((data & 0xC0) != 0x80)
    per_word = np.append(0, np.cumsum(points[ends] - points[starts]))
    symbols, digits = total(_FLAGS[0][data]), total(_FLAGS[2][data])
    # words in windows of three that the text holds twice
    at = flat.windows_inside(firsts, 3)
    key = flat.window_hashes(hashes, 3, at) ^ flat.mix(flat.owners(firsts, at).astype(np.uint64) + np.uint64(1))
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    twice = at[times[inverse] > 1] if len(at) else at
    covered = np.zeros(len(starts) + 1, np.int64)
    covered[twice] += 1
    covered[twice + 3] -= 1 if len(twice) else 0
    repeated = total(np.cumsum(covered)[:-1] > 0)
    # lines: one more than line feeds in every text
    feeds = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    owner = np.searchsorted(feeds, offsets) + np.arange(rows + 1)
    line_ends = np.empty(len(line_starts), np.int64)
    line_ends[:-1] = line_starts[1:] - 1
    line_ends[owner[1:] - 1] = offsets[1:]
    low, high = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    words = high - low
    text = np.repeat(np.arange(rows), np.diff(owner))
    name = flat.mix(flat.span_hashes(data, line_starts, line_ends) + flat.mix(text.astype(np.uint64) + np.uint64(7)))
    order = np.argsort(name, kind="stable")
    again = np.zeros(len(name), bool)
    again[order[1:]] = name[order[1:]] == name[order[:-1]]
    again &= words > 0
    count = np.maximum(words, 1)
    last = data[np.maximum(ends[np.maximum(high - 1, 0)] - 1, 0)] if len(starts) else np.zeros(len(words), np.uint8)
    features = np.stack([np.ones(len(words)), words == 0, np.log1p(words) / 4,
                         np.minimum((symbols[line_ends] - symbols[line_starts]) / count, 2), (repeated[high] - repeated[low]) / count,
                         again, (words > 0) & _FLAGS[1][last], np.minimum((digits[line_ends] - digits[line_starts]) / count, 2),
                         np.minimum((per_word[high] - per_word[low]) / count / 10, 4)], 1)
    of = lambda x: np.diff(x)
    counts = {"n_words": of(firsts), "word_chars": of(per_word[firsts]), "n_symbols": of(symbols[offsets]),
              "n_dup_lines": of(total(again)[owner]), "n_repeat_words": of(repeated[firsts])}
    return counts, features, words, owner


class LineModel:
    """Weights of the features for content, and scores of the four steps between boilerplate (0) and content (1)."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray) -> None:
        self.weights, self.steps = weights, steps

    def label(self, features: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Viterbi labels of all lines; texts advance together, line by line."""
        gain = features @ self.weights
        sizes = np.diff(firsts)
        order = np.argsort(-sizes, kind="stable")
        heads, sizes = firsts[:-1][order], sizes[order]
        came = np.zeros((len(gain), 2), np.int8)
        best = np.zeros((len(order), 2))
        longest = int(sizes[0]) if len(sizes) else 0
        for t in range(longest):
            n = int(np.searchsorted(-sizes, -t, "left"))  # texts with more than t lines
            at = heads[:n] + t
            if t:
                paths = best[:n, :, None] + self.steps[None]
                came[at] = paths.argmax(1)
                best[:n] = paths.max(1)
            best[:n, 1] += gain[at]
        out = np.zeros(len(gain), np.int8)
        state = best.argmax(1).astype(np.int8)
        for t in range(longest - 1, -1, -1):
            n = int(np.searchsorted(-sizes, -t, "left"))
            at = heads[:n] + t
            out[at] = state[:n]
            state[:n] = came[at, state[:n]]
        return out


def fit(features: list[np.ndarray], labels: list[np.ndarray], rounds: int = 200, rate: float = 0.1, decay: float = 1e-3) -> LineModel:
    """Maximum conditional likelihood by forward-backward sums over padded line sequences, with Adam."""
    longest, docs, width = max(map(len, labels), default=0), len(labels), len(FEATURES)
    x, y, there = np.zeros((docs, longest, width)), np.zeros((docs, longest), int), np.zeros((docs, longest), bool)
    for i, (f, v) in enumerate(zip(features, labels, strict=True)):
        x[i, :len(v)], y[i, :len(v)], there[i, :len(v)] = f, v, True
    theta, first, second = np.zeros(width + 4), np.zeros(width + 4), np.zeros(width + 4)
    pair = there[:, 1:]
    seen = np.array([[(pair & (y[:, :-1] == a) & (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    lines = max(int(there.sum()), 1)
    for step in range(1, rounds + 1):
        steps = theta[width:].reshape(2, 2)
        score = np.stack([np.zeros((docs, longest)), x @ theta[:width]], 2)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        for t in range(longest):
            forward[:, t] = score[:, t] + (_sum(forward[:, t - 1, :, None] + steps, 1) if t else 0)
        for t in range(longest - 2, -1, -1):
            after = _sum(steps + (score[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(there[:, t + 1, None], after, 0)
        both = forward + backward
        whole = _sum(both, 2)
        content = np.where(there, np.exp(both[..., 1] - whole), 0)
        expected = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                joint = forward[:, :-1, a] + steps[a, b] + score[:, 1:, b] + backward[:, 1:, b] - whole[:, 1:]
                expected[a, b] = np.exp(np.where(pair, joint, -np.inf)).sum()
        gradient = np.append(np.einsum("dt,dtf->f", np.where(there, y - content, 0), x), (seen - expected).ravel()) / lines - decay * theta
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return LineModel(theta[:width], theta[width:].reshape(2, 2))


def _sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
          documents: int = DOCUMENTS, run: int = LINES) -> LineModel:
    """Fit on about ``documents`` labelled documents of each quality, picked by a hash of their id, and of each on up to
    ``run`` lines that follow one another, from a place that a hash of the id picks among all its lines.

    Lines of good documents are content unless they repeat an earlier line.  Lines of poor documents are boilerplate if
    they repeat words or lines or hold symbols, else content.  Without labelled documents every line is content.
    """
    step = 10_000_000
    named = labels.select(F.col(doc_id).alias("id"), F.col(quality).cast("int").alias("good")).filter("good IN (0, 1) AND id IS NOT NULL")
    sizes = {r["good"]: r["count"] for r in named.groupBy("good").count().collect()}
    if not sizes:
        return LineModel(np.eye(len(FEATURES))[0], np.zeros((2, 2)))
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, int(min(1, documents / n) * step))])
    sample = named.filter(F.pmod(F.xxhash64("id"), F.lit(step)) < share[F.col("good")]).groupBy("id").agg(F.min("good").alias("good"))
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter("text IS NOT NULL").join(
        F.broadcast(sample), "id")  # as many ids as the bound of the sample
    schema = pa.schema([("id", pa.string()), ("features", pa.list_(pa.float64())), ("labels", pa.list_(pa.int32()))])

    def lines(batches):
        for batch in batches:
            data, offsets = flat.flatten(batch["text"])
            for low, high in flat.slices(offsets):
                part, places = data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
                _, features, _, owner = measure(part, places)
                symbols, repeats, again = (features[:, FEATURES.index(n)] for n in ("symbols", "repeats", "duplicate"))
                poor = (symbols > 0.2) | (repeats > 0.5) | (again > 0) | (features[:, 1] > 0)
                good = batch["good"].slice(low, high - low).to_numpy()
                wanted = np.where(np.repeat(good == 1, np.diff(owner)), again == 0, ~poor).astype(np.int32)
                for i in range(high - low):
                    first = owner[i] + zlib.crc32(str(batch["id"][low + i].as_py()).encode()) % max(1, owner[i + 1] - owner[i] - run + 1)
                    at = slice(first, min(first + run, owner[i + 1]))
                    yield pa.record_batch([pa.array([str(batch["id"][low + i].as_py())]), pa.array([features[at].ravel()], schema.field(1).type),
                                           pa.array([wanted[at]], schema.field(2).type)], schema=schema)
    found = sorted(map(tuple, rows.select("id", "text", "good").mapInArrow(lines, "id string, features array<double>, labels array<int>").collect()))
    return fit([np.array(f).reshape(-1, len(FEATURES)) for _, f, _ in found], [np.array(v) for _, _, v in found])


def judge(docs: DataFrame, model: LineModel, *, text: str = "text", content_share: float = CONTENT_SHARE) -> DataFrame:
    """The input's columns, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``content_share`` and ``kept``.

    The base rules fail a text of fewer than 50 words or with more than half of its words in repeated windows of three.
    Other texts are kept if at least ``content_share`` of their words stand in lines labelled content.

    Defined results: a null or empty text has no words and fails; equal texts get equal results; an empty table gives
    an empty table; carried columns named as an output are replaced.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: a dozen weights
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    frame = packed(docs, text)
    schema = frame.select("text", "row").schema
    for n in names:
        schema = schema.add(n, "long")
    schema = schema.add("base_failed", "boolean").add("content_share", "double").add("kept", "boolean")

    def run(batches):
        for batch in batches:
            data, offsets = flat.flatten(batch["text"])
            for low, high in flat.slices(offsets):
                counts, features, words, owner = measure(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
                content = np.append(0, np.cumsum(words * known.value.label(features, owner)))
                n = counts["n_words"]
                share = np.diff(content[owner]) / np.maximum(n, 1)
                failed = (n < FEWEST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * n)
                rows = batch.slice(low, high - low)
                yield pa.record_batch([rows["text"], rows["row"], *[pa.array(counts[c].astype(np.int64)) for c in names], pa.array(failed),
                                       pa.array(share), pa.array(~failed & (share >= content_share))], names=schema.names)
    return unpacked(frame.mapInArrow(run, schema), *names, "base_failed", "content_share", "kept", text=text)
