"""Language identification with a byte convolutional network."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm import cnn, flat
from wayfold.llm.frames import packed, unpacked

LENGTH = 256
#: Bound of the training sample: documents of each language and of all together, windows of each document.
DOCUMENTS, SAMPLE, WINDOWS = 800, 100_000, 4
UNKNOWN = "und"


class LanguageModel:
    def __init__(self, languages: list[str], net: cnn.ConvNet | None) -> None:
        self.languages, self.net = languages, net

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and probability of each text, from all of its windows: log-probabilities weighted by window length."""
        rows = len(offsets) - 1
        if self.net is None:
            return np.zeros(rows, np.int64), np.full(rows, 1.0 if self.languages else 0.0)
        sizes = np.diff(offsets)
        count = -(-sizes // LENGTH)
        own = np.repeat(np.arange(rows), count)
        first = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
        starts = offsets[own] + first * LENGTH
        total = np.zeros((rows, len(self.languages)))
        for i in range(0, len(own), 4096):
            part = slice(i, i + 4096)
            x = cnn.windows(data, starts[part], offsets[own[part] + 1], LENGTH)
            logs = np.log(cnn.softmax(self.net.scores(x)) + 1e-9)
            np.add.at(total, own[part], logs * ((x > 0).sum(1) / LENGTH)[:, None])
        weight = np.maximum(sizes / LENGTH, 1e-9)[:, None]
        p = cnn.softmax(total / np.maximum(weight / 4, 1))  # windows of a text are not independent
        best = p.argmax(1)
        return best, p[np.arange(rows), best]


def train(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", documents: int = DOCUMENTS,
          sample: int = SAMPLE, windows: int = WINDOWS, seed: int = 5) -> LanguageModel:
    """Fit on a bounded sample of labelled documents: about ``documents`` of each language, by a hash of the id, and of
    each at most ``windows`` pieces at hashed places.  Every language is learned; with so many that ``sample`` documents
    do not go round, each has its share of them, and one at least."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        "lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.groupBy("lang").count().collect()
    languages = sorted(r["lang"] for r in counts)
    documents = max(1, min(documents, sample // max(1, len(languages))))
    if len(languages) < 2:
        return LanguageModel(languages, None)
    # a share of each language's ids; ten million steps of the hash are finer than any bound here
    shares = rows.sparkSession.createDataFrame([(r["lang"], -(-min(r["count"], documents) * 10_000_000 // r["count"])) for r in counts], "lang string, share long")
    drawn = F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), "text")), F.lit(10_000_000))
    chosen = rows.withColumn("_drawn", drawn).join(F.broadcast(shares), "lang").filter((F.col("_drawn") < F.col("share")) & _has_letter(F.col("text")))
    schema = pa.schema([("lang", pa.string()), ("key", pa.int64()), ("piece", pa.binary())])

    def pieces(batches):
        for batch in batches:
            data, offsets = flat.flatten(batch["text"])
            for i, name in enumerate(batch["lang"].to_pylist()):
                raw = data[offsets[i]:offsets[i + 1]]
                draw = np.random.default_rng([seed, len(raw), int(raw[:64].sum())])
                out = []
                for _ in range(min(windows, 1 + len(raw) // LENGTH)):
                    # short pieces too, so that short texts are known ground
                    size = int(min(len(raw), draw.choice([24, 64, 128, LENGTH, LENGTH])))
                    at = int(draw.integers(0, len(raw) - size + 1))
                    out.append(raw[at:at + size].tobytes())
                yield pa.record_batch([pa.array([name] * len(out)), pa.array(draw.integers(0, 2**62, len(out))), pa.array(out, pa.binary())],
                                      schema=schema)
    found = sorted(map(tuple, chosen.select("text", "lang").mapInArrow(pieces, "lang string, key long, piece binary").collect()))
    found.sort(key=lambda r: (r[1], r[0], r[2]))
    x = np.zeros((len(found), LENGTH), np.uint8)
    for i, (_, _, piece) in enumerate(found):
        x[i, :len(piece)] = np.frombuffer(bytes(piece), np.uint8)
    number = {name: i for i, name in enumerate(languages)}
    y = np.array([number[r[0]] for r in found], np.int64)
    held = np.arange(len(found)) % 8 == 0
    net = cnn.ConvNet(len(languages), seed=seed).fit(x[~held], y[~held], epochs=6)
    return LanguageModel(languages, net.calibrate(x[held], y[held]))


def _has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text") -> DataFrame:
    """The input's columns, ``lang_pred`` and ``score`` (0 to 1), from the whole text in windows of :data:`LENGTH` bytes.

    Defined results: a text that is null or has no letter gets ``und`` with score 0, as does every text if the model
    knows no language; a model of one language answers with it; an empty table gives an empty table; equal texts get
    equal answers; carried columns named as an output are replaced.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: tables of the network
    frame = packed(docs, text, letter=_has_letter(F.col(text)))
    schema = frame.select("text", "row").schema.add("lang_pred", "string").add("score", "double")

    def predict(batches):
        model = known.value
        for batch in batches:
            data, offsets = flat.flatten(batch["text"])
            names, scores = [], []
            for low, high in flat.slices(offsets):
                best, p = model.predict(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
                letters = batch["letter"].slice(low, high - low).to_numpy(zero_copy_only=False) & bool(model.languages)
                names += [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
                scores.append(np.where(letters, p, 0.0))
            yield pa.record_batch([batch["text"], batch["row"], pa.array(names, pa.string()),
                                   pa.array(np.clip(np.concatenate(scores), 0, 1) if scores else [], pa.float64())],
                                  names=["text", "row", "lang_pred", "score"])
    return unpacked(frame.mapInArrow(predict, schema), "lang_pred", "score", text=text)
