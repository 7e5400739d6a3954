"""Document quality: classifier evidence combined with host and path posteriors by hierarchical empirical Bayes."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm.frames import stored

#: Bound of the training sample, and hashed word features.
DOCUMENTS, BUCKETS = 10_000, 1024
_SHAPES = ("symbols", "digits", "capitals", "distinct", "word_length", "line_length", "ended", "short")
_CLIP = 12.0


def _shapes(text: Column) -> dict[str, Column]:
    letters = F.greatest(F.length(text), F.lit(1))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.greatest(F.size(words), F.lit(1))
    count = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    return {"words": words, "symbols": F.least(count(r"[#*$%&|<>]") / n, F.lit(2.0)), "digits": count(r"[0-9]") / letters,
            "capitals": count(r"\p{Lu}") / letters, "distinct": F.size(F.array_distinct(words)) / F.pow(n, F.lit(0.8)),
            "word_length": F.least(letters / n / 10, F.lit(5.0)), "line_length": F.log1p(n / (count(r"\n") + 1)),
            "ended": count(r"[.!?]") / n, "short": (n < 20).cast("double")}


def _features(docs: DataFrame) -> DataFrame:
    """``docs`` (id, text, more) with its shape columns and words; each shape is a plain number."""
    shapes = _shapes(F.coalesce("text", F.lit("")))
    return docs.withColumns({k: v if k == "words" else v.cast("double") for k, v in shapes.items()}).drop("text")


class Evidence:
    """A fitted classifier and the share of good documents it was fitted on; without labels it says nothing."""

    def __init__(self, model: PipelineModel | None, share: float) -> None:
        self.model, self.share = model, share

    def probability(self, docs: DataFrame) -> DataFrame:
        """``docs`` without its text, with ``p``: probability of good quality from the text alone."""
        if self.model is None:
            return docs.drop("text").withColumn("p", F.lit(self.share))
        p = vector_to_array(F.col("probability"))[1]
        return self.model.transform(_features(docs)).withColumn("p", p).drop("probability", "words", "terms", "features", *_SHAPES)


def train(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
          documents: int = DOCUMENTS) -> Evidence:
    """Logistic regression on hashed words and text shapes of about ``documents`` labelled documents, by a hash of the id."""
    named = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(quality).cast("double").alias("label")).filter(
        "label IN (0, 1) AND id IS NOT NULL")
    total, good = named.agg(F.count("*"), F.avg("label")).first()
    if not total or good in (0.0, 1.0):
        return Evidence(None, 0.5 if good is None else float(good))
    step = 10_000_000
    sample = named.filter(F.pmod(F.xxhash64("id"), F.lit(step)) < int(min(1, documents / total) * step)).groupBy("id").agg(
        F.min("label").alias("label"))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")  # bounded
    rows = stored(_features(rows).orderBy("id"), "labelled")  # one order, one fit
    hashed = HashingTF(inputCol="words", outputCol="terms", numFeatures=BUCKETS, binary=True)
    gathered = VectorAssembler(inputCols=["terms", *_SHAPES], outputCol="features")
    fit = LogisticRegression(maxIter=40, regParam=1e-3, standardization=True)
    fit.setParams(rawPredictionCol="", predictionCol="")
    if rows.select("label").distinct().count() < 2:
        return Evidence(None, float(good))
    return Evidence(Pipeline(stages=[hashed, gathered, fit]).fit(rows), float(good))


def _logit(p: Column) -> Column:
    odds = F.log(p / (1 - p))
    return F.greatest(F.least(odds, F.lit(_CLIP)), F.lit(-_CLIP))


def _strength(groups: DataFrame, mean: Column) -> float:
    """Prior strength by moments: how much less the group means differ from ``mean`` than single documents do.

    ``groups`` has n, s (sum of p) and q (sum of squares).  The spread between groups beyond what chance gives sets the
    strength; no such spread is a strong prior, one group of its own says nothing and gets the same.
    """
    own = F.col("s") / F.col("n")
    row = groups.agg(F.sum(F.col("n") * (own - mean) * (own - mean)), F.sum(F.col("q") - F.col("s") * own), F.sum("n"), F.count("*"),
                     F.sum(F.col("n") * F.col("n"))).first()
    between, within, n, k, squares = (float(x or 0) for x in row)
    if k < 2 or n <= k:
        return 1000.0
    noise = within / (n - k)
    spread = (between - (k - 1) * noise) / max(n - squares / n, 1e-9)
    return float(min(max(noise / spread if spread > 0 else 1000.0, 1.0), 1000.0))


def posteriors(docs: DataFrame, evidence: Evidence, *, doc_id: str = "doc_id", text: str = "text", host: str = "source",
               path: str = "lang", keep: float = 0.5) -> DataFrame:
    """``(doc_id, host, path, evidence, host_posterior, path_posterior, quality, kept)`` of every row.

    Sums of the documents' evidence per path and host are the data of a two-level beta model: a host's mean is drawn
    towards the corpus mean, a path's towards its host's, each by a strength estimated from the spread of the groups; a
    sparse site stays near its prior.  A document is left out of the sums it is judged by.  Its quality adds the
    classifier's log-odds, relative to the corpus, to those of its path.

    Paths that hold more than a 500th of all documents, fewer than 500, are looked up in a broadcast table, the others by
    a join.  Defined results: a null text counts as empty; null host or path is a host or path of its own; repeated rows
    count each; without labels the evidence is constant and quality follows it; an empty table gives an empty table;
    other columns are not carried.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
                       F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), F.col(text).alias("text"))
    known = stored(evidence.probability(rows).select("id", "host", "path", F.col("p").cast("double").alias("p")), "evidence")
    paths = stored(known.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")), "paths")
    hosts = paths.groupBy("host").agg(*[F.sum(c).alias(c) for c in "nsq"])
    total, s = hosts.agg(F.sum("n"), F.sum("s")).first()
    mean = s / total if total else 0.5
    host_strength = _strength(hosts, F.lit(mean))
    joined = paths.join(hosts.select("host", F.col("n").alias("hn"), F.col("s").alias("hs")), "host")
    path_strength = _strength(joined, F.col("hs") / F.col("hn"))
    joined = joined.drop("q")
    often = F.col("n") > max((total or 0) // 500, 1)
    key = F.concat_ws("\x01", "host", "path")
    four = ["n", "s", "hn", "hs"]
    hot = F.broadcast(joined.filter(often).select(key.alias("key"), *[F.col(c).alias(f"h_{c}") for c in four]))
    cold = joined.filter(~often).select(key.alias("k"), *four)
    rows = known.withColumn("key", key).join(hot, "key", "left").withColumn(
        "k", F.when(F.col("h_n").isNull(), F.col("key")).otherwise(F.concat_ws("\x02", F.xxhash64("id", "p"), F.lit("hot"))))
    rows = rows.join(cold, "k", "left").select("id", "host", "path", "p", *[F.coalesce(f"h_{c}", c).alias(c) for c in four])
    of_host = (F.col("hs") - F.col("p") + host_strength * mean) / (F.col("hn") - 1 + host_strength)
    rows = rows.withColumn("host_posterior", of_host).withColumn(
        "path_posterior", (F.col("s") - F.col("p") + path_strength * F.col("host_posterior")) / (F.col("n") - 1 + path_strength))
    odds = _logit(F.col("p")) - _logit(F.lit(evidence.share)) + _logit(F.col("path_posterior"))
    quality = 1 / (1 + F.exp(-odds))
    return rows.select(F.col("id").alias("doc_id"), "host", "path", F.col("p").alias("evidence"), "host_posterior", "path_posterior",
                       quality.alias("quality"), (quality >= keep).alias("kept"))
