"""Mode documents to TF-IDF weights.

The vocabulary is made of twelve mode words, ``word_null`` and their pairs, at most 182 terms;
its document frequencies are collected under that bound.  Everything else stays in the row.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_TERMS = 10_000


def terms_of(words: Column) -> Column:
    """Words and pairs of neighbouring words."""
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)),
                       lambda a, b: F.when(b.isNotNull(), F.concat(a, F.lit(" "), b)))
    return F.concat(words, F.filter(pairs, lambda p: p.isNotNull()))


def fit_idf(docs: DataFrame, terms: str = "terms", most: int = MOST_TERMS) -> dict[str, float]:
    """Smoothed inverse document frequency ``ln((1 + n) / (1 + df)) + 1`` per term, by term."""
    counts = (docs.select(F.explode_outer(F.array_distinct(F.concat(terms, F.array(F.lit(None).cast("string"))))).alias("t"))
              .groupBy("t").agg(F.count(F.lit(1)).alias("df")).limit(most + 2).collect())
    if len(counts) > most + 1:
        raise ValueError(f"more than {most} terms")
    # the null term occurs in every document, so its count is the number of documents
    n = next((r["df"] for r in counts if r["t"] is None), 0)
    return {r["t"]: math.log((1 + n) / (1 + r["df"])) + 1 for r in sorted(
        (r for r in counts if r["t"] is not None), key=lambda r: r["t"])}


def weigh(docs: DataFrame, idf: dict[str, float], terms: str = "terms", name: str = "weights") -> DataFrame:
    """Array of (term, weight), unit length per document, terms in order: the vectors of :func:`weight_vectors`, spelled out."""
    words = F.array(*[F.lit(t) for t in idf]) if idf else F.array().cast("array<string>")
    pairs = F.zip_with(words, vector_to_array("_vector"), lambda t, w: F.struct(t.alias("term"), w.alias("weight")))
    return weight_vectors(docs, idf, terms, "_vector").withColumn(name, F.filter(pairs, lambda e: e["weight"] > 0)).drop("_vector")


def weight_rows(docs: DataFrame, key: str, weights: str = "weights") -> DataFrame:
    """One row per document and term; every document has at least one term.

    The outer form of ``inline`` stops Catalyst from deriving a size filter, which would
    evaluate the whole weighing a second time below the projection.
    """
    return docs.select(key, F.inline_outer(weights))


def weight_vectors(docs: DataFrame, idf: dict[str, float], terms: str = "terms", name: str = "vector") -> DataFrame:
    """The same weights as sparse ML vectors over the vocabulary."""
    counts = CountVectorizerModel.from_vocabulary(list(idf), inputCol=terms, outputCol="_tf").transform(docs)
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(list(idf.values())), inputCol="_tf", outputCol="_w").transform(counts)
    return Normalizer(p=2.0, inputCol="_w", outputCol=name).transform(scaled).drop("_tf", "_w")
