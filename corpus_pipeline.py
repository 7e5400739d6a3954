"""Cleaning pipeline for training text: each stage works on what the one before it kept."""

from __future__ import annotations

import posixpath
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold.llm import langid, secrets
from wayfold.llm.frames import stored, without
from wayfold.llm.jaccard import components_by_jaccard
from wayfold.llm.packing import pack_documents
from wayfold.llm.substrings import remove_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
MASK = "[SECRET]"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told (no text or no letter in it) go.

    The network learns from the labelled documents of this stage's input, without the held-out quarter of their ids.
    """
    known = docs.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    found = langid.identify(_apart(docs), langid.train(known))
    return _together(found.filter(F.col("lang_pred") != langid.UNKNOWN), docs, changed=False)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles, that with the smallest id stays.

    Rows that share an id are one document, of which one row stays; rows without an id stay.
    """
    found = stored(components_by_jaccard(docs, width=5, percent=80), "components")
    gone = found.filter("component_id <> doc_id").select("doc_id").distinct()
    kept = without(docs, gone, "doc_id")
    if found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").isEmpty():
        return kept
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = kept.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min_by(row, F.sha2(F.coalesce("text", F.lit("")), 256)).alias("row"))
    return one.select("row.*").union(kept.filter("doc_id IS NULL"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more that start in an earlier document go; a document that loses all its words goes too."""
    done = remove_repeats(_apart(docs), spacing="original").filter("n_removed = 0 OR n_removed < n_words")
    return _together(done.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))), docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text is masked; no document goes."""
    return _together(secrets.find_secrets(_apart(docs), secrets.train(docs), mask=MASK), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens."""
    return pack_documents(docs, str(public_tokenizers.path("byte_bpe_50k.json")))


def _apart(docs: DataFrame) -> DataFrame:
    """Id and text for an operator, all else in one struct, so that no column can clash with what the operator returns."""
    others = [F.col(f"`{c}`").alias(c) for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", F.struct(*others).alias("_carried"))


def _together(done: DataFrame, docs: DataFrame, changed: bool = True) -> DataFrame:
    """The columns of ``docs`` again, with the text as it is now and, if it may have changed, its length."""
    now = {"text": F.col("text")} | ({"n_chars": F.length("text").cast("long")} if changed else {})
    return done.select(*[now.get(c, F.col("_carried").getField(c)).alias(c) for c in docs.columns])


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id), ("near_duplicates", near_duplicates), ("substring_dedup", substring_dedup),
    ("secret_scan", secret_scan), ("best_fit_packing", best_fit_packing),
]
#: Networks and token ids are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(posixpath.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
