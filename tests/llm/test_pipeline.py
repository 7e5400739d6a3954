"""The pipeline's stages against plain Python, and the registered queries against their SQL."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.parity import compare, duck
from wayfold.llm import queries
from wayfold.llm.frames import without

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, sf_dir, name):
    assert compare(spark, duck(sf_dir), queries.QUERIES[name], queries.ORACLES[name], sf_dir) is None


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """Every stage's input and output over the edge rows beside the given documents."""
    from tests.llm.conftest import edge_texts

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS)
    edge = spark.createDataFrame([(None if i is None else 10_000 + i, t, "en", "s", len(t or "")) for i, t in edge_texts()],
                                 docs.schema)
    frame, out = docs.union(edge), []
    for name, stage in corpus_pipeline.STAGES:
        done = corpus_pipeline.stored(stage(spark, frame, sf_dir), f"test-{name}")
        out.append((frame.collect(), done.collect(), done.columns))
        frame = done
    return out


def test_stage_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "substring_dedup", "secret_scan", "best_fit_packing"]
    assert all(columns == COLUMNS for _, _, columns in steps[:-1])


def test_language_stage_keeps_what_has_letters(steps):
    before, after, _ = steps[0]
    assert sorted(map(str, after)) == sorted(str(r) for r in before if r.text and re.search(r"[^\W\d_]", r.text))


def test_near_duplicate_stage(steps):
    before, after, _ = steps[1]
    label = brute.components([(r.doc_id, r.text) for r in before], 5, 80)
    assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted({i for i, c in label.items() if i == c})
    assert sum(r.doc_id is None for r in after) == sum(r.doc_id is None for r in before)


def test_substring_stage(steps):
    before, after, _ = steps[2]
    want = {i: (n, gone, kept) for i, n, gone, kept in brute.without_repeats([(r.doc_id, r.text) for r in before])}
    texts = {r.doc_id: r.text for r in before}
    assert {r.doc_id for r in after} == {i for i, (n, gone, _) in want.items() if not gone or gone < n}
    for r in after:
        assert brute.words(r.text) == brute.words(want[r.doc_id][2])
        assert want[r.doc_id][1] or r.text == texts[r.doc_id]
        assert r.n_chars == len(r.text) or not want[r.doc_id][1]


def test_secret_stage(steps):
    before, after, _ = steps[3]
    texts = {r.doc_id: r.text for r in before}
    assert sorted(map(str, (r.doc_id for r in after))) == sorted(map(str, texts))
    for r in after:
        assert not brute.base_spans(r.text)
        assert corpus_pipeline.MASK in r.text or r.text == texts[r.doc_id]


def test_packing_stage(steps):
    before, after, _ = steps[4]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    by = {}
    for r in after:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 2048


def test_run_over_a_folder(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_empty_stages(spark, no_docs, sf_dir):
    frame = no_docs.select(COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        frame = corpus_pipeline.stored(stage(spark, frame, sf_dir), f"empty-{name}")
        assert frame.count() == 0


def test_columns_named_as_outputs_stay(spark, sf_dir):
    extra = ["lang_pred", "score", "n_words", "n_removed", "kept_text", "spans", "base", "n_hex", "row", "id", "letter", "chunk", "component_id", "_set"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS)
    frame = docs.select("*", *[F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")).alias(c) for c in extra])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.stored(stage(spark, frame, sf_dir), f"clash-{name}")
        assert frame.columns == [*COLUMNS, *extra]
        assert frame.count() > 0
        assert all(r[c] == f"{c} of {r.doc_id}" for r in frame.collect() for c in extra)


def test_rows_without_ids_in_a_list(spark):
    rows = spark.createDataFrame([(i if i % 50 else None, f"t{i}") for i in range(1000)], "doc_id long, text string")
    gone = spark.createDataFrame([(i,) for i in range(0, 1200, 3)], "doc_id long")
    want = sorted(f"t{i}" for i in range(1000) if i % 50 == 0 or i % 3)
    for bits in (24, 7):  # the second bitmap is all set
        assert sorted(r.text for r in without(rows, gone, "doc_id", bits).collect()) == want
    assert without(rows, gone.limit(0), "doc_id").count() == 1000
