"""Shapes of the physical plans."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
# queries that fit models or hold other eager jobs are checked on the frame they return all the same
LAZY = sorted(n for n in QUERIES if not n.startswith(("clf_", "clu_", "cv_cl", "stack_f", "rank_", "hyper", "final", "predict", "op", "pipeline")))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python_rows(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "InArrow"):
        assert node not in plan, node


@pytest.mark.parametrize("name", ["plan_stats", "plan_arg_modes", "mode_flags", "wide_last_wins", "mode_document", "coords_split",
                                  "time_features", "nearest_district", "geo_cells", "split_random"])
def test_row_features_need_no_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, sf_dir))


def test_session_table_scans_each_input_once(spark, sf_dir):
    plan = plan_of(QUERIES["features_col"](spark, sf_dir))
    # sessions, lists and clicks all come from orders here, one scan each
    assert plan.count("orders.parquet") == 3 and plan.count("customer.parquet") == 1


def test_scan_reads_only_the_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["join_plans_left"](spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int,l_quantity:double>" in plan


def test_split_read_skips_the_other_files(spark, sf_dir):
    assert "PartitionFilters: [isnotnull(split" in plan_of(QUERIES["sink_feature_table"](spark, sf_dir))
