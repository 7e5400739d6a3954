"""Summaries of model runs as key/value rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_rows(runs: DataFrame, run: str, metrics: Sequence[str], params: str = "parameters",
             features: str = "features") -> DataFrame:
    """One row per metric, parameter (from a JSON object) and feature (from "a - b - c") of each run."""
    entry = lambda kind, key, value: F.struct(
        F.lit(kind).alias("kind"), key.cast("string").alias("key"), value.cast("string").alias("value"))
    of_metrics = F.array(*[entry("metric", F.lit(m), F.col(m)) for m in metrics])
    of_params = F.transform(F.map_entries(F.coalesce(
        F.from_json(params, "map<string,string>"), F.create_map().cast("map<string,string>"))),
        lambda e: entry("param", e["key"], e["value"]))
    of_features = F.transform(F.split(features, " - "), lambda f, i: entry("feature", i, f))
    return runs.select(run, F.inline(F.concat(of_metrics, of_params, of_features)))
