"""Writers: feature tables, submissions, ranking text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.operators.ranks import first_per


def write_feature_table(df: DataFrame, path: str, by: Sequence[str] = ("split",)) -> None:
    """Parquet, one folder per split, so that a read of one split skips the other's files."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_submission(df: DataFrame, path: str, header: bool = True) -> None:
    """``(sid, recommend_mode)`` with header, or ``(sid, yhat)`` without."""
    name = "recommend_mode" if header else "yhat"
    df.select("sid", F.col("prediction").cast("int").alias(name)).write.mode("overwrite").option(
        "header", str(header).lower()).csv(path)


def qid_lines(rows: DataFrame, features: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``label qid:<sid> 1:<f1> 2:<f2> ...``, features from 1, zeros left out, in sid order.

    A repeated mode keeps its first plan; the label is 1 on the clicked mode.  Range
    partitions sorted inside give files that are sorted as a whole.
    """
    missing = [f for f in features if f not in rows.columns]
    if missing:
        raise ValueError(f"features not in the table: {missing}")
    if not features or features[0] != "transport_mode":
        raise ValueError("the first feature must be transport_mode")
    rows = first_per(rows, ["sid", "transport_mode"], [c for c in order if c != "transport_mode"])
    clicked = F.col("click_mode") if "click_mode" in rows.columns else F.lit(None).cast("int")
    label = F.when(clicked == F.col("transport_mode"), "1").otherwise("0")
    cells = [F.when(F.col(f) != 0, F.concat(F.lit(f"{i}:"), F.col(f).cast("string")))
             for i, f in enumerate(features, start=1)]
    line = F.concat_ws(" ", label, F.concat(F.lit("qid:"), F.col("sid").cast("string")), *cells)
    sort = ["sid", *[c for c in order]]
    ranged = rows.repartitionByRange(partitions, "sid") if partitions else rows.repartitionByRange("sid")
    return ranged.sortWithinPartitions(*sort).select(line.alias("value"))


def write_qid_text(rows: DataFrame, path: str, features: Sequence[str], order: Sequence[str]) -> None:
    qid_lines(rows, features, order).write.mode("overwrite").text(path)


def padded_lists(rows: DataFrame, features: Sequence[str], order: Sequence[str], size: int = 12) -> DataFrame:
    """One list of ``size`` per session: labels (-1 = padding) and one array per feature (0 = padding).

    Modes are unique per session after :func:`first_per`, so a list has at most one entry per mode.
    """
    rows = first_per(rows, ["sid", "transport_mode"], [c for c in order if c != "transport_mode"])
    label = F.when(F.col("click_mode") == F.col("transport_mode"), 1).otherwise(0)
    entry = F.struct(*order, label.alias("_label"), *[F.col(f).alias(f"_{f}") for f in features])
    lists = rows.groupBy("sid").agg(F.array_sort(F.collect_list(entry)).alias("l"))

    def padded(name: str, filler: int):
        return F.slice(F.concat(F.col(f"l.{name}"), F.array_repeat(F.lit(filler), size)), 1, size)

    return lists.select("sid", padded("_label", -1).alias("label"), *[padded(f"_{f}", 0).alias(f) for f in features])
