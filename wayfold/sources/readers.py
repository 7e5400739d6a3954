"""Readers of the trip-log files, all with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfold import schemas as S
from wayfold.operators.setops import union_rows

# File names of the raw tables.
TRAIN_FILES = {"profiles": "profiles.csv", "queries": "train_queries.csv", "plans": "train_plans.csv",
               "clicks": "train_clicks.csv"}
TEST_FILES = {"queries": "test_queries.csv", "plans": "test_plans.csv"}
_SCHEMAS = {"profiles": S.PROFILES, "queries": S.QUERIES, "plans": S.PLANS, "clicks": S.CLICKS}
_CSV = {"header": "true", "quote": '"', "escape": '"', "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).options(**_CSV).csv(path)


def read_tables(spark: SparkSession, folder: str, files: dict[str, str] = TRAIN_FILES) -> dict[str, DataFrame]:
    return {name: read_csv(spark, f"{folder}/{file}", _SCHEMAS[name]) for name, file in files.items()}


def parse_calendar(texts: DataFrame, column: str = "value") -> DataFrame:
    """Weather object ``{"MM-dd": {...}}`` to one row per day."""
    days = F.explode(F.from_json(F.col(column), S.CALENDAR)).alias("md", "day")
    return texts.select(days).select("md", "day.*")


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """The weather file is one small JSON object (a year of days), read as a whole text."""
    return parse_calendar(spark.read.text(path, wholetext=True))


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """Every cell of the holiday matrix that is an ``MM-dd`` date, once each."""
    cells = spark.read.text(path).select(F.explode(F.split("value", ",")).alias("cell"))
    return cells.select(F.trim("cell").alias("md")).where(F.col("md").rlike(r"^\d{2}-\d{2}$")).distinct()


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, S.STATIONS).withColumns(
        {"o_lat": F.round("o_lat", 2), "o_long": F.round("o_long", 2)})


def read_districts(spark: SparkSession, path: str, most: int = 256) -> DataFrame:
    """District centres with their place in the file as ``idx``; a short reference list in one file."""
    rows = read_csv(spark, path, S.DISTRICTS).select("*", F.col("_metadata.file_path").alias("file")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{path} lists more than {most} districts")
    if len({r["file"] for r in rows}) > 1:
        raise ValueError(f"{path} holds several files; their order is not defined")
    return spark.createDataFrame([(i, *r[:-1]) for i, r in enumerate(rows)],
                                 "idx int, District string, o_lat double, o_long double")


def read_matching(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """Every run file whose name contains ``key``, stacked by column name; absent columns are null.

    Run files may differ in their columns: files with the same header line are read in one scan.  Names come from the
    listing, without reading contents; the header lines of all files from one job over their first blocks.
    """
    listed = spark.read.format("binaryFile").load(f"{folder}/*{key}*").select("path", "length")
    names = sorted(r["path"] for r in listed.collect() if r["length"])
    if not names:
        raise ValueError(f"no file in {folder} matches {key!r}")
    lines = spark.read.text(names).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                                          F.monotonically_increasing_id().alias("line"), "value").where("start = 0 AND trim(value) <> ''")
    headers: dict[str, list[str]] = {}
    for r in lines.groupBy("path").agg(F.min_by("value", "line").alias("header")).orderBy("path").collect():
        headers.setdefault(r["header"].lstrip("\ufeff"), []).append(r["path"])
    return union_rows(*[spark.read.option("header", "true").csv(files) for files in headers.values()], fill=True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
