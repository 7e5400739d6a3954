"""The row-local features on a stream equal those on a batch."""

from __future__ import annotations

from wayfold import bindings as B
from wayfold.streaming.sessions import plan_stream, session_stream


def _through(spark, df, path, make, name):
    df.repartition(3).write.parquet(path)
    stream = make(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path))
    query = stream.writeStream.format("memory").queryName(name).outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    return sorted(map(str, spark.table(name).collect()))


def test_plan_stream(spark, sf_dir, tmp_path):
    plans = B.plans_table(spark, sf_dir)
    got = _through(spark, plans, str(tmp_path / "p"), plan_stream, "plan_rows")
    assert got == sorted(map(str, plan_stream(plans).collect()))


def test_session_stream(spark, sf_dir, tmp_path):
    sides = (B.holidays_table(spark, sf_dir), B.calendar_table(spark, sf_dir), B.districts_table(spark, sf_dir))
    queries = B.queries_table(spark, sf_dir)
    make = lambda df: session_stream(df, *sides)
    got = _through(spark, queries, str(tmp_path / "s"), make, "session_rows")
    assert got == sorted(map(str, make(queries).collect()))
