"""Connected components of an undirected edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm.frames import stored


def components(edges: DataFrame) -> DataFrame:
    """``(id, label)`` for every linked id but the labels themselves; the label is the smallest id reachable.

    ``edges`` has ``a`` and ``b``.  Alternates large and small stars (every node hands its larger neighbours, then its
    smaller ones, to the smallest it knows) until nothing changes, which takes about the logarithm of the longest
    chain.  Each round is a table in the shared folder; the driver sees its count and whether it holds a new row.
    """
    known = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    size = known.count()
    while size:
        both = known.union(known.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, known = known, stored(small.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "edges")
        was, size = size, known.count()
        # both hold distinct rows: as many, and none that was not there, means the same table
        if was == size and known.join(before, ["u", "v"], "left_anti").isEmpty():
            break
    return known.select(F.col("u").alias("id"), F.col("v").alias("label"))
