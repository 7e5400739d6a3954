"""Seeded row digests: the same row gets the same number in every run and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 60


def digest60(*columns: Column | str, seed: int = 0) -> Column:
    """60-bit digest of the columns' texts and the seed, taken from MD5."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    text = F.concat_ws("|", *[p.cast("string") for p in parts], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def digest60_sql(*columns: str, seed: int = 0) -> str:
    """The same number as an SQL text, for the oracle."""
    parts = ", ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return f"CAST('0x' || substr(md5(concat_ws('|', {parts}, '{seed}')), 1, 15) AS BIGINT)"
