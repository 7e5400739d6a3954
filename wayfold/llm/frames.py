"""Frame helpers shared by the operators: carrying foreign columns, scratch tables, chunks of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.session import scratch_path

CHUNK_BYTES = 2 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, text: str, **parts: Column) -> DataFrame:
    """``parts`` and ``text`` beside one struct ``row`` of the other input columns, so that no foreign name can clash."""
    names = [f.name for f in df.schema.fields if f.name.lower() != text.lower()]
    row = F.struct(*[F.col(f"`{n}`").alias(n) for n in names])
    return df.select(*[c.alias(k) for k, c in parts.items()], F.col(text).alias("text"), row.alias("row"))


def unpacked(df: DataFrame, *outputs: str, text: str | None = "text") -> DataFrame:
    """The carried columns, the text under its name (None: without it), then the operator's ``outputs``.

    A carried column with an output's name is replaced.
    """
    taken = {n.lower() for n in outputs}
    kept = [F.col("row").getField(f.name).alias(f.name) for f in df.schema["row"].dataType.fields if f.name.lower() not in taken]
    return df.select(*kept, *([F.col("text").alias(text)] if text else []), *outputs)


def without(rows: DataFrame, ids: DataFrame, key: str, bits: int = 24) -> DataFrame:
    """``rows`` whose ``key`` is not among ``ids``, without shuffling those that cannot be.

    The ids set bits of a bitmap of ``2 ** bits`` places, which is at most ``2 ** (bits - 6)`` rows and so may be broadcast
    whatever the number of ids.  A row whose bit is not set stays where it is; the others are compared by a join.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    at = [F.shiftright(place, 6).cast("int").alias("_word"), place.bitwiseAND(F.lit(63)).cast("int").alias("_bit")]
    words = ids.select(*at).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_set"))
    whole = F.struct(*[F.col(f"`{c}`").alias(c) for c in rows.columns]).alias("row")
    marked = rows.select(F.col(key).alias("_key"), *at, whole).join(F.broadcast(words), "_word", "left")
    may = F.coalesce(F.expr("shiftright(_set, _bit) & 1L") == 1, F.lit(False))
    compared = marked.filter(may).join(ids.select(F.col(key).alias("_key")), "_key", "left_anti")
    return marked.filter(~may).select("row.*").union(compared.select("row.*"))


def text_bytes(df: DataFrame, text: str) -> int:
    return df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def chunk_count(total_bytes: int, chunk_bytes: int = CHUNK_BYTES) -> int:
    """Number of document chunks, each of about ``chunk_bytes`` of text."""
    return max(1, -(-total_bytes // chunk_bytes))


def chunk_of(key: Column, chunks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int")
