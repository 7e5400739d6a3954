"""WARC archives of pages: whole-file gzip out of Spark's writer, a normaliser to one member a record, and a reader."""

from __future__ import annotations

import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.session import scratch_path

SMALLEST = 100
#: Records of an archive; bytes that are read or inflated at a time.
RECORDS, READ = 4096, 1 << 20
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", smallest: int = SMALLEST) -> DataFrame:
    """``(page_id, url, payload, size, digest, first)``; ``first`` is the page that a revisit refers to, else null.

    Payloads that more than a 500th of all pages share, fewer than 500, are looked up in a broadcast table, so that
    their pages do not gather in one task.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"),
                        F.octet_length(payload).cast("long").alias("size"), F.sha2(payload, 256).alias("digest"))
    groups = rows.filter(F.col("size") >= smallest).groupBy("digest").agg(
        F.min("page_id").alias("head"), F.count("*").alias("n")).filter("n > 1")
    often = F.col("n") > max(rows.count() // 500, 1)
    hot = F.broadcast(groups.filter(often).select("digest", F.col("head").alias("hot")))
    rows = rows.join(hot, "digest", "left").withColumn(
        "k", F.when(F.col("hot").isNull(), F.col("digest")).otherwise(F.xxhash64("page_id").cast("string")))
    rows = rows.join(groups.filter(~often).select(F.col("digest").alias("k"), "head"), "k", "left")
    head = F.coalesce("hot", "head")
    return rows.select("page_id", "url", "payload", "size", "digest", F.when(~head.eqNullSafe(F.col("page_id")), head).alias("first"))


def record_text(date: str = DATE) -> Column:
    """The WARC record of a planned page without the two line ends that close it."""
    revisit = F.col("first").isNotNull()
    end = F.lit("\r\n")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), end, end)
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    # line ends and blanks would break the header
    target = F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20"), end))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"), end,
        F.lit("WARC-Record-ID: "), name("page_id"), end, F.lit(f"WARC-Date: {date}\r\n"), F.coalesce(target, F.lit("")),
        F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"), end,
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name("first"), F.lit(f"\r\nWARC-Profile: {REVISIT}\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), end, end, block)


def write_archives(planned: DataFrame, path: str, *, records: int = RECORDS) -> None:
    """Archives of at most ``records`` records below ``path``, each compressed as one gzip stream."""
    planned.select(record_text().alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", records).text(path)


def inflated(source, size: int = READ) -> Iterator[bytes]:
    """A gzip stream of any number of members, some ``size`` bytes at a time on either side."""
    press = zlib.decompressobj(31)
    while data := source.read(size):
        while data:
            if press.eof:
                press = zlib.decompressobj(31)
            yield press.decompress(data, 4 * size)
            data = press.unused_data if press.eof else press.unconsumed_tail
    yield press.flush()


_LENGTH = re.compile(rb"\r\nContent-Length: *(\d+)", re.IGNORECASE)


def split_records(parts: Iterable[bytes]) -> Iterator[bytes]:
    """The records of an archive, each with its closing line ends; no more than one and a part is held."""
    held, seen, stop = bytearray(), 0, 0
    for part in parts:
        held += part
        while True:
            if not stop:
                head = held.find(b"\r\n\r\n", seen)
                if head < 0:
                    seen = max(0, len(held) - 3)
                    break
                stop = head + 8 + int(_LENGTH.search(held, 0, head + 4).group(1))
            if len(held) < stop:
                break
            yield bytes(held[:stop])
            del held[:stop]
            seen = stop = 0
    if held:
        raise ValueError("an archive ends inside a record")


def normalise(path: str, target: str, spark, *, level: int = 6) -> DataFrame:
    """Rewrite each archive below ``path`` to ``target`` with one gzip member a record and a sidecar index of offsets.

    Each whole-file stream is inflated once, piece by piece, so a task holds one record whatever an archive holds.  The
    sidecar has a line ``offset length`` for each record, in order.  Files are written aside and moved into place, so a
    task that runs again leaves whole files.  The result lists ``(archive, records)``; nothing is written before it is run.
    """
    def rewrite(batches):
        store, folder = fs.FileSystem.from_uri(target)
        origin, place = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        for batch in batches:
            for name in map(posixpath.basename, batch["path"].to_pylist()):
                archive = f"{name.split('.')[0]}.warc.gz"
                aside = posixpath.join(folder, f"_{uuid.uuid4().hex}")
                at = records = 0
                with (origin.open_input_stream(posixpath.join(place, name), compression=None) as source,
                      store.open_output_stream(f"{aside}.gz", compression=None) as out,
                      store.open_output_stream(f"{aside}.idx", compression=None) as index):
                    for record in split_records(inflated(source)):
                        press = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = press.compress(record) + press.flush()
                        out.write(member)
                        index.write(f"{at} {len(member)}\n".encode())
                        at += len(member)
                        records += 1
                store.move(f"{aside}.idx", posixpath.join(folder, f"{archive}.idx"))
                store.move(f"{aside}.gz", posixpath.join(folder, archive))
                yield pa.record_batch([pa.array([archive]), pa.array([records], pa.int64())], names=["archive", "records"])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path")
    return files.mapInArrow(rewrite, "archive string, records long")


def read_archives(spark, target: str) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to)`` of every record, by the indexes.

    The index says where to read: neighbouring records of some :data:`READ` bytes at a time, each inflated alone.  The
    digest of a response is that of the payload read; one that differs from its header is an error.  A revisit has no
    payload; size and digest are those it states.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def parse(batches):
        store, folder = fs.FileSystem.from_uri(target)
        for batch in batches:
            for name in map(posixpath.basename, batch["path"].to_pylist()):
                with store.open_input_stream(posixpath.join(folder, f"{name}.idx"), compression=None) as f:
                    index = np.array(f.read().split(), np.int64).reshape(-1, 2)
                with store.open_input_file(posixpath.join(folder, name)) as archive:
                    for low, high in ranges(index):
                        first = int(index[low, 0])
                        content = archive.read_at(int(index[high - 1].sum()) - first, first)
                        rows = [_parse(zlib.decompress(content[a - first:a - first + n], 31)) for a, n in index[low:high].tolist()]
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(target).select("path")
    return files.mapInArrow(parse, "page_id long, url string, payload string, payload_bytes long, payload_digest string, "
                                   "record_type string, refers_to long")


def ranges(index: np.ndarray, size: int = READ, most: int = 512) -> Iterator[tuple[int, int]]:
    """Runs of index lines ``(offset, length)`` that are read together: up to ``size`` bytes and ``most`` records, at least one."""
    low = 0
    while low < len(index):
        high = int(np.searchsorted(index.sum(1), index[low, 0] + size, "right"))
        high = min(max(high, low + 1), low + most, len(index))
        yield low, high
        low = high


def _parse(record: bytes) -> dict:
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    page = lambda v: None if v is None or v == "<urn:page:none>" else int(v[len("<urn:page:"):-1])
    http, _, body = block[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size, stated = int(_LENGTH.search(http).group(1)), fields["WARC-Payload-Digest"].removeprefix("sha256:")
    whole = fields["WARC-Type"] == "response"
    if whole and (len(body) != size or hashlib.sha256(body).hexdigest() != stated):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {"page_id": page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload": body.decode() if whole else None,
            "payload_bytes": size, "payload_digest": stated, "record_type": fields["WARC-Type"],
            "refers_to": page(fields.get("WARC-Refers-To"))}


def archive_pages(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", smallest: int = SMALLEST) -> DataFrame:
    """Write the pages, normalise the archives and read them back; see :func:`read_archives` for the columns.

    Of equal payloads of at least ``smallest`` bytes the page with the smallest id is stored, the others are revisits of it.

    Defined results: null html is an empty payload; null ids are stored and come back null; rows that repeat the first
    page's id are stored as well; an empty table gives an empty table; other columns are not archived.
    """
    spark = pages.sparkSession
    raw, target = scratch_path(spark, "warc-streams"), scratch_path(spark, "warc")
    write_archives(plan_records(pages, page_id=page_id, url=url, html=html, smallest=smallest), raw)
    normalise(raw, target, spark).agg(F.sum("records")).collect()
    return read_archives(spark, target)
