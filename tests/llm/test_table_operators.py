"""Vectors and pages: exact results on odd rows, and archives that hold what they should."""

from __future__ import annotations

import gzip
import hashlib
import math
import os

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from wayfold.llm import topk, warc


def _floor(x):
    return int(x) * 1024 if abs(x) > 2**60 else math.floor(x * 1024)


def _best(rows, k=10):
    ok = [(i, [_floor(float(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in ok if i % 100 == 0}:
        found = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in ok if j != i and len(v) == len(q))[:k]
        out += [(i, r + 1, j, -s if -(2**63) <= -s < 2**63 else None) for r, (s, j) in enumerate(found)]
    return sorted(out, key=str)


def test_top_k(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(0, 0.3, (40, 24)).astype(float)
    rows = [(i, base[i % 40].tolist()) for i in range(330)]  # every vector many times: ties
    rows += [(100, base[3].tolist()), (None, base[1].tolist()), (700, None), (701, []), (702, [None] * 24), (703, [math.nan] * 24),
             (704, [math.inf] * 24), (800, [1e30] * 24), (801, [1e6 + 0.25] * 24), (802, [-1e6] * 24), (1100, [1e6 - 0.125] * 24), (900, [0.5, 0.25]), (901, [1.0, 1.0]), (1000, [2.0])]
    vectors = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, key string, g int").repartition(4)
    got = sorted(map(tuple, topk.top_k(vectors, F.col("vec_id") % 100 == 0).collect()), key=str)
    assert got == _best(rows)
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_top_k_over_several_groups(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 2)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = sorted(map(tuple, topk.top_k(vectors, F.col("vec_id") % 100 == 0).collect()), key=str)
    assert got == _best([(r.vec_id, r.embedding) for r in vectors.collect()])


def test_top_k_of_components_up_to_a_million(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(0, 1, 8) * 10 ** rng.integers(0, 7)).tolist()) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(map(tuple, topk.top_k(vectors, F.col("vec_id") % 100 == 0).collect()), key=str)
    assert got == _best(rows) and all(r[3] is not None for r in got)


def test_bounds_are_above_the_product():
    rng = np.random.default_rng(2)
    a, b = (np.floor(rng.normal(0, 300, (50, 37))) for _ in "ab")
    for s in topk.LEVELS:
        assert (topk._features(a, s) @ topk._features(b, s).T >= a @ b.T - 1e-6).all()


def _pages():
    long, other = "<p>" + prose(1, 40) + "\r\n\r\nWARC/1.0</p>", "é" * 60
    return [(5, "http://a/x y", long), (2, "http://b\r\nX: 1", long), (9, None, long), (1, "u", None), (3, "u", ""), (4, "u", "tiny"), (6, "u", "tiny"),
            (7, "u", other), (8, "u", other), (None, "u", long), (2, "again", long), (10, "u", "x" * 300_000)]


def _archived(rows):
    least = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            least[h] = min(i, least.get(h, i))
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        first = least.get(h)
        revisit = first is not None and first != i
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return out


def test_archives(spark):
    rows = _pages()
    pages = spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, size int")
    read = warc.archive_pages(pages).collect()
    some = lambda rows: sorted(map(str, rows))
    assert some((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read) == some(_archived(rows))
    assert some((r.page_id, r.payload) for r in read if r.record_type == "response") == some(
        (i, h or "") for (i, _, h), a in zip(rows, _archived(rows), strict=True) if a[3] == "response")
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_members_and_index(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://a/{i}", prose(i, 30)) for i in range(25)], "page_id long, url string, html string").coalesce(1)
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")
    warc.write_archives(warc.plan_records(pages).coalesce(1), raw, records=10)
    done = warc.normalise(raw, target, spark).collect()
    assert sorted(r.records for r in done) == [5, 10, 10]
    streams = {f.split(".")[0]: gzip.open(os.path.join(raw, f)).read() for f in os.listdir(raw) if f.endswith(".gz")}
    for r in done:
        whole = open(os.path.join(target, r.archive), "rb").read()
        assert gzip.decompress(whole) == streams[r.archive.split(".")[0]]
        places = [tuple(map(int, line.split())) for line in open(os.path.join(target, f"{r.archive}.idx"))]
        assert [a for a, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        for a, n in places:
            record = gzip.decompress(whole[a:a + n])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")


def test_archives_are_read_in_pieces():
    class Slow:
        def __init__(self, data):
            self.data, self.at = data, 0

        def read(self, n):
            part = self.data[self.at:self.at + min(n, 7)]
            self.at += len(part)
            return part
    records = [f"WARC/1.1\r\nX: {i}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
               for i, body in enumerate([b"", b"a\r\n\r\nb", b"z" * 100_000, b"Content-Length: 9\r\n\r\n"])]
    one = gzip.compress(b"".join(records))
    many = b"".join(gzip.compress(r) for r in records)
    for stream in (one, many):
        parts = list(warc.inflated(Slow(stream), 50))
        assert max(map(len, parts)) <= 200
        assert list(warc.split_records(parts)) == records
    assert list(warc.split_records(warc.inflated(Slow(gzip.compress(b"")), 50))) == []


def test_ranges_cover_the_index():
    index = np.array([(0, 10), (10, 5), (15, 100), (115, 1), (116, 1), (117, 1)])
    assert list(warc.ranges(index, 20)) == [(0, 2), (2, 3), (3, 6)]
    assert list(warc.ranges(index, 1, 2)) == [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (5, 6)] and list(warc.ranges(index, 1000, 4)) == [(0, 4), (4, 6)]
    assert list(warc.ranges(np.zeros((0, 2), int))) == []
