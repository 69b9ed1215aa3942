"""WARC framing, segments and damaged archives."""

import random

import pytest

from cohortloom.llm import warc
from tests.llm import edges


def test_chunked_framing():
    rng = random.Random(1)
    for n in (0, 1, 4095, 4096, 4097, 100_000):
        data = rng.randbytes(n)
        assert warc.unchunked(warc.chunked(data, rng.randrange(1, 5000))) == data
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_records_with_blank_lines_and_breaks_in_fields():
    block = b"\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    data = warc.record([("WARC-Type", "response"), ("WARC-Target-URI", "a\r\nb%0D")], block) + b"\r\n\r\n"
    assert [(f["warc-target-uri"], b) for f, b in warc.records(data * 2)] == [("a\r\nb%0D", block)] * 2
    with pytest.raises(ValueError):
        list(warc.records(data[:-1]))


def test_payloads_come_back_whole(spark, tmp_path):
    pages = spark.read.parquet(edges.write(tmp_path) + "/pages.parquet")
    path = str(tmp_path / "warc")
    warc.write(pages, path, segment=500, chunk=64, records_per_file=50)
    rows = warc.decode(warc.reassemble(warc.parse(spark, path))).collect()
    assert all(r["complete"] for r in rows)
    got = sorted(((str(r["page_id"]), str(r["uri"]), r["payload"].decode()) for r in rows if r["type"] == "response"))
    source = [(r["page_id"], r["url"], r["html"] or "") for r in pages.collect()]
    first = {}
    for p, _, h in source:
        if p is not None:
            first[h] = min(p, first.get(h, p))
    assert got == sorted((str(p), str(u), h) for p, u, h in source if len(h.encode()) < 100 or first.get(h, p) == p)


def test_missing_segment_is_told(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 5000), (2, "u", "y" * 300)], "page_id BIGINT, url STRING, html STRING")
    path = str(tmp_path / "warc")
    warc.write(pages, path, segment=1000)
    parsed = warc.parse(spark, path)
    rows = warc.decode(warc.reassemble(parsed.filter("number IS NULL OR number != 3"))).collect()
    assert {r["page_id"]: (r["complete"], r["payload_bytes"]) for r in rows} == {1: (False, None), 2: (True, 300)}
