"""WARC archives: writing with segments and revisits, and reassembly on reading.

A page is an HTTP response with chunked transfer framing. A record whose block is longer than a
segment is written as that many records: the first is the response with segment number 1, the rest
are continuations that name it as their origin, and the last one states the total length. Pages
with a payload that another page has already are revisits that refer to it. Archives are written by
Spark's text writer, a record a row, with the records' closing blank lines as line ends.

Reading parses each archive file by itself, groups segments by their origin, orders them by number,
verifies numbers and total length, joins the blocks and takes the chunk framing off.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.text import utf8
from cohortloom.session import cut, work_path

#: Bytes of a block in one record, of a chunk of a body, and of payloads that may be revisited.
SEGMENT, CHUNK, LEAST = 16_384, 4_096, 100
#: Records of a file at most; with SEGMENT it bounds a file, which one task parses.
RECORDS = 2_000
_END = b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The body in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(x), x) for x in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked framing; chunk extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[line + 2 : line + 2 + size])
        if len(out[-1]) != size or body[line + 2 + size : line + 4 + size] != b"\r\n":
            raise ValueError("a chunk is shorter than its size says")
        at = line + 4 + size


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record without its closing blank lines; fields of None are left out, line breaks in them escaped."""
    lines = [b"WARC/1.1"]
    for name, value in [*fields, ("Content-Length", len(block))]:
        if value is not None:
            plain = str(value).replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
            lines.append(f"{name}: {plain}".encode("utf-8", "replace"))
    return b"\r\n".join(lines) + _END + block


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record of an archive."""
    at = 0
    while at < len(data):
        head = data.index(_END, at)
        lines = data[at:head].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        fields = {k.lower(): v.strip(" \t").replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%") for k, _, v in (x.partition(":") for x in lines[1:])}
        at = head + 4 + int(fields["content-length"])
        block = data[head + 4 : at]
        if data[at : at + 4] != _END:
            raise ValueError(f"a record is cut off at byte {at}")
        at += 4
        yield fields, block


def page_records(page: int | None, url: str | None, payload: bytes, first: int | None, segment: int, chunk: int) -> list[bytes]:
    """The records of one page; `first` is the page that a revisit refers to."""
    digest = hashlib.sha256(payload).hexdigest()
    name = f"<urn:page:{page}:{digest}>"
    fields: list[tuple[str, object]] = [
        ("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", name), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Page-ID", page), ("Content-Type", "application/http; msgtype=response"),
    ]
    if first is not None:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        return [record([*fields, ("WARC-Profile", profile), ("WARC-Refers-To", f"<urn:page:{first}:{digest}>")], _HTTP)]
    block = _HTTP + chunked(payload, chunk)
    if len(block) <= segment:
        return [record(fields, block)]
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    out = [record([*fields, ("WARC-Segment-Number", 1)], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        own: list[tuple[str, object]] = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{n}>"), ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", n)]
        out.append(record([*own, ("WARC-Segment-Total-Length", len(block) if n == len(parts) else None)], part))
    return out


def write(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
    segment: int = SEGMENT, chunk: int = CHUNK, least: int = LEAST, records_per_file: int = RECORDS,
) -> None:
    """Write the archives of `pages` under `path`.

    Of pages with equal payloads of `least` bytes or more, those with the smallest id are responses
    and the others revisits of it; smaller payloads are always responses. A null payload is empty. A
    null id is never the smallest: pages that only share a payload with others without an id are
    responses. Repeated rows give repeated records. Other columns are not read.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.octet_length("payload") >= least)
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    joined = rows.join(cut(firsts), "digest", "left")
    revisit = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    # A revisit needs no payload beyond its digest, but the writer works that out itself: it gets the bytes.
    placed = joined.select("page_id", "url", "payload", revisit.alias("first"))

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = [None if u is None else u.decode("utf-8", "replace") for u in utf8(batch.column(1))]
            out, held = [], 0
            for page in zip(batch.column(0).to_pylist(), urls, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                out += page_records(*page, segment, chunk)
                held += len(page[2])
                if held > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    written = placed.mapInArrow(build, "record BINARY").select(F.col("record").cast("string"))
    written.write.options(lineSep=_END.decode(), compression="gzip", maxRecordsPerFile=records_per_file).text(path)


_FIELDS = {"type": "warc-type", "record_id": "warc-record-id", "uri": "warc-target-uri", "digest": "warc-payload-digest", "page_id": "warc-page-id", "refers_to": "warc-refers-to", "origin": "warc-segment-origin-id", "number": "warc-segment-number", "total": "warc-segment-total-length"}
_NUMBERS = {"page_id", "number", "total"}


def parse(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives under `path`: the columns of _FIELDS and the block."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                raw = data.as_py()
                raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                found = list(records(raw))
                columns = [
                    pa.array([int(f[k]) if n in _NUMBERS and k in f else f.get(k) for f, _ in found], pa.int64() if n in _NUMBERS else pa.string())
                    for n, k in _FIELDS.items()
                ]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([b for _, b in found], pa.binary())], [*_FIELDS, "block"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    kinds = ", ".join(f"{n} {'BIGINT' if n in _NUMBERS else 'STRING'}" for n in _FIELDS)
    return files.mapInArrow(read, f"{kinds}, block BINARY")


def reassemble(parsed: DataFrame) -> DataFrame:
    """Responses and revisits with all their blocks in order: the columns of `parse` but for segments, blocks, complete.

    complete: the segments are 1, 2, ... with none missing, and their lengths add up to the total.
    A record that is repeated segment by segment comes out as often as its first segment is there.
    """
    keep = ["type", "record_id", "uri", "digest", "page_id", "refers_to"]
    whole = parsed.filter("number IS NULL").select(*keep, F.array("block").alias("blocks"), F.lit(True).alias("complete"))
    parts = parsed.filter("number IS NOT NULL").withColumn("of", F.coalesce("origin", "record_id"))
    # Copies of a segment become one row with a count before the segments of a record meet.
    once = parts.groupBy("of", "number").agg(
        *[F.first(c).alias(c) for c in ("type", "uri", "digest", "page_id", "total", "block")], F.count("*").alias("copies")
    )
    head = F.col("number") == 1
    of = F.array_sort(F.collect_list(F.struct("number", "block")))
    joined = once.groupBy("of").agg(
        *[F.max(F.when(head, F.col(c))).alias(c) for c in ("type", "uri", "digest", "page_id", "copies")], F.max("total").alias("total"), of.alias("parts")
    )
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + F.octet_length(p["block"]))
    ordered = F.transform("parts", lambda p: p["number"]) == F.sequence(F.lit(1).cast("long"), F.size("parts").cast("long"))
    complete = F.coalesce(ordered & (length == F.col("total")), F.lit(False))
    segmented = joined.select(
        "type", F.col("of").alias("record_id"), "uri", "digest", "page_id", F.lit(None).cast("string").alias("refers_to"),
        F.transform("parts", lambda p: p["block"]).alias("blocks"), complete.alias("complete"), F.explode(F.sequence(F.lit(1), F.coalesce("copies", F.lit(1)).cast("int"))).alias("copy"),
    )
    return whole.unionByName(segmented.drop("copy"))


def decode(rows: DataFrame, with_payload: bool = True) -> DataFrame:
    """Rows of `reassemble` with payload, payload_bytes and payload_digest, the latter of the decoded bytes.

    All three are null for revisits, which have no payload of their own, and for incomplete records.
    """
    keep = [c for c in rows.columns if c != "blocks"]

    def take_off(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, whole = batch.column(keep.index("type")).to_pylist(), batch.column(keep.index("complete")).to_pylist()
            payloads: list[bytes | None] = []
            for i, (kind, ok) in enumerate(zip(kinds, whole, strict=True)):
                if kind != "response" or not ok:
                    payloads.append(None)
                    continue
                head, _, body = b"".join(batch.column(len(keep))[i].as_py()).partition(_END)
                payloads.append(unchunked(body) if b"\r\ntransfer-encoding: chunked" in head.lower() else body)
            sizes = pa.array([None if p is None else len(p) for p in payloads], pa.int64())
            sums = pa.array([None if p is None else hashlib.sha256(p).hexdigest() for p in payloads], pa.string())
            extra = [pa.array(payloads, pa.binary())] if with_payload else []
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], sizes, sums, *extra], [*keep, "payload_bytes", "payload_digest", *["payload"][: len(extra)]])

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    more = ", payload BINARY" if with_payload else ""
    return rows.select(*keep, "blocks").mapInArrow(take_off, f"{kinds}, payload_bytes BIGINT, payload_digest STRING{more}")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """(page_id, uri, record_type, refers_to, payload_bytes, payload_digest, verified) from archives of `pages` read back.

    refers_to: the page that a revisit's record refers to. verified: the digest of the decoded bytes, or
    of the record referred to, is the one in the record's own header.
    """
    spark = pages.sparkSession
    path = work_path(spark, "warc")
    write(pages, path, **options)
    found = cut(decode(reassemble(parse(spark, path)), with_payload=False))
    responses = found.filter("type = 'response'")
    named = responses.select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("first"), F.col("payload_bytes").alias("first_bytes"), F.col("payload_digest").alias("first_digest"))
    joined = found.join(named.distinct(), "refers_to", "left")
    digest: Column = F.coalesce("payload_digest", "first_digest")
    return joined.select(
        "page_id", "uri", F.col("type").alias("record_type"), F.col("first").alias("refers_to"), F.coalesce("payload_bytes", "first_bytes").alias("payload_bytes"),
        digest.alias("payload_digest"), F.coalesce(F.concat(F.lit("sha256:"), digest) == F.col("digest"), F.lit(False)).alias("verified"),
    )
