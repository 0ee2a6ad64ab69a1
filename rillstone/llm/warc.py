"""WARC archives: written from pages, read back, and assembled into captures.

Each page is a transaction of three records: a request and a metadata record
that name, as concurrent-to, the response or revisit record. Of pages with
equal payloads, the one with the largest page_id is the response and the
others revisit it. Archives are written by Spark's text sink, whose line
separator is the two line ends that close a record; so they lie wherever
Spark can write, gzip-compressed, and hold a bounded number of bytes: pages
are written by size class, of larger ones fewer to an archive. Reading
inflates an archive piece by piece for a parser that goes by Content-Length.
Records of a transaction are then joined through their concurrent-to
identifiers into one nested row per capture, and revisits meet the capture
that they refer to through WARC-Refers-To.

A null html is an empty payload, a null url an empty target. A null page_id
gives a capture without one: it is a response if no page with an id has its
payload, and is never referred to by id. Repeated rows with the largest
page_id of their payload are all responses, and each gives a capture. Rows of
one page_id with different payloads are captures of their own. A table without
pages gives archives without records. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, materialize, new_path, null_text

END = b"\r\n\r\n"
#: Payloads of fewer bytes are always responses.
LEAST_BYTES = 0
#: Payload bytes of an archive, at most, but that one payload may be larger; pages of up to SMALL bytes are one class, then classes quadruple.
ARCHIVE_BYTES, SMALL = 128 << 20, 64 << 10
#: Compressed bytes that are inflated at once.
PIECE = 1 << 16
#: Every record bears this date: archives of equal pages are equal.
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(*parts: object) -> str:
    x = hashlib.sha1("\0".join(map(str, parts)).encode()).hexdigest()
    return f"<urn:uuid:{x[:8]}-{x[8:12]}-5{x[13:16]}-8{x[17:20]}-{x[20:32]}>"


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the two line ends that close it."""
    lines = [("WARC-Type", kind), ("WARC-Date", DATE), *headers, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in lines) + "\r\n"
    return head.encode() + block


def transaction(page_id: object, url: str, payload: bytes, response_id: object) -> Iterator[bytes]:
    """Request, response or revisit, and metadata of a page; response_id is the page that it revisits, or its own."""
    digest = base32_sha1(payload)
    own = _urn("capture", page_id, digest)
    target = ("WARC-Target-URI", url)
    yield record("request", [("WARC-Record-ID", _urn("request", page_id, digest)), ("WARC-Concurrent-To", own), target, ("Content-Type", "application/http;msgtype=request")], b"GET / HTTP/1.1\r\n\r\n")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    shared = [("WARC-Record-ID", own), target, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if response_id == page_id:
        yield record("response", shared, http + payload)
    else:
        yield record("revisit", [*shared, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _urn("capture", response_id, digest))], http)
    fields = f"page-id: {page_id}\r\n" if page_id is not None else ""
    yield record("metadata", [("WARC-Record-ID", _urn("metadata", page_id, digest)), ("WARC-Concurrent-To", own), target, ("Content-Type", "application/warc-fields")], fields.encode())


def _headers(data: bytes) -> dict[str, str]:
    out = {}
    for line in data.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _inflated(data: bytes) -> Iterator[bytes]:
    """The bytes of a file in pieces; those of one member after another if it is compressed."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    view, at, gz = memoryview(data), 0, zlib.decompressobj(31)
    while at < len(data):
        piece = view[at : at + PIECE]
        at += len(piece)
        while len(piece):
            yield gz.decompress(piece)
            piece = gz.unused_data
            if gz.eof:
                gz = zlib.decompressobj(31)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive, compressed or not; it holds about a record at a time."""
    pieces, held = _inflated(data), bytearray()

    def more() -> bool:
        for piece in pieces:
            held.extend(piece)
            return True
        return False

    while True:
        while (start := held.find(b"WARC/")) < 0:
            del held[: max(0, len(held) - 4)]
            if not more():
                return
        seen = start
        while (end := held.find(END, seen)) < 0:
            seen = max(start, len(held) - len(END) + 1)
            if not more():
                return
        headers = _headers(bytes(held[start:end]))
        first = end + len(END)
        last = first + int(headers["content-length"])
        while len(held) < last and more():
            pass
        yield headers, bytes(held[first:last])
        del held[:last]


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write a transaction for each page below path, a folder for each size class that occurs.

    Payloads that occur once need no join partner, so only digests of several
    pages are joined; adaptive execution splits the partition of one that a
    third of all pages share, as the other side has it once.
    """
    spark = pages.sparkSession
    arrow_rows(spark, 200)
    html = null_text(F.col("html"))
    rows = pages.select("page_id", null_text(F.col("url")).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    several = rows.where(F.octet_length("html") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("response_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = rows.join(several, "digest", "left").select("page_id", "url", "html", F.coalesce("response_id", "page_id").alias("response_id"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, url, text, response = (batch.column(i).to_pylist() for i in range(4))
            records = [r for p, u, t, o in zip(page, url, text, response, strict=True) for r in transaction(p, u, t.encode(), o)]
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["value"])

    largest = pages.agg(F.max(F.octet_length("html"))).first()[0] or 0
    bounds, low = [], 0
    for k in range(max(0, math.ceil(math.log(max(largest, 1) / SMALL, 4))) + 1):
        bounds.append((low, SMALL << 2 * k))
        low = SMALL << 2 * k
    size = F.octet_length("html")
    for low, high in bounds:
        own = joined if len(bounds) == 1 else joined.where((size <= high) if not low else (size > low) & (size <= high))
        writer = own.mapInArrow(write, "value binary").select(F.col("value").cast("string"))
        writer.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", 3 * max(1, ARCHIVE_BYTES // high)).text(f"{path}/up-to-{high}")


FIELDS = "type string, record_id string, concurrent_to string, target_uri string, payload_digest string, payload_bytes long, refers_to string, page_id {page}"


def read_records(spark: SparkSession, path: str, page_type: str = "bigint") -> DataFrame:
    """A row for each record of the archives below path; digests and sizes of responses are computed from what was read."""
    page = pa.string() if page_type == "string" else pa.int64()
    kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), page]
    schema = FIELDS.format(page=page_type)
    names = [f.split()[0] for f in schema.split(", ")]
    convert = str if page_type == "string" else int

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for h, block in parse(content.as_py()):
                    kind, digest, size, own = h["warc-type"], None, None, None
                    if kind == "response":
                        payload = block[block.index(END) + len(END) :]
                        digest, size = base32_sha1(payload), len(payload)
                    elif kind == "revisit":
                        digest, size = h["warc-payload-digest"].removeprefix("sha1:"), int(_headers(block)["content-length"])
                    elif kind == "metadata":
                        fields = _headers(b"\r\n" + block)
                        own = convert(fields["page-id"]) if "page-id" in fields else None
                    rows.append((kind, h.get("warc-record-id"), h.get("warc-concurrent-to"), h.get("warc-target-uri"), digest, size, h.get("warc-refers-to"), own))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    arrow_rows(spark, 1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path).select("content")
    return files.mapInArrow(read, schema)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, request, response (or revisit) and metadata.

    The three records of a transaction meet by the identifier that two of
    them name and the third bears. Requests or metadata without a response
    give a row with a null response.
    """
    key = F.coalesce("concurrent_to", "record_id").alias("capture_id")
    of = lambda kind, *names: F.first(F.when(F.col("type") == kind, F.struct(*names)), ignorenulls=True)
    exchange = F.struct("record_id", "type", "target_uri", "payload_digest", "payload_bytes", "refers_to")
    met = records.groupBy(key).agg(
        of("request", "record_id", "target_uri").alias("request"),
        F.collect_list(F.when(F.col("type").isin("response", "revisit"), exchange)).alias("exchanges"),
        of("metadata", "record_id", "page_id").alias("metadata"),
    )
    return met.select("capture_id", "request", F.explode_outer("exchanges").alias("response"), "metadata")


def with_referred(met: DataFrame) -> DataFrame:
    """The captures with refers_to: the page_id of the capture that a revisit refers to.

    The captures that are referred to are one row each; adaptive execution
    splits the partition of one that a third of all pages revisit.
    """
    targets = met.where("response.type = 'response'").groupBy(F.col("capture_id").alias("__target")).agg(F.max("metadata.page_id").alias("refers_to"))
    revisits = met.where("response.type = 'revisit'")
    others = met.where("response.type is null or response.type <> 'revisit'").withColumn("refers_to", F.lit(None).cast(targets.schema["refers_to"].dataType))
    return revisits.join(targets, F.col("response.refers_to") == F.col("__target"), "left").drop("__target").unionByName(others)


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each page, from archives written and read back."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType.simpleString()
    met = materialize(captures(read_records(spark, path, kind)), "captures")
    return with_referred(met).select(
        F.col("metadata.page_id").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        "refers_to",
        F.col("response.target_uri").alias("url"),
    )
