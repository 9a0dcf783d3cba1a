"""WARC archives of captured pages, with repeated payloads as revisit records.

1. Narrow headers (id, target, payload digest and length) are made where the
   pages lie.  They are shuffled by payload digest; the capture with the
   largest id becomes the response of its digest (an aggregation with map-side
   combine, so a payload that a third of all pages share is no hot task), and
   the other headers are joined to it as revisits.  Payload equality is SHA-256
   equality; the SHA-1 that WARC files carry is only printed.
2. Pages are written as WARC/1.1 records with fresh headers by Spark's own text
   writer: its line separator is the CRLF CRLF that ends a record.  So files
   appear by Spark's commit protocol, in any store that Spark reaches, and a
   lost executor leaves no half archive.  Each file is one gzip stream.
3. Reading streams each file record by record by Content-Length, whatever the
   payload holds, and checks each response against its digest.

Defined results: null html is an empty payload; a null id is written as an
empty one and read back as null; of rows that repeat one id and payload, all
are written as what that id is; a payload under ``min_bytes`` is always a
response; a null or odd target is percent-encoded or replaced by the record's
id; an empty table gives an empty archive folder and no records.
"""

from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import io
import string
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, sized, slices, utf8

RECORDS_A_FILE = 5000
PREFIX = "urn:page:"
# fixed values: names of the WARC 1.1 standard
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _digest() -> Column:
    return F.unhex(F.sha2(F.coalesce("html", F.lit("")), 256))


def revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, digest, refers_to, refers_uri) of the captures whose payload another capture holds."""
    heads = cut(pages.select(
        "page_id", "url", F.octet_length(F.coalesce("html", F.lit(""))).alias("bytes"), _digest().alias("digest")).where(F.col("bytes") >= min_bytes))
    originals = (heads.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("page_id", "url")).alias("first")).where("n > 1")
                 .select("digest", F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_uri")))
    return cut(heads.join(originals, "digest").where(F.coalesce(F.col("page_id") != F.col("refers_to"), F.col("refers_to").isNotNull()))
               .select("page_id", "digest", "refers_to", "refers_uri").distinct())


def _uri(url: str | None, page_id) -> str:
    return quote(url, safe=string.punctuation) if url and url.strip() else f"{PREFIX}{page_id}"


def record(page_id, url: str | None, html: str | None, date: str, refers_to=None, refers_uri: str | None = None, revisit: bool = False) -> str:
    """One record without the CRLF CRLF that ends it."""
    html = html or ""
    payload = utf8(html)
    name = "" if page_id is None else page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}{END}"
    lines = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{PREFIX}{name}>", f"WARC-Date: {date}",
             f"WARC-Target-URI: {_uri(url, name)}", f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{PREFIX}{refers_to}>", f"WARC-Refers-To-Target-URI: {_uri(refers_uri, refers_to)}"]
    length = len(http) + (0 if revisit else len(payload))
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    return "\r\n".join(lines) + END + http + ("" if revisit else html)


def _records(date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = zip(*(c.to_pylist() for c in batch.columns))
            out = pa.array([record(i, u, h, date, to, uri, bool(is_revisit)) for i, u, h, to, uri, is_revisit in rows], pa.string())
            yield pa.RecordBatch.from_arrays([out], names=["value"])
    return run


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str | None = None) -> None:
    """Write ``pages`` (page_id, url, html) as deduplicated archives into the new folder ``path``."""
    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    again = sized(revisits(pages, min_bytes).select(
        F.col("page_id").alias("of_page"), F.col("digest").alias("of_digest"), "refers_to", "refers_uri", F.lit(True).alias("is_revisit")))
    joined = (pages.select("page_id", "url", "html", _digest().alias("own"))
              .join(again, F.col("page_id").eqNullSafe(F.col("of_page")) & (F.col("own") == F.col("of_digest")), "left")
              .select("page_id", "url", "html", "refers_to", "refers_uri", "is_revisit"))
    (joined.mapInArrow(_records(date), "value string").write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_A_FILE).text(path))


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an uncompressed WARC stream."""
    while (version := stream.readline()):
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {version[:80]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if len(block) < int(headers["content-length"]):
            raise ValueError(f"cut off in {headers['warc-record-id']}")
        yield headers, block


def _name(uri: str | None) -> str | None:
    return uri.strip("<>").removeprefix(PREFIX) or None if uri else None


_SCHEMA = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.string())])


def _parsed(payloads: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer())))
                rows = []
                for head, block in read_records(stream):
                    http, _, payload = block.partition(END.encode())
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    if head["warc-type"] == "response":
                        size = len(payload)
                        if payload_digest(payload) != digest:
                            raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
                    else:
                        size = int(http.rpartition(b"Content-Length:")[2])
                    rows.append((_name(head["warc-record-id"]), head["warc-target-uri"], size, digest, head["warc-type"], _name(head.get("warc-refers-to")),
                                 payload.decode("utf-8", "surrogatepass") if payloads else None))
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
    return run


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint", payloads: bool = True) -> DataFrame:
    """A row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload] (empty for a revisit)."""
    found = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
             .mapInArrow(_parsed(payloads), "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, "
                                            "refers_to string, payload string"))
    found = found.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))
    return found if payloads else found.drop("payload")
