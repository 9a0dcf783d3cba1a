import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from webfold.llm.common import shared_folder
from webfold.llm.warc import read_archives, write_archives

TRICKY = "body\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [(1, "http://a.example/", "same"), (2, "http://b.example/ü x\r\nX: y", "same"), (9, None, "same"), (3, "u", TRICKY), (4, "u", TRICKY), (5, "u", None),
         (6, "u", ""), (7, "u", "ünï 🙂 &amp;"), (8, "", "x" * 300_000), (8, "", "x" * 300_000), (None, "n", "no id"), (None, "n", "same")]


def pages(spark, data=PAGES):
    return spark.createDataFrame(data, "page_id bigint, url string, html string").withColumn("digest", F.lit("x")).withColumn("n", F.lit(1)).repartition(3)


def brute(data, min_bytes=0):
    out = []
    for i, _, h in data:
        payload = (h or "").encode()
        last = max((j for j, _, g in data if (g or "") == (h or "") and j is not None), default=None)
        again = len(payload) >= min_bytes and last is not None and i != last
        out.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if again else "response", last if again else None,
                    "" if again else h or ""))
    return sorted(out, key=repr)


def test_round_trip(spark):
    for min_bytes in (0, 100):
        path = shared_folder(spark, "warc-test")
        write_archives(pages(spark), path, min_bytes=min_bytes)
        got = read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(PAGES, min_bytes)


def test_round_trip_of_a_table(spark, tmp_path):
    pages(spark).write.parquet(f"{tmp_path}/pages.parquet")
    path = shared_folder(spark, "warc-test")
    write_archives(spark.read.parquet(f"{tmp_path}/pages.parquet"), path)
    got = read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(PAGES)


def test_archive_is_plain_warc(spark):
    path = shared_folder(spark, "warc-test")
    write_archives(pages(spark).coalesce(1), path, date="2024-01-02T03:04:05Z")
    files = [os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-")]
    data = b"".join(gzip.open(f).read() for f in files)
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n")
    assert data.count(b"WARC-Date: 2024-01-02T03:04:05Z") == len(PAGES)
    assert data.count(b"same") == 1  # the payload of four captures is stored once
    assert b"WARC-Target-URI: http://b.example/%C3%BC%20x%0D%0AX:%20y\r\n" in data


def test_a_damaged_archive_is_noticed(spark):
    path = shared_folder(spark, "warc-test")
    write_archives(pages(spark, PAGES[:1]).coalesce(1), path)
    file = next(os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-"))
    data = gzip.open(file).read().replace(b"same", b"sane")
    with gzip.open(file, "wb") as f:
        f.write(data)
    crc = os.path.join(path, "." + os.path.basename(file) + ".crc")
    if os.path.exists(crc):
        os.remove(crc)
    with pytest.raises(Exception, match="does not match its digest"):
        read_archives(spark, path).collect()


def test_empty_table(spark):
    path = shared_folder(spark, "warc-test")
    write_archives(pages(spark, []), path)
    assert read_archives(spark, path).count() == 0
