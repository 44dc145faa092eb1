import base64
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from covenant.llm import warc
from covenant.session import scratch_path

SCHEMA = "page_id bigint, url string, html string, payload string, digest string, id string, origin string"


def pages():
    long = "<p>Ünïcode \U0001f600 WARC/1.1\r\nContent-Length: 3\r\n\r\n</p>" * 3000
    rows = [
        (1, "http://a/1", "same"),
        (2, "http://a/2", "same"),
        (3, "http://a/3", None),
        (4, None, ""),
        (5, "http://a/5\r\nX: y", long),
        (6, "http://a/6", long + "!"),
        (7, "http://a/7", long),
        (8, "http://a/8", "0\r\n\r\n"),
        (8, "http://a/9", "0\r\n\r\n"),
        (2, "http://a/2", "same"),
        (7, "http://a/7", long),
        (-4, "http://a/10", "other"),
        (None, "http://a/11", "other"),
    ]
    return [(*r, "p", "d", "i", "o") for r in rows]


def test_round_trip(spark):
    path = scratch_path(spark, "test-archives")
    given = spark.createDataFrame(pages(), SCHEMA).repartition(3)
    warc.write_archives(given, path, segment_chars=10_000, chunk_chars=999)
    records = warc.read_records(spark, path)
    assert records.where("kind = 'continuation'").count() > 10
    found = warc.read_pages(spark, path).collect()
    tops = {}
    for i, url, html, *_ in pages():
        tops[html or ""] = max(tops.get(html or "", (-1e9, "")), (-1e8 if i is None else i, url or ""))
    wanted = Counter()
    for i, url, html, *_ in pages():
        data = (html or "").encode()
        top = tops[html or ""]
        held = top == (-1e8 if i is None else i, url or "")
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        wanted[i, len(data), digest, "response" if held else "revisit", None if held else top[0]] += 1
    named = spark.createDataFrame(found).select(warc.page_of(F.col("id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_of(F.col("refers_to")).alias("refers_to"))
    assert Counter(tuple(r) for r in named.collect()) == wanted
    payloads = Counter(bytes(r.payload).decode() for r in warc.reassemble(records).collect())
    # The origins of these two are repeated rows.
    assert payloads == Counter([*{r[2] or "" for r in pages()}, pages()[4][2], "same"])
    assert warc.reassemble(records).where("problem IS NOT NULL").count() == 0


def test_broken_segments_are_reported(spark):
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n0\r\n\r\n"
    half = len(block) // 2
    rows = [
        ("whole", "response", "whole", 1, None, block[:half]),
        ("x", "continuation", "whole", 2, len(block), block[half:]),
        ("gap", "response", "gap", 1, None, block[:half]),
        ("y", "continuation", "gap", 3, len(block), block[half:]),
        ("short", "response", "short", 1, None, block[:half]),
        ("z", "continuation", "short", 2, len(block) + 1, block[half:]),
        ("open", "response", "open", 1, None, block[:half]),
        ("v", "continuation", "open", 2, None, block[half:]),
        ("w", "continuation", "lost", 2, len(block), block[half:]),
        ("bad", "response", "bad", None, None, block[:-9]),
        ("plain", "response", "plain", None, None, b"HTTP/1.1 200 OK\r\n\r\nabc"),
        ("headless", "response", "headless", None, None, b"abc"),
    ]
    records = spark.createDataFrame(
        [(i, k, o, s, t, "u", None, None, b) for i, k, o, s, t, b in rows],
        "id string, kind string, origin string, segment int, total bigint, uri string, refers_to string, digest string, block binary",
    )
    found = {r.id: (r.payload, r.problem) for r in warc.reassemble(records).collect()}
    assert bytes(found["whole"][0]) == b"abc" == bytes(found["plain"][0])
    for name in ("gap", "short", "open", "lost", "bad", "headless"):
        assert found[name][0] is None and found[name][1], name


def test_parse_and_dechunk():
    import gzip

    record = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-length: 4\r\n\r\nabcd\r\n\r\n"
    for archive in (record * 2, gzip.compress(record) + gzip.compress(record)):
        assert [(h["warc-type"], b) for h, b in warc.parse_records(archive)] == [("resource", b"abcd")] * 2
    with pytest.raises(ValueError):
        list(warc.parse_records(record[:-7]))
    assert warc.dechunk(b"2;x=y\r\nab\r\n1\r\nc\r\n0\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.dechunk(b"5\r\nab\r\n0\r\n\r\n")


def test_empty_table(spark):
    path = scratch_path(spark, "test-archives")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_pages(spark, path).collect() == []
