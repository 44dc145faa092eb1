"""WARC archives: written as text records, read back with segment reassembly and chunked transfer decoding.

A response record holds an HTTP response whose body is framed in chunks; blocks longer than a segment are continued in
further records. Continuations are grouped by the record they stem from, ordered by segment number, and checked against
the total length; the body is then taken out of its chunks. Records with the payload of another one are revisits.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covenant.session import scratch_path, written

#: Characters of a block that go into one record, and of a payload that go into one chunk.
SEGMENT_CHARS = 32_768
CHUNK_CHARS = 8_192
DATE = "2026-01-01T00:00:00Z"

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Digits of base 32 as the platform writes them, and as RFC 4648 does.
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    digest = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def _pieces(text: Column, chars: int) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chars}}}"), F.lit(0))


def _chunked(payload: Column, chars: int) -> Column:
    framed = F.transform(
        _pieces(payload, chars), lambda c: F.concat(F.lower(F.hex(F.octet_length(c))), F.lit("\r\n"), c, F.lit("\r\n"))
    )
    return F.concat(F.array_join(framed, ""), F.lit("0\r\n\r\n"))


def _record(kind: Column, record_id: Column, fields: list[Column], block: Column) -> Column:
    """A record without the two line breaks that follow it. Null fields are left out."""
    lines = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.lit(f"WARC-Date: {DATE}"),
        *fields,
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(lines, F.lit("\r\n\r\n"), block)


def record_id(page_id: str, url: str, digest: str) -> Column:
    """Names a page by its id, address and payload; equal rows are the same record, written once for each of them."""
    return F.concat(
        F.lit("<urn:page:"), F.coalesce(F.col(page_id).cast("string"), F.lit("none")), F.lit(":"), F.col(digest), F.lit(":"), F.hex(F.xxhash64(url)), F.lit(">")
    )


def with_origins(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, id, origin): ``origin`` is the id of the record that holds the payload: of equal
    payloads the largest page_id, then the largest url; nulls count as smallest."""
    spark = pages.sparkSession
    named = (
        pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload"))
        .withColumn("digest", sha1_base32(F.col("payload")))
        .withColumn("id", record_id("page_id", "url", "digest"))
    )
    # Written, so that a payload that many pages share can be split when it meets its origin.
    origins = written(
        named.groupBy("digest").agg(F.max(F.struct("page_id", "url", "id")).alias("origin")).select("digest", F.col("origin.id").alias("origin")),
        scratch_path(spark, "origins"),
    )
    return named.join(origins, "digest")


def write_archives(pages: DataFrame, path: str, segment_chars: int = SEGMENT_CHARS, chunk_chars: int = CHUNK_CHARS) -> None:
    """One record per row of ``pages`` (page_id, url, html; null html is empty, other columns are ignored) in gzipped
    archives below ``path``, and continuations where a block is longer than a segment."""
    named = with_origins(pages)
    uri = F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"))
    kind = F.lit("Content-Type: application/http;msgtype=response")
    revisits = named.where("id <> origin").select(
        _record(
            F.lit("revisit"),
            F.col("id"),
            [uri, digest, F.concat(F.lit("WARC-Refers-To: "), F.col("origin")), F.lit(f"WARC-Profile: {_PROFILE}"), kind],
            F.lit(_HTTP + "\r\n"),
        ).alias("value")
    )
    block = F.concat(F.lit(_HTTP + "Transfer-Encoding: chunked\r\n\r\n"), _chunked(F.col("payload"), chunk_chars))
    segments = (
        named.where("id = origin")
        .withColumn("block", block)
        .select("id", "url", "digest", F.octet_length("block").alias("total"), F.posexplode(_pieces(F.col("block"), segment_chars)).alias("at", "part"), F.ceil(F.char_length("block") / segment_chars).alias("n"))
        .withColumn("number", F.col("at") + 1)
    )
    first = F.col("number") == 1
    responses = segments.select(
        _record(
            F.when(first, "response").otherwise("continuation"),
            F.when(first, F.col("id")).otherwise(F.concat(F.lit("<urn:segment:"), F.col("number").cast("string"), F.lit(":"), F.substring("id", 2, 1 << 20))),
            [
                uri,
                F.when(first, digest),
                F.when(F.col("n") > 1, F.concat(F.lit("WARC-Segment-Number: "), F.col("number").cast("string"))),
                F.when(~first, F.concat(F.lit("WARC-Segment-Origin-ID: "), F.col("id"))),
                F.when((F.col("n") > 1) & (F.col("number") == F.col("n")), F.concat(F.lit("WARC-Segment-Total-Length: "), F.col("total").cast("string"))),
                F.when(first, kind),
            ],
            F.col("part"),
        ).alias("value")
    )
    responses.union(revisits).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive, gzipped (in one or many members) or not."""
    if content[:2] == b"\x1f\x8b":
        plain = []
        while content:
            member = zlib.decompressobj(31)
            plain.append(member.decompress(content))
            content = member.unused_data
        content = b"".join(plain)
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        lines = content[at:end].decode().split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        start, length = end + 4, int(headers["content-length"])
        block = content[start : start + length]
        if len(block) != length:
            raise ValueError(f"the record at byte {at} is cut off")
        yield headers, block
        at = start + length
        while content[at : at + 2] == b"\r\n":
            at += 2


def dechunk(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size
        if len(out[-1]) != size or body[at : at + 2] != b"\r\n":
            raise ValueError("a chunk is cut off")
        at += 2


_RECORD = "id string, kind string, origin string, segment int, total bigint, uri string, refers_to string, digest string, block binary"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "kind", "origin", "segment", "total", "uri", "refers_to", "digest", "block"]
    types = [pa.string()] * 3 + [pa.int32(), pa.int64()] + [pa.string()] * 3 + [pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    for batch in batches:
        for content in batch.column("content"):
            rows, size = [], 0
            for headers, block in parse_records(content.as_py()):
                h = headers.get
                rows.append((h("warc-record-id"), h("warc-type"), h("warc-segment-origin-id", h("warc-record-id")), number(h("warc-segment-number")), number(h("warc-segment-total-length")), h("warc-target-uri"), h("warc-refers-to"), h("warc-payload-digest"), block))
                size += len(block)
                if size > 4 << 20:
                    yield batch_of(rows)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path`` as they stand in the archives. A task reads whole archives, one record at a time."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_parse, _RECORD)


def _payload(parts: list[dict]) -> tuple[bytes | None, str | None]:
    """Payload of the segments of a record, or what is wrong with them."""
    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
        return None, "segments are missing or conflict"
    if len(parts) > 1 and parts[-1]["total"] is None:
        return None, "the last segment is missing"
    block = b"".join(p["block"] for p in parts)
    if len(parts) > 1 and parts[-1]["total"] != len(block):
        return None, "the total length differs"
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        return None, "the HTTP head has no end"
    fields = [line.lower().replace(b" ", b"") for line in head.split(b"\r\n")[1:]]
    if b"transfer-encoding:chunked" not in fields:
        return body, None
    try:
        return dechunk(body), None
    except ValueError:
        return None, "the chunks are broken"


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads, digests, problems = [], [], []
        for i in range(batch.num_rows):
            payload, problem = _payload(batch.column("parts")[i].as_py())
            digest = None if payload is None else base64.b32encode(hashlib.sha1(payload).digest()).decode()
            declared = batch.column("digest")[i].as_py()
            if problem is None and declared is not None and declared != f"sha1:{digest}":
                problem = "the payload digest differs"
            payloads.append(payload)
            digests.append(digest)
            problems.append(problem)
        kept = ["id", "uri", "copies"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in kept], pa.array(payloads, pa.binary()), pa.array(digests, pa.string()), pa.array(problems, pa.string())],
            names=[*kept, "payload", "payload_digest", "problem"],
        )


def reassemble(records: DataFrame) -> DataFrame:
    """Responses of ``records``: (id, uri, payload, payload_digest, problem), one row per record that starts a response.

    Segments are put together by the record they stem from; equal copies of a segment count once, and give as many rows as
    there are copies of the first one. ``problem`` says what does not fit; the payload is then null. Only segmented records
    are shuffled. A response whose first segment is missing gives one row under its origin's id.
    """
    part = F.struct(F.coalesce("segment", F.lit(1)).alias("segment"), "total", "block")
    shape = ["id", "uri", "digest", "copies", "parts"]
    single = records.where("kind = 'response' AND segment IS NULL").select(
        "id", "uri", "digest", F.lit(1).cast("bigint").alias("copies"), F.array(part).alias("parts")
    )
    joined = (
        records.where("segment IS NOT NULL AND kind IN ('response', 'continuation')")
        .groupBy("origin")
        .agg(
            F.max("uri").alias("uri"),
            F.max("digest").alias("digest"),
            F.greatest(F.sum((F.col("segment") == 1).cast("bigint")), F.lit(1)).alias("copies"),
            F.sort_array(F.collect_set(part)).alias("parts"),
        )
        .withColumnRenamed("origin", "id")
    )
    decoded = single.select(*shape).union(joined.select(*shape)).mapInArrow(
        _decode, "id string, uri string, copies bigint, payload binary, payload_digest string, problem string"
    )
    return decoded.select(
        "id", "uri", "payload", "payload_digest", "problem", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    ).drop("copy")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of archives written by :func:`write_archives`: (id, payload_bytes, payload_digest, record_type, refers_to).
    Revisits have the length and digest of the record they refer to."""
    records = read_records(spark, path)
    responses = written(
        reassemble(records).select("id", F.length("payload").cast("bigint").alias("payload_bytes"), "payload_digest", "problem"),
        scratch_path(spark, "responses"),
    )
    revisits = records.where("kind = 'revisit'").select("id", "refers_to")
    held = responses.where("problem IS NULL").select(F.col("id").alias("refers_to"), "payload_bytes", "payload_digest").distinct()
    held = written(held, scratch_path(spark, "held"))
    return responses.select(
        "id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("string").alias("refers_to")
    ).union(
        revisits.join(held, "refers_to", "left").select(
            "id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to"
        )
    )


def page_of(record: Column) -> Column:
    """The page_id in the id of a record; null if it had none."""
    return F.regexp_extract(record, r"^<urn:page:(-?\d+|none):", 1).try_cast("bigint")
