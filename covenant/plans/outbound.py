"""Sending: messages as envelopes, and files as chunks, to everyone entitled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covenant.functions.headers import DEFAULT_SHARED_HEADERS
from covenant.functions.rdf import normalise_rdf
from covenant.operators.federation import federate
from covenant.operators.files import (
    DEFAULT_CHUNK_SIZE,
    FETCH,
    check_file_requests,
    chunk_files,
    decode_file_requests,
    rejected_file_requests,
    valid_file_requests,
)
from covenant.operators.joins import keyed_join
from covenant.operators.messages import Payload, to_envelope
from covenant.session import scratch_path, written
from covenant.sources.objects import INLINE_BYTES, read_files, read_large_chunks, stat_files


def outbound_messages(
    messages: DataFrame,
    grants: DataFrame,
    shared: Sequence[str] = DEFAULT_SHARED_HEADERS,
    payload: Payload = normalise_rdf,
) -> DataFrame:
    """Envelopes for every entitled consumer. The payload of a message that anyone gets is shaped and digested once,
    however many get it."""
    return federate(messages, grants, shape=lambda wanted: to_envelope(wanted, shared, payload))


#: Sequence ids are offsets, which are unique within these only.
SEQUENCE = ["topic", "partition"]


def file_chunks(
    valid: DataFrame, listing: DataFrame, chunk_size: int, work: str, *, inline_bytes: int = INLINE_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Chunks of valid requests, and those whose object could not be read as FETCH rejects.

    Objects of any size are read and cut once however many requests name them; what was read is a table below ``work``.
    Every chunk carries topic, partition and sequence id. Contents are never broadcast; an object asked for by very many
    requests is spread over several tasks.
    """
    spread = {"spread": ["file_sequence_id"], "salt": True}
    small = written(read_files(listing, inline_bytes), f"{work}/small")
    large = written(read_large_chunks(listing, chunk_size, inline_bytes=inline_bytes), f"{work}/large")
    broken = (
        small.select("uri", "error").unionByName(large.select("uri", "error")).where("error IS NOT NULL")
        .groupBy("uri").agg(F.min("error").alias("details"))
    )
    rejects = keyed_join(valid.select(*SEQUENCE, "file_sequence_id", "uri"), broken, ["uri"], **spread).select(
        *SEQUENCE, "file_sequence_id", F.lit(FETCH).alias("reason"), "details"
    )
    whole = keyed_join(valid.drop("size"), small.where("error IS NULL").drop("error"), ["uri"], **spread).withColumn(
        "file_name", F.col("path")
    )
    readable = large.join(broken.select("uri"), "uri", "left_anti").drop("error")
    pieces = keyed_join(valid.select(*SEQUENCE, "file_sequence_id", "uri"), readable, ["uri"], **spread).drop("uri")
    return chunk_files(whole, chunk_size, by=SEQUENCE).unionByName(pieces), rejects


def outbound_files(
    messages: DataFrame,
    grants: DataFrame,
    *,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    require_topic_grant: bool = True,
    requests: DataFrame | None = None,
    azure_account: str | None = None,
    work: str | None = None,
    inline_bytes: int = INLINE_BYTES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chunks, deliveries and rejects of file references.

    An object is read and cut once however many consumers get it. ``deliveries`` names the consumers of each file that was
    read, by topic, partition and sequence id; join the chunks to it on all three where they are sent, as offsets repeat
    between topics and partitions. ``work`` is a folder all executors reach; left out, it is a new one below the shared
    folder.
    """
    work = work or scratch_path(messages.sparkSession, "outbound-files")
    allowed = federate(messages, grants, requests=requests, require_topic_grant=require_topic_grant)
    references = allowed.drop("consumer_id").dropDuplicates([*SEQUENCE, "offset"])
    requested = decode_file_requests(references, azure_account)
    listing = written(stat_files(requested), f"{work}/listing")
    checked = check_file_requests(requested, listing)
    valid = valid_file_requests(checked)
    chunks, unread = file_chunks(valid, listing, chunk_size, work, inline_bytes=inline_bytes)
    rejects = written(rejected_file_requests(checked).unionByName(unread), f"{work}/rejects")
    sent = allowed.select("consumer_id", *SEQUENCE, F.col("offset").alias("file_sequence_id"))
    deliveries = sent.join(rejects.select(*SEQUENCE, "file_sequence_id"), [*SEQUENCE, "file_sequence_id"], "left_anti")
    return chunks, deliveries, rejects
