"""Envelopes around messages: shaping, verification, reporting, dead letters and offsets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covenant.functions.checksums import (
    ABORT,
    ABSENT,
    ALGORITHM,
    FAIL,
    MATCH_SKIPPED,
    PASS,
    SKIP,
    checksum_status,
    match_label,
    mismatch_action,
    payload_checksum,
)
from covenant.functions.exchange import exchange_metadata
from covenant.functions.headers import DEAD_LETTER_REASON, DEFAULT_SHARED_HEADERS, add_header, select_headers
from covenant.functions.naming import destination_metadata
from covenant.functions.rdf import normalise_rdf
from covenant.functions.text import is_blank

Payload = Callable[[Column, Column], Column]


class ChecksumMismatch(Exception):
    """Raised before anything is written when mismatches must stop the run."""


def default_key(key: Column, offset: Column, topic: Column) -> Column:
    """The key, or a stand-in naming the record."""
    # Fixed value: wording of the stand-in key.
    stand_in = F.concat(F.lit("Missing Key - "), offset.cast("string"), F.lit(" "), topic)
    return F.coalesce(key, F.encode(stand_in, "UTF-8"))


def keep_payload(value: Column, headers: Column) -> Column:
    return value


def to_envelope(
    messages: DataFrame,
    shared: Sequence[str] = DEFAULT_SHARED_HEADERS,
    payload: Payload = normalise_rdf,
) -> DataFrame:
    """Outbound form: shared headers only, a key always, the payload handler applied and digested afterwards.

    ``payload`` is any function of the value and the (unreduced) headers. Columns the envelope does not define are
    kept.
    """
    shaped = messages.withColumn("value", payload(F.col("value"), F.col("headers")))
    return (
        shaped.withColumn("key", default_key(F.col("key"), F.col("offset"), F.col("topic")))
        .withColumn("headers", select_headers(F.col("headers"), shared))
        .withColumn("payload_checksum", payload_checksum(F.col("value")))
        .withColumn("checksum_algorithm", F.lit(ALGORITHM))
    )


def with_checksum_status(envelopes: DataFrame) -> DataFrame:
    return envelopes.withColumn("actual_checksum", payload_checksum(F.col("value"))).withColumn(
        "checksum_status", checksum_status(F.col("payload_checksum"), F.col("actual_checksum"))
    )


def verify_checksum(envelopes: DataFrame, on_mismatch: str | None = SKIP) -> DataFrame:
    """Envelopes to deliver. SKIP drops mismatches, LOG_ONLY keeps them, ABORT fails the job.

    ABORT is a filter, so it runs whichever columns are used. An aborting job commits no output; in a stream use
    :func:`abort_on_mismatch` before the first write.
    """
    checked = with_checksum_status(envelopes)
    action = mismatch_action(on_mismatch)
    if action == SKIP:
        return checked.where(F.col("checksum_status") != FAIL)
    if action == ABORT:
        message = F.concat(
            F.lit("checksum mismatch on topic "), F.col("topic"), F.lit(" offset "), F.col("offset").cast("string")
        )
        return checked.where(
            F.when(F.col("checksum_status") == FAIL, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
        )
    return checked


def abort_on_mismatch(checked: DataFrame) -> None:
    """Raise when any envelope fails; reads until the first one."""
    first = checked.where(F.col("checksum_status") == FAIL).select("topic", "offset").take(1)
    if first:
        raise ChecksumMismatch(f"checksum mismatch on topic {first[0]['topic']} offset {first[0]['offset']}")


def next_offsets(consumed: DataFrame, keys: Sequence[str] = ("client", "server", "topic", "partition")) -> DataFrame:
    """Where to read next: past the last delivered or skipped record of each key; nothing for no records."""
    return consumed.groupBy(*keys).agg((F.max("offset") + 1).alias("next_offset"))


def dead_letters(rejected: DataFrame, reason: str = "reason") -> DataFrame:
    """Rejected records with the reason as their last header."""
    return rejected.withColumn("headers", add_header(F.col("headers"), DEAD_LETTER_REASON, F.col(reason)))


def checksum_report(
    checked: DataFrame, on_mismatch: str | None, server: Column, size: Column | None = None
) -> DataFrame:
    """One typed row per verified message. A mismatch is reported as the error it raises.

    ``size`` is the payload size where the payload itself is no longer at hand.
    """
    action = mismatch_action(on_mismatch)
    failed = F.col("checksum_status") == FAIL
    error = F.when(
        failed,
        F.concat(
            F.lit("checksum mismatch on topic "), F.col("topic"), F.lit(" offset "), F.col("offset").cast("string")
        ),
    )
    size = F.octet_length("value").cast("bigint") if size is None else size
    dropped = failed & F.lit(action in (SKIP, ABORT))
    named = checked.withColumn("__names", exchange_metadata(F.col("headers"), server))
    return named.select(
        F.lit("STREAM").alias("pattern"),
        F.col("__names.org_name").alias("org_name"),
        F.col("__names.schema_type").alias("schema_name"),
        F.col("__names.product_type").alias("product_name"),
        "topic",
        "offset",
        F.when(is_blank(F.col("payload_checksum")), "none").otherwise(ALGORITHM).alias("algorithm"),
        size.alias("input_bytes"),
        F.when(dropped, F.lit(0)).otherwise(size).cast("bigint").alias("output_bytes"),
        F.col("payload_checksum").alias("expected_checksum"),
        "actual_checksum",
        match_label(F.col("payload_checksum"), F.col("actual_checksum"), error).alias("match"),
        error.alias("exception"),
        "checksum_status",
    )


def file_report(verified: DataFrame, destination: Column, producer: Column, provider: str = "LOCAL") -> DataFrame:
    """One typed row per reassembled file, named after its destination."""
    names = destination_metadata(destination)
    mismatch = F.col("checksum_status") == FAIL
    error = F.when(
        mismatch, F.concat(F.lit("checksum mismatch for file "), F.col("file_name"))
    )
    return verified.withColumn("__names", names).select(
        F.lit("FILE").alias("pattern"),
        F.coalesce(F.col("__names.org"), producer).alias("org_name"),
        F.col("__names.schema").alias("schema_name"),
        F.col("__names.product").alias("product_name"),
        "file_name",
        "file_sequence_id",
        "total_chunks",
        F.lit(ALGORITHM).alias("algorithm"),
        F.col("file_size").alias("input_bytes"),
        F.when(mismatch, F.lit(0)).otherwise(F.col("file_size")).cast("bigint").alias("output_bytes"),
        F.lit(provider).alias("storage_provider"),
        F.col("file_checksum").alias("expected_checksum"),
        "actual_checksum",
        match_label(F.col("file_checksum"), F.col("actual_checksum"), error).alias("match"),
        error.alias("exception"),
        "checksum_status",
    )


def skipped_file_report(rejects: DataFrame) -> DataFrame:
    """Report rows of files that were never transferred."""
    return rejects.select(
        F.lit("FILE").alias("pattern"),
        "file_sequence_id",
        F.lit(ALGORITHM).alias("algorithm"),
        F.lit(0).cast("bigint").alias("output_bytes"),
        F.lit(MATCH_SKIPPED).alias("match"),
        F.concat_ws(": ", "reason", F.coalesce("details", F.lit("null"))).alias("exception"),
    )


def checksum_summary(report: DataFrame, *, with_totals: bool = False) -> DataFrame:
    """Counts and bytes per organisation, schema, product and topic, with sub-totals on request."""
    keys = ["org_name", "schema_name", "product_name", "topic"]
    status = F.col("checksum_status")
    counts = report.groupBy(*keys).agg(
        F.count_if(status == PASS).alias("ok"),
        F.count_if(status == FAIL).alias("mismatch"),
        F.count_if(status == ABSENT).alias("unchecked"),
        F.count_if((status == FAIL) & (F.col("output_bytes") == 0)).alias("skipped"),
        F.sum("input_bytes").alias("input_bytes"),
        F.sum("output_bytes").alias("output_bytes"),
    )
    if not with_totals:
        return counts
    # Sub-totals add up the counts, so that no message row is repeated per level.
    sums = [c for c in counts.columns if c not in keys]
    return counts.rollup(*keys).agg(*[F.sum(c).alias(c) for c in sums])
