"""Continuous and drained runs: read, decide, write, then save progress, micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from covenant.functions.checksums import ABORT, FAIL, SKIP, mismatch_action
from covenant.functions.headers import DEFAULT_SHARED_HEADERS
from covenant.functions.rdf import normalise_rdf
from covenant.operators.federation import federate_decisions
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
from covenant.operators.messages import (
    Payload,
    abort_on_mismatch,
    checksum_report,
    next_offsets,
    to_envelope,
    with_checksum_status,
)
from covenant.plans.outbound import SEQUENCE, file_chunks
from covenant.session import scratch_path, written
from covenant.sinks.exchange import DELIVERED, exchange_rows, read_exchange, write_exchange
from covenant.sources.objects import stat_files
from covenant.streaming.progress import KEYS, DeliveredTable, ProgressTable, not_yet_delivered
from covenant.streaming.refresh import Refreshed, VersionedTable

BatchWriter = Callable[[DataFrame, int], None]


def start(
    stream: DataFrame, each: BatchWriter, checkpoint: str, *, continuous: bool = False, interval: str = "10 seconds"
) -> StreamingQuery:
    """Run ``each`` per micro-batch: until everything available is read, or for good with ``continuous``."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if continuous else writer.trigger(availableNow=True)
    return writer.start()


def drain(stream: DataFrame, each: BatchWriter, checkpoint: str) -> None:
    """Read what is there, then stop. The next call goes on where this one ended."""
    start(stream, each, checkpoint).awaitTermination()


def batch_folder(root: str, batch: int) -> str:
    return f"{root.rstrip('/')}/batch={batch}"


def _read_batch(spark: SparkSession, like: DataFrame, path: str, columns: list[str]) -> DataFrame:
    """The rows a micro-batch wrote, without the columns a follow-up does not need."""
    return spark.read.schema(like.select(*columns).schema).parquet(path)


Grants = Refreshed | VersionedTable | DataFrame


def _grants_of(grants: Grants, batch: int) -> DataFrame:
    """The grants that a micro-batch goes by."""
    if isinstance(grants, VersionedTable):
        return grants.bound(batch)
    return grants.get() if isinstance(grants, Refreshed) else grants


def outbound_writer(
    grants: Grants,
    sink: str,
    *,
    server: str,
    progress: ProgressTable | None = None,
    payload: Payload = normalise_rdf,
    shared: tuple[str, ...] = DEFAULT_SHARED_HEADERS,
) -> BatchWriter:
    """Decide and shape one micro-batch of messages.

    Decisions are written once per batch, delivered and refused rows in one table (``reason`` is null when
    delivered), replacing what an earlier attempt at the batch wrote. Progress is computed from the written rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        shaped = federate_decisions(batch, _grants_of(grants, batch_id), shape=lambda rows: to_envelope(rows, shared, payload))
        folder = batch_folder(sink, batch_id)
        shaped.write.mode("overwrite").parquet(folder)
        if progress is not None:
            rows = _read_batch(
                batch.sparkSession, shaped, folder, ["consumer_id", "topic", "partition", "offset", "reason"]
            ).where("reason IS NULL")
            keyed = rows.withColumnRenamed("consumer_id", "client").withColumn("server", F.lit(server))
            progress.commit(next_offsets(keyed), batch_id)

    return write


def exchange_writer(
    grants: Grants,
    sink: str,
    *,
    server: str,
    target: str = "",
    progress: ProgressTable | None = None,
    payload: Payload = normalise_rdf,
    shared: tuple[str, ...] = DEFAULT_SHARED_HEADERS,
) -> BatchWriter:
    """Decide and shape one micro-batch into the exchange sink: delivered messages by target topic and consumer, refused ones
    beside them as dead letters, in one pass. What a batch has committed stands, so a repeated attempt at it adds no row."""

    def write(batch: DataFrame, batch_id: int) -> None:
        shaped = federate_decisions(batch, _grants_of(grants, batch_id), shape=lambda rows: to_envelope(rows, shared, payload))
        # The topic it came from stays beside the one it goes to: progress is kept by it.
        rows = exchange_rows(shaped.withColumn("source_topic", F.col("topic")), F.lit(server), F.lit(target))
        write_exchange(rows, sink, batch_id)
        if progress is not None:
            sent = read_exchange(batch.sparkSession, sink, DELIVERED, batch=batch_id)
            if sent is not None:
                keyed = sent.select(
                    F.col("consumer_id").alias("client"), F.lit(server).alias("server"), F.col("source_topic").alias("topic"), "partition", "offset"
                )
                progress.commit(next_offsets(keyed), batch_id)

    return write


def run_federation(
    stream: DataFrame,
    grants: Grants,
    sink: str,
    checkpoint: str,
    *,
    server: str = "",
    target: str = "",
    progress: ProgressTable | None = None,
    payload: Payload = normalise_rdf,
    shared: tuple[str, ...] = DEFAULT_SHARED_HEADERS,
    continuous: bool = False,
    exchange: bool = False,
) -> StreamingQuery:
    """Deliver a stream of messages to every entitled consumer: as one folder of decisions a batch, or, with ``exchange``, by
    target topic and consumer with dead letters beside them."""
    options = {"server": server, "progress": progress, "payload": payload, "shared": shared}
    if exchange:
        return start(stream, exchange_writer(grants, sink, target=target, **options), checkpoint, continuous=continuous)
    return start(stream, outbound_writer(grants, sink, **options), checkpoint, continuous=continuous)


def inbound_writer(
    sink: str,
    *,
    client: str,
    server: str,
    on_mismatch: str = SKIP,
    progress: ProgressTable | None = None,
    reports: str | None = None,
    exact: bool = False,
) -> BatchWriter:
    """Verify and store one micro-batch of envelopes.

    ABORT raises before anything of the batch is written. ``exact`` drops rows whose position an earlier micro-batch wrote;
    offsets may come late and in any order. What was written is remembered as ranges beside the sink, so that a batch costs what
    it holds, however many came before it.
    """
    action = mismatch_action(on_mismatch)
    ranges = f"{sink.rstrip('/')}-delivered"

    def write(batch: DataFrame, batch_id: int) -> None:
        named = batch.withColumns({"client": F.lit(client), "server": F.lit(server)})
        if exact:
            # What an earlier attempt at this batch wrote does not count.
            delivered = DeliveredTable(batch.sparkSession, ranges)
            named = not_yet_delivered(named, delivered.ranges(before=batch_id))
        checked = with_checksum_status(named)
        if action == ABORT:
            abort_on_mismatch(checked)
        folder = batch_folder(sink, batch_id)
        # A skipped mismatch stays as a row without payload: it moves progress and shows in the report.
        skipped = (F.col("checksum_status") == FAIL) & F.lit(action == SKIP)
        stored = checked.withColumns(
            {"skipped": skipped, "payload_bytes": F.octet_length("value").cast("bigint")}
        ).withColumn("value", F.when(~skipped, F.col("value")))
        stored.write.mode("overwrite").parquet(folder)
        if reports:
            rows = _read_batch(batch.sparkSession, stored, folder, [c for c in stored.columns if c != "value"])
            checksum_report(rows, on_mismatch, F.lit(server), F.col("payload_bytes")).write.mode("overwrite").parquet(
                batch_folder(reports, batch_id)
            )
        rows = _read_batch(batch.sparkSession, stored, folder, [*KEYS, "offset"])
        if exact:
            delivered.commit(rows, batch_id)
        if progress is not None:
            progress.commit(next_offsets(rows), batch_id)

    return write


def file_outbound_writer(
    contents: Callable[[DataFrame], DataFrame] | None,
    sink: str,
    rejects: str,
    *,
    listing: Callable[[DataFrame], DataFrame] | None = None,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    azure_account: str | None = None,
) -> BatchWriter:
    """Turn one micro-batch of file references into chunks; bad references become rejects and the stream goes on.

    Without ``contents`` the objects are read from their stores, whatever their size. ``contents`` reads them otherwise: it
    gives ``uri, content, error`` of the valid requests' objects. What cannot be read is a reject with reason FETCH. Chunks
    and rejects carry topic, partition and sequence id.
    """
    if contents is None:
        return _object_writer(sink, rejects, chunk_size, azure_account)

    def write(batch: DataFrame, batch_id: int) -> None:
        requests = decode_file_requests(batch, azure_account)
        checked = check_file_requests(requests, listing(requests) if listing else None)
        valid = valid_file_requests(checked)
        fetched = keyed_join(
            valid.drop("size"),
            contents(valid),
            ["uri"],
            how="left",
            spread=["file_sequence_id"],
            salt=True,
        )
        failed = F.col("error").isNotNull() | F.col("content").isNull()
        files = fetched.where(~failed).withColumn("file_name", F.col("path"))
        chunk_files(files, chunk_size, by=SEQUENCE).write.mode("overwrite").parquet(batch_folder(sink, batch_id))
        unread = fetched.where(failed).select(
            "topic",
            "partition",
            "file_sequence_id",
            F.lit(FETCH).alias("reason"),
            F.coalesce("error", F.lit("no content was given")).alias("details"),
        )
        rejected_file_requests(checked).unionByName(unread).write.mode("overwrite").parquet(
            batch_folder(rejects, batch_id)
        )

    return write


def _object_writer(sink: str, rejects: str, chunk_size: int, azure_account: str | None) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        work = scratch_path(batch.sparkSession, "file-batch")
        requests = decode_file_requests(batch, azure_account)
        listing = written(stat_files(requests), f"{work}/listing")
        checked = check_file_requests(requests, listing)
        chunks, unread = file_chunks(valid_file_requests(checked), listing, chunk_size, work)
        chunks.write.mode("overwrite").parquet(batch_folder(sink, batch_id))
        rejected_file_requests(checked).unionByName(unread).write.mode("overwrite").parquet(batch_folder(rejects, batch_id))

    return write


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """Everything the micro-batches wrote."""
    return spark.read.option("basePath", sink).parquet(sink).drop("batch")
