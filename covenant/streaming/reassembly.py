"""Putting files together from a stream of chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from covenant.functions.text import base_name
from covenant.operators.files import BLOCK_CHUNKS, block_of, file_digests

BLOCK_SCHEMA = (
    "topic string, partition int, file_sequence_id bigint, file_name string, block_index int, content binary, chunk_count bigint, "
    "marker_index int, total_chunks int, file_size bigint, file_checksum string, actual_checksum string, "
    "abandoned boolean"
)
_FILE = ["topic", "partition", "file_sequence_id", "file_name"]
_KEYS = [*_FILE, "block_index"]
_FACTS = "seen array<int>, marker_index int, total_chunks int, file_size bigint, file_checksum string"


class BlockAssembler(StatefulProcessor):
    """Keeps the chunks of one block until they are complete.

    A block is done when it has all its chunks: ``block_chunks`` of them, or up to the marker in a file's last block.
    Chunks and marker may come in any order and more than once. State not completed in time is reported and dropped. Of a
    completed block a mark stays, so that late repeats open no state again; with a timeout the mark expires after it.
    """

    def __init__(self, block_chunks: int, timeout_ms: int | None) -> None:
        self.block_chunks = block_chunks
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getListState("chunks", "chunk_index int, chunk_data binary")
        self.facts = handle.getValueState("facts", _FACTS)
        self.done = handle.getValueState("done", "done boolean", self.timeout_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.done.exists():
            for _ in rows:
                pass
            return
        known = self.facts.get()
        seen, marker, total, size, checksum = known if known else ([], None, None, None, None)
        before = set(seen)
        arrived: dict[int, bytes] = {}
        for row in rows:
            total, size = row["total_chunks"], row["file_size"]
            if row["is_last_chunk"]:
                marker, checksum = row["chunk_index"], row["file_checksum"]
            elif row["chunk_index"] not in before:
                arrived[row["chunk_index"]] = bytes(row["chunk_data"])
        needed = self.block_chunks if marker is None else marker - key[4] * self.block_chunks
        if len(before) + len(arrived) >= needed:
            # Complete within one micro-batch, as most blocks are: nothing was kept and nothing needs to be.
            chunks = {**self._kept(), **arrived} if known else arrived
            yield self._block(key, chunks, marker, total, size, checksum)
            if known:
                self._forget()
            self.done.update((True,))
            return
        if arrived:
            self.chunks.appendList(list(arrived.items()))
        self.facts.update((sorted(before | arrived.keys()), marker, total, size, checksum))
        if not known and self.timeout_ms is not None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.facts.get()
        if known:
            yield self._block(key, self._kept(), *known[1:], abandoned=True)
            self._forget()

    def close(self) -> None:
        pass

    def _kept(self) -> dict[int, bytes]:
        return {index: bytes(data) for index, data in self.chunks.get()}

    def _block(
        self, key, chunks: dict[int, bytes], marker, total, size, checksum, *, abandoned: bool = False
    ) -> Row:
        found = [data for index, data in sorted(chunks.items()) if marker is None or index < marker]
        content = None if abandoned else b"".join(found)
        whole = key[4] == 0 and marker is not None and not abandoned
        digest = hashlib.sha256(content).hexdigest() if whole else None
        return Row(
            topic=key[0],
            partition=key[1],
            file_sequence_id=key[2],
            file_name=key[3],
            block_index=key[4],
            content=content,
            chunk_count=len(found),
            marker_index=marker,
            total_chunks=total,
            file_size=size,
            file_checksum=checksum,
            actual_checksum=digest,
            abandoned=abandoned,
        )

    def _forget(self) -> None:
        if self.timeout_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        self.chunks.clear()
        self.facts.clear()


def reassemble(chunks: DataFrame, *, block_chunks: int = BLOCK_CHUNKS, timeout_ms: int | None = None) -> DataFrame:
    """Blocks of files as soon as they are complete; a file of fewer than ``block_chunks`` chunks is one block.

    State is kept per block, so that a file of any size is spread over tasks and never held whole. Larger files are
    finished by :func:`covenant.operators.files.file_digests` over the written blocks, which reads a block delivered
    again only once. Needs the RocksDB state store.

    With ``timeout_ms`` incomplete blocks are given up after that time. Use it for continuous runs only: a drained
    run would go on for its timers, and without them the state simply waits for the next run.
    """
    keyed = chunks.withColumn("file_name", base_name(F.col("file_name"))).withColumn(
        "block_index", block_of(F.col("chunk_index"), block_chunks)
    )
    return keyed.groupBy(*_KEYS).transformWithState(
        statefulProcessor=BlockAssembler(block_chunks, timeout_ms),
        outputStructType=BLOCK_SCHEMA,
        outputMode="Append",
        timeMode="None" if timeout_ms is None else "ProcessingTime",
    )


def finished_files(blocks: DataFrame) -> DataFrame:
    """Facts of files whose blocks have all been emitted, from the table of blocks, which has the bytes."""
    kept = blocks.where("NOT abandoned")
    whole = kept.where("actual_checksum IS NOT NULL").dropDuplicates(_FILE)
    small = whole.select(
        *_FILE,
        "chunk_count",
        F.lit(1).alias("block_count"),
        "total_chunks",
        "file_size",
        "file_checksum",
        F.lit(0).cast("bigint").alias("conflicting"),
        F.octet_length("content").cast("bigint").alias("actual_size"),
        "actual_checksum",
    )
    large = kept.where("actual_checksum IS NULL").drop("actual_checksum", "abandoned")
    return small.unionByName(file_digests(large, by=["topic", "partition"]))
