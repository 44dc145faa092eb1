"""Delivered messages and dead letters as files by target topic and consumer, which appear batch by batch.

A data source of Spark's own kind: tasks write files that nobody sees yet, and the commit of a batch is one small record that
lists them. What a batch has committed stands: a repeated attempt at it adds nothing, and files of attempts that ended
before their commit are in no record.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from covenant.functions.headers import DEAD_LETTER_REASON, add_header
from covenant.functions.text import target_topic
from covenant.sources.objects import open_filesystem

DELIVERED, DEAD_LETTER = "delivered", "dead-letter"
_PLACE = ("kind", "topic", "consumer_id")

#: Files a task has open at a time; one more closes the one that was written to least recently.
OPEN_FILES = 64


def exchange_rows(decisions: DataFrame, server: Column, target: Column) -> DataFrame:
    """Decisions as rows of the sink, in one pass: ``kind`` tells delivered messages, under their target topic, from refused
    ones, whose last header is the reason."""
    refused = F.col("reason").isNotNull()
    return decisions.select(
        F.when(refused, DEAD_LETTER).otherwise(DELIVERED).alias("kind"),
        target_topic(F.col("topic"), target, server).alias("topic"),
        F.when(refused, add_header(F.col("headers"), DEAD_LETTER_REASON, F.col("reason"))).otherwise(F.col("headers")).alias("headers"),
        *[c for c in decisions.columns if c not in ("kind", "topic", "headers", "reason")],
    )


@dataclass
class Written(WriterCommitMessage):
    """Files that a task wrote, as paths below the sink."""

    files: list[str]


class _Files:
    """Files of a task, one for each kind, topic and consumer."""

    def __init__(self, root: str) -> None:
        self.filesystem, self.root = open_filesystem(root)
        self.open: dict[tuple, pq.ParquetWriter] = {}
        self.names: list[str] = []

    def write(self, place: tuple, rows: pa.Table) -> None:
        writer = self.open.pop(place, None)
        if writer is None:
            if len(self.open) >= OPEN_FILES:
                self.open.pop(next(iter(self.open))).close()
            kind, topic, consumer = (quote("" if p is None else str(p), safe="") for p in place)
            folder = f"{kind}/topic={topic}/consumer={consumer}"
            self.filesystem.create_dir(f"{self.root}/{folder}", recursive=True)
            self.names.append(f"{folder}/{uuid.uuid4().hex}.parquet")
            writer = pq.ParquetWriter(f"{self.root}/{self.names[-1]}", rows.schema, filesystem=self.filesystem)
        self.open[place] = writer
        writer.write_table(rows)

    def close(self) -> None:
        for writer in self.open.values():
            writer.close()
        self.open = {}


class _Sink:
    """What batch and stream writers share."""

    def __init__(self, root: str) -> None:
        self.root = root.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files = _Files(self.root)
        for batch in iterator:
            rows = pa.Table.from_batches([batch])
            rows = rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in _PLACE]))
            places = list(zip(*(rows.column(c).to_pylist() for c in _PLACE), strict=True))
            first = 0
            for i in range(1, len(places) + 1):
                if i == len(places) or places[i] != places[first]:
                    files.write(places[first], rows.slice(first, i - first).drop_columns(["kind"]))
                    first = i
        files.close()
        return Written(files.names)

    def _record(self, batch: int) -> tuple[pafs.FileSystem, str]:
        filesystem, root = open_filesystem(self.root)
        return filesystem, f"{root}/_commits/{batch}.json"

    def publish(self, messages: list, batch: int) -> None:
        filesystem, record = self._record(batch)
        if filesystem.get_file_info(record).type == pafs.FileType.File:
            # The batch was committed by an earlier attempt.
            self.abort(messages)
            return
        filesystem.create_dir(record.rsplit("/", 1)[0], recursive=True)
        unseen = f"{record}.{uuid.uuid4().hex}"
        with filesystem.open_output_stream(unseen) as out:
            names = [name for message in messages if message is not None for name in message.files]
            out.write("".join(json.dumps({"batch": batch, "file": name}) + "\n" for name in names).encode())
        filesystem.move(unseen, record)

    def abort(self, messages: list, batch: int | None = None) -> None:
        filesystem, root = open_filesystem(self.root)
        for message in messages:
            for name in message.files if message is not None else ():
                filesystem.delete_file(f"{root}/{name}")


class _BatchWriter(_Sink, DataSourceArrowWriter):
    def __init__(self, root: str, batch: int) -> None:
        super().__init__(root)
        self.batch = batch

    def commit(self, messages: list) -> None:
        self.publish(messages, self.batch)


class _StreamWriter(_Sink, DataSourceStreamArrowWriter):
    def commit(self, messages: list, batchId: int) -> None:
        self.publish(messages, batchId)


class ExchangeSink(DataSource):
    """``format("exchange")``: rows with kind, topic and consumer_id below ``path``. A batch write names its ``batch``."""

    @classmethod
    def name(cls) -> str:
        return "exchange"

    def _path(self) -> str:
        if "path" not in self.options:
            raise ValueError("name the path of the sink")
        return self.options["path"]

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite or "batch" not in self.options:
            raise ValueError("append, and name the batch: what a batch has committed stands")
        return _BatchWriter(self._path(), int(self.options["batch"]))

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(self._path())


def write_exchange(rows: DataFrame, path: str, batch: int) -> None:
    """Write the rows of one batch. They are dealt by kind, topic and consumer first, and a large one is split."""
    rows.sparkSession.dataSource.register(ExchangeSink)
    balanced = rows.hint("rebalance", *_PLACE)
    balanced.write.format("exchange").option("path", path).option("batch", batch).mode("append").save()


def committed_files(spark: SparkSession, path: str) -> DataFrame:
    """(batch, file) of everything committed; empty where nothing is."""
    filesystem, root = open_filesystem(path.rstrip("/"))
    if filesystem.get_file_info(f"{root}/_commits").type != pafs.FileType.Directory:
        return spark.createDataFrame([], "batch bigint, file string")
    records = spark.read.schema("batch bigint, file string").option("pathGlobFilter", "*.json")
    return records.json(f"{path.rstrip('/')}/_commits")


def read_exchange(
    spark: SparkSession, path: str, kind: str, *, topic: str | None = None, consumer: str | None = None, batch: int | None = None
) -> DataFrame | None:
    """Committed rows of a kind, of one topic, consumer or batch where these are given; None where there are none."""
    files = committed_files(spark, path).where(F.col("file").startswith(f"{kind}/"))
    if batch is not None:
        files = files.where(F.col("batch") == batch)
    if topic is not None:
        files = files.where(F.split("file", "/")[1] == f"topic={quote(topic, safe='')}")
    if consumer is not None:
        files = files.where(F.split("file", "/")[2] == f"consumer={quote(consumer, safe='')}")
    paths = [f"{path.rstrip('/')}/{row['file']}" for row in files.select("file").collect()]
    return spark.read.parquet(*paths) if paths else None
