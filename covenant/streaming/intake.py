"""Putting files together from a stream of chunks, with state that holds numbers only.

Bytes go into an append-only table as they come. What is remembered of an unfinished file are the ranges of its chunk numbers and
its marker; once they are complete its blocks are joined out of the table by Spark, and a mark takes the place of the state.
Marks keep late repeats from opening a file again; they expire after a time, in drained runs as in continuous ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covenant.functions.text import base_name
from covenant.operators.files import BLOCK_CHUNKS, file_blocks
from covenant.operators.ranges import merge_ranges, position_ranges
from covenant.session import path_exists, written
from covenant.streaming.journal import EVERY, Journal

FILE = ["topic", "partition", "file_sequence_id", "file_name"]

STATE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("file_sequence_id", T.LongType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("first", T.LongType()),
        T.StructField("last", T.LongType()),
        T.StructField("marker_index", T.IntegerType()),
        T.StructField("done_at", T.TimestampType()),
        T.StructField("run", T.LongType()),
    ]
)

#: Seconds for which the mark of a finished file is kept.
MARK_TTL = 24 * 3600


class Intake:
    """Files being received below ``root``: chunks, their state, and the blocks of finished files by micro-batch."""

    def __init__(self, spark: SparkSession, root: str, *, block_chunks: int = BLOCK_CHUNKS, ttl: float = MARK_TTL, every: int = EVERY) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.block_chunks = block_chunks
        self.ttl = ttl
        self.journal = Journal(spark, f"{self.root}/state", STATE, self._fold, every=every)

    def _alive(self, marks: DataFrame) -> DataFrame:
        return marks.where(F.col("done_at") >= F.current_timestamp() - F.make_dt_interval(secs=F.lit(self.ttl)))

    def _fold(self, rows: DataFrame) -> DataFrame:
        """One row per range of an unfinished file and one for its marker; of a finished one its mark, until that expires."""
        marks = rows.where("done_at IS NOT NULL").groupBy(*FILE).agg(F.max("done_at").alias("done_at"), F.max("run").alias("run"))
        left = rows.where("done_at IS NULL").join(marks.select(*FILE), FILE, "left_anti")
        since = left.groupBy(*FILE).agg(F.min("run").alias("run"))
        ranges = merge_ranges(left.where("first IS NOT NULL").select(*FILE, "first", "last"), FILE, short=True).join(since, FILE)
        markers = left.where("marker_index IS NOT NULL").groupBy(*FILE).agg(F.max("marker_index").alias("marker_index"), F.min("run").alias("run"))
        return _padded(ranges).unionByName(_padded(markers)).unionByName(_padded(self._alive(marks)))

    def state(self, before: int | None = None) -> DataFrame:
        """What is remembered now, or was before a run."""
        return self._fold(self.journal.rows(before))

    def take(self, chunks: DataFrame, batch: int) -> None:
        """Take in the chunks of a micro-batch. An attempt that is repeated replaces what an earlier one at it left."""
        known = written(self.state(before=batch), f"{self.root}/known")
        marks = known.where("done_at IS NOT NULL").select(*FILE)
        named = chunks.withColumn("file_name", base_name(F.col("file_name")))
        arrived = written(named.join(marks, FILE, "left_anti"), f"{self.root}/chunks/batch={batch}")
        last = F.col("is_last_chunk")
        ranges = position_ranges(arrived.where(~last), FILE, "chunk_index", short=True)
        markers = arrived.where(last).groupBy(*FILE).agg(F.max("chunk_index").cast("int").alias("marker_index"))
        run = F.lit(batch).cast("bigint").alias("run")
        new = written(
            _padded(ranges.withColumn("run", run)).unionByName(_padded(markers.withColumn("run", run))), f"{self.root}/new"
        )
        open_ = known.where("done_at IS NULL").unionByName(new)
        begun = merge_ranges(open_.where("first IS NOT NULL").select(*FILE, "first", "last"), FILE, short=True).where("first <= 0")
        marked = open_.groupBy(*FILE).agg(F.max("marker_index").alias("marker_index"), F.min("run").alias("since"))
        complete = (F.col("marker_index") == 0) | (F.col("last") >= F.col("marker_index") - 1)
        finished = marked.where("marker_index IS NOT NULL").join(begun, FILE, "left").where(complete)
        finished = written(finished.select(*FILE, "since"), f"{self.root}/finished")
        since = finished.agg(F.min("since")).first()[0]
        blocks = f"{self.root}/blocks/batch={batch}"
        if since is not None:
            table = self.spark.read.option("basePath", f"{self.root}/chunks").parquet(f"{self.root}/chunks")
            wanted = table.where(F.col("batch").between(since, batch)).join(finished.select(*FILE), FILE, "left_semi")
            file_blocks(wanted.drop("batch"), self.block_chunks, by=FILE[:2]).write.mode("overwrite").parquet(blocks)
        done = _padded(finished.select(*FILE, F.current_timestamp().alias("done_at"), run))
        self.journal.commit(new.unionByName(done), batch)

    def blocks(self) -> DataFrame | None:
        """Blocks of all finished files, as :func:`covenant.operators.files.file_blocks` gives them; None where there are none."""
        path = f"{self.root}/blocks"
        if not path_exists(self.spark, path):
            return None
        return self.spark.read.option("basePath", path).parquet(path).drop("batch")


def _padded(rows: DataFrame) -> DataFrame:
    """Rows with all columns of the state; those they lack are null."""
    return rows.select(
        *[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in STATE.fields]
    )


def intake_writer(root: str, *, block_chunks: int = BLOCK_CHUNKS, ttl: float = MARK_TTL, every: int = EVERY) -> Callable[[DataFrame, int], None]:
    """Take in a stream of chunks (with topic and partition), micro-batch by micro-batch; see :class:`Intake`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        Intake(batch.sparkSession, root, block_chunks=block_chunks, ttl=ttl, every=every).take(batch, batch_id)

    return write
