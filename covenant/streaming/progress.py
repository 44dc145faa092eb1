"""Progress and delivered positions of each client, server, topic and partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covenant.operators.ranges import merge_ranges, not_covered, position_ranges
from covenant.schemas import PROGRESS
from covenant.streaming.journal import EVERY, Journal

KEYS = ["client", "server", "topic", "partition"]

DELIVERED = T.StructType(
    [f for f in PROGRESS.fields if f.name in KEYS]
    + [T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("run", T.LongType())]
)


def merge_progress(updates: DataFrame) -> DataFrame:
    """Current position per key: that of its latest run, as a saved position replaces the one before it."""
    latest = F.max(F.struct("run", "next_offset"))
    return (
        updates.groupBy(*KEYS)
        .agg(latest.alias("__latest"))
        .select(*KEYS, F.col("__latest.next_offset").alias("next_offset"), F.col("__latest.run").alias("run"))
    )


class ProgressTable:
    """Progress below a shared path, as a log of runs and snapshots. Repeating a run replaces its rows."""

    def __init__(self, spark: SparkSession, path: str, *, every: int = EVERY) -> None:
        self.spark = spark
        self.journal = Journal(spark, path, PROGRESS, merge_progress, every=every)

    def commit(self, updates: DataFrame, run: int) -> None:
        """Save ``(client, server, topic, partition, next_offset)`` of one run. Call after the sink has its rows."""
        rows = updates.select(*KEYS, F.col("next_offset").cast("bigint").alias("next_offset"), F.lit(run).cast("bigint").alias("run"))
        self.journal.commit(rows, run)

    def updates(self) -> DataFrame:
        """Saved positions that are not folded yet, and the snapshot before them."""
        return self.journal.rows()

    def current(self) -> DataFrame:
        return merge_progress(self.updates())


class DeliveredTable:
    """Positions that were delivered, as merged ranges of offsets; they grow with the gaps, not with the messages."""

    def __init__(self, spark: SparkSession, path: str, *, every: int = EVERY) -> None:
        def fold(rows: DataFrame) -> DataFrame:
            newest = rows.groupBy(*KEYS).agg(F.max("run").alias("run"))
            return merge_ranges(rows.drop("run"), KEYS).join(newest, KEYS)

        self.spark = spark
        self.journal = Journal(spark, path, DELIVERED, fold, every=every)

    def commit(self, rows: DataFrame, run: int) -> None:
        """Add the positions of ``rows`` (client, server, topic, partition, offset). Call after the sink has them."""
        ranges = position_ranges(rows, KEYS, "offset")
        self.journal.commit(ranges.withColumn("run", F.lit(run).cast("bigint")), run)

    def ranges(self, before: int | None = None) -> DataFrame:
        """Merged ranges (client, server, topic, partition, first, last) of all runs, or of those before a run."""
        return merge_ranges(self.journal.rows(before).drop("run"), KEYS)


def not_yet_delivered(rows: DataFrame, delivered: DataFrame | None) -> DataFrame:
    """Rows whose position (client, server, topic, partition, offset) lies in none of the ``delivered`` ranges (first, last),
    each once: redelivery after a crash adds nothing, and an offset that comes late is not lost."""
    fresh = rows.dropDuplicates([*KEYS, "offset"])
    return fresh if delivered is None else not_covered(fresh, delivered, KEYS, "offset")
