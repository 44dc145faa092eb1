"""Comparing delivered counts with expected ones, and ordering what is delivered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def verify_counts(messages: DataFrame, expected: DataFrame) -> DataFrame:
    """Actual against expected messages per topic; a topic without messages counts zero."""
    actual = messages.groupBy("topic").agg(F.count(F.lit(1)).alias("actual"))
    return (
        expected.join(actual, "topic", "left")
        .withColumn("actual", F.coalesce("actual", F.lit(0)))
        .withColumn("ok", F.col("actual") == F.col("expected"))
        .select("topic", "expected", "actual", "ok")
    )


def ordered_delivery(delivered: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows in offset order within consumer, topic and partition, across and within Spark partitions.

    Ranges are split by offset too, so a hot topic of one consumer fills several partitions.
    """
    order = ["consumer_id", "topic", "partition", "offset"]
    ranged = (
        delivered.repartitionByRange(*order) if partitions is None else delivered.repartitionByRange(partitions, *order)
    )
    return ranged.sortWithinPartitions(*order)
