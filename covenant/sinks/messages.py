"""Writing messages to Kafka or to tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covenant.functions.text import target_topic


def for_target(delivered: DataFrame, target: Column, server: Column) -> DataFrame:
    """The four columns a topic stores, under the target topic's name."""
    headers = F.transform(
        "headers", lambda h: F.struct(h["key"].alias("key"), F.encode(h["value"], "UTF-8").alias("value"))
    )
    return delivered.select(
        target_topic(F.col("topic"), target, server).alias("topic"), "key", "value", headers.alias("headers")
    )


def write_messages(
    delivered: DataFrame,
    sink: str,
    *,
    format: str = "parquet",
    target: str = "",
    server: str = "",
    options: Mapping[str, str] | None = None,
) -> None:
    """Write a batch: to Kafka (``sink`` = bootstrap servers), or as files below ``sink`` by consumer and topic.

    Files are rebalanced by consumer and topic first: small ones are merged, a hot topic is split.
    """
    if format == "kafka":
        rows = for_target(delivered, F.lit(target), F.lit(server))
        rows.write.format("kafka").option("kafka.bootstrap.servers", sink).options(**dict(options or {})).save()
        return
    keys = [c for c in ("consumer_id", "topic") if c in delivered.columns]
    balanced = delivered.hint("rebalance", *keys) if keys else delivered
    balanced.write.mode("append").format(format).options(**dict(options or {})).partitionBy(*keys).save(sink)
