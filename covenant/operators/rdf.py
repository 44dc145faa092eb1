"""RDF payloads as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covenant.functions.rdf import content_type, is_line_based, quads


def rdf_to_quads(messages: DataFrame) -> DataFrame:
    """One row per distinct statement of each valid line-based payload, with the message's position."""
    parsed = messages.select(
        "topic",
        "partition",
        "offset",
        quads(F.col("value").cast("string"), content_type(F.col("headers"))).alias("quads"),
    )
    return parsed.select("topic", "partition", "offset", F.inline("quads"))


def unparsable_rdf(messages: DataFrame) -> DataFrame:
    """Positions of dataset payloads that are read as statements but are not valid."""
    kind = content_type(F.col("headers"))
    return messages.where(is_line_based(kind) & quads(F.col("value").cast("string"), kind).isNull()).select(
        "topic", "partition", "offset", kind.alias("content_type")
    )
