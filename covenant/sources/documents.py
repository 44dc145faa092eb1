"""Reading grant and consumer documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covenant.operators.grants import flatten_grants
from covenant.schemas import CONSUMER_DOCUMENT, GRANTS_DOCUMENT


def read_grants(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Grant rows out of nested JSON documents; unknown fields are ignored, every list may be missing."""
    documents = spark.read.schema(GRANTS_DOCUMENT).option("multiLine", multi_line).json(path)
    return flatten_grants(documents)


def read_feeds_config(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Consumer documents, to be flattened by :func:`covenant.operators.feeds.feeds`."""
    return spark.read.schema(CONSUMER_DOCUMENT).option("multiLine", multi_line).json(path)


def parse_documents(texts: DataFrame, schema: str, column: str = "json") -> DataFrame:
    """Documents out of a column of JSON texts."""
    return texts.select(F.from_json(column, schema).alias("__d")).select("__d.*")
