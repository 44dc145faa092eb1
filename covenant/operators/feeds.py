"""Feed definitions: a nested consumer document flattened into one row per feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covenant.functions.naming import DEFAULT_SCHEDULE, clean_host, clean_server_name, normalise_schedule
from covenant.functions.text import is_blank
from covenant.operators.snapshots import snapshot_diff

# Defaults of a connection and a feed, and reject reasons.
DEFAULT_PORT = 8080
DEFAULT_RETRIES = 5
FEED_TYPES = ("topic", "file")
INVALID_PRODUCER = "INVALID_PRODUCER"
INVALID_CONNECTION = "INVALID_CONNECTION"
INVALID_PRODUCT = "INVALID_PRODUCT"
UNKNOWN_TYPE = "UNKNOWN_TYPE"
NO_CONFIGURATION = "NO_CONFIGURATION"

FEED_COLUMNS = [
    "feed_id",
    "job_name",
    "node_id",
    "type",
    "topic",
    "server_name",
    "host",
    "port",
    "tls",
    "client_name",
    "schedule_type",
    "schedule_expression",
    "retries",
    "immediate",
    "source_path",
    "destination",
]


def valid_producer(producer: Column) -> Column:
    """Has products, a name that is not blank, and a host."""
    return (
        producer["products"].isNotNull()
        & F.coalesce(F.trim(producer["name"]) != "", F.lit(False))
        & producer["host"].isNotNull()
    )


def valid_product(product: Column) -> Column:
    """Has a topic and a known type (any case)."""
    return product["topic"].isNotNull() & known_type(product)


def known_type(product: Column) -> Column:
    return F.coalesce(F.lower(product["type"]).isin(*FEED_TYPES), F.lit(False))


def connection_problem(client_name: Column, key: Column, host: Column, port: Column, server: Column) -> Column:
    """What is wrong with a connection, or null."""
    return (
        F.when(is_blank(client_name), "client name is blank")
        .when(is_blank(key), "client key is blank")
        .when(is_blank(host), "server host is blank")
        .when(port < 0, "server port is negative")
        .when(~F.coalesce(server.rlike("^[a-zA-Z0-9]+$"), F.lit(False)), "server name is not alphanumeric")
    )


def feed_candidates(documents: DataFrame, node_id: str) -> DataFrame:
    """Every product of every producer as a feed row with ``reason``: null when the feed is usable.

    Only a product's first configuration counts; a product without one is rejected on its own. A producer that is not
    valid is rejected with each of its products.
    """
    producers = documents.select(
        F.col("clientId").alias("document_client"), F.explode("producers").alias("p")
    ).where("p IS NOT NULL")
    products = producers.withColumn("d", F.explode_outer("p.products")).where(
        F.col("d").isNotNull() | ~valid_producer(F.col("p"))
    )
    configuration = F.get(F.col("d.configurations"), F.lit(0))
    shaped = products.select(
        "document_client",
        "p",
        "d",
        clean_server_name(F.col("p.name")).alias("server_name"),
        clean_host(F.col("p.host")).alias("host"),
        F.coalesce(F.col("p.port").cast("int"), F.lit(DEFAULT_PORT)).alias("port"),
        F.coalesce("p.tls", F.lit(False)).alias("tls"),
        F.col("p.idpClientId").alias("client_name"),
        configuration.alias("cfg"),
        (F.coalesce(F.size("d.configurations"), F.lit(0)) > 0).alias("configured"),
    )
    connection = connection_problem(
        F.col("client_name"), F.lit("NA"), F.col("host"), F.col("port"), F.col("server_name")
    )
    reason = (
        F.when(~valid_producer(F.col("p")), INVALID_PRODUCER)
        .when(connection.isNotNull(), INVALID_CONNECTION)
        .when(F.col("d.topic").isNull(), INVALID_PRODUCT)
        .when(~known_type(F.col("d")), UNKNOWN_TYPE)
        .when(~F.col("configured"), NO_CONFIGURATION)
    )
    kind = F.lower("d.type")
    is_file = kind == "file"
    schedule = normalise_schedule(F.col("cfg.scheduleType"), F.col("cfg.scheduleExpression"))
    return shaped.select(
        F.concat_ws("-", "server_name", "d.topic").alias("feed_id"),
        F.col("server_name").alias("job_name"),
        F.lit(node_id).alias("node_id"),
        kind.alias("type"),
        F.col("d.topic").alias("topic"),
        "server_name",
        "host",
        "port",
        "tls",
        "client_name",
        F.col("cfg.scheduleType").alias("schedule_type"),
        F.coalesce("cfg.scheduleExpression", F.lit(DEFAULT_SCHEDULE)).alias("schedule_expression"),
        F.lit(DEFAULT_RETRIES).alias("retries"),
        F.lit(False).alias("immediate"),
        F.when(is_file, F.col("d.source")).alias("source_path"),
        F.when(is_file, F.col("cfg.destination")).alias("destination"),
        schedule.alias("effective_schedule"),
        "document_client",
        F.col("p.name").alias("producer"),
        F.col("d.name").alias("product"),
        reason.alias("reason"),
        F.when(reason == INVALID_CONNECTION, connection).alias("details"),
    )


def feeds(documents: DataFrame, node_id: str) -> DataFrame:
    """Usable feeds of the consumer documents of one node."""
    return feed_candidates(documents, node_id).where("reason IS NULL").select(*FEED_COLUMNS, "effective_schedule")


def feed_rejects(documents: DataFrame, node_id: str) -> DataFrame:
    return (
        feed_candidates(documents, node_id)
        .where("reason IS NOT NULL")
        .select("document_client", "producer", "product", "topic", "reason", "details")
    )


def diff_feeds(current: DataFrame, requested: DataFrame, node_id: str, order: str | None = None) -> DataFrame:
    """What to add, replace, delete or keep for one node. The id stands for the topic, so it is not compared."""
    compare = [c for c in FEED_COLUMNS if c in requested.columns and c not in ("feed_id", "topic", "type")]
    return snapshot_diff(
        current, requested, ["feed_id"], compare=compare, scope=F.col("node_id") == node_id, order=order
    )
