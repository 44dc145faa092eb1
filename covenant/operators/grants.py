"""Who may read what: grant documents as rows, and the joins that answer access questions for everyone at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covenant.functions.text import trim_all
from covenant.operators.joins import keyed_join
from covenant.schemas import ATTRIBUTES

# Fixed value: message of a refused topic request.
TOPIC_REFUSED = "Topic (%s) is not valid for client (%s)."


def document_position(document: Column, producer: Column, product: Column, consumer: Column, attribute: Column) -> Column:
    """The five places in the order of a reader: document, producer, product, consumer, attribute."""
    places = {"document": document, "producer": producer, "product": product, "consumer": consumer, "attribute": attribute}
    return F.struct(*[place.cast("bigint").alias(name) for name, place in places.items()])


def flatten_grants(documents: DataFrame) -> DataFrame:
    """One row per attribute of a consumer of a product of a producer.

    Empty or null levels yield nothing, except that a consumer without attributes keeps one row with
    ``has_attribute`` false. ``position`` is the place of the attribute in its document, after that of the document: its
    column ``document`` if there is one, else its row's place in ``documents``.
    """
    number = F.col("document") if "document" in documents.columns else F.monotonically_increasing_id()
    producers = documents.select(
        number.alias("document"), F.col("clientId").alias("client_id"), F.posexplode("producers").alias("producer_pos", "p")
    ).where("p IS NOT NULL")
    products = producers.select(
        "document",
        "client_id",
        "producer_pos",
        F.col("p.name").alias("producer"),
        F.posexplode("p.products").alias("product_pos", "d"),
    ).where("d IS NOT NULL")
    consumers = products.select(
        "document",
        "client_id",
        "producer_pos",
        "producer",
        "product_pos",
        F.col("d.name").alias("product"),
        F.col("d.topic").alias("topic"),
        F.col("d.type").alias("product_type"),
        F.posexplode("d.consumers").alias("consumer_pos", "c"),
    ).where("c IS NOT NULL")
    attributes = F.filter(F.col("c.attributes"), lambda a: a.isNotNull())
    return consumers.select(
        "document",
        "client_id",
        "producer",
        "product",
        "topic",
        "product_type",
        F.col("c.idpClientId").alias("consumer_id"),
        "producer_pos",
        "product_pos",
        "consumer_pos",
        F.posexplode_outer(attributes).alias("attr_pos", "a"),
    ).select(
        "client_id",
        "producer",
        "product",
        "topic",
        "product_type",
        "consumer_id",
        document_position(
            F.col("document"),
            F.col("producer_pos"),
            F.col("product_pos"),
            F.col("consumer_pos"),
            F.coalesce("attr_pos", F.lit(0)),
        ).alias("position"),
        F.col("a").isNotNull().alias("has_attribute"),
        F.col("a.name").alias("attribute_name"),
        F.col("a.value").alias("attribute_value"),
    )


def consumer_topics(
    grants: DataFrame, only: DataFrame | None = None, *, topics: DataFrame | None = None, ordered: bool = True, salt: bool = False
) -> DataFrame:
    """``(consumer_id, topic_key, granted, attributes)`` per consumer and topic **or product name**, in lower case.

    ``granted`` is true when a product's topic is the key; a product's name alone only contributes attributes.
    Attributes are the union over all matching products, in document order. A repeated attribute counts once: the
    rule is a conjunction, and repeats are folded before they are shuffled into a list. ``only`` holds the keys of
    interest; others are dropped first. So are keys that are not among ``topics`` (topic_key), where these are given. Without
    ``ordered`` attributes come in the order of their names and values, and positions are not carried along.
    """
    attribute = ["has_attribute", "attribute_name", "attribute_value"]
    named = grants.where("consumer_id IS NOT NULL").select(
        "consumer_id", F.lower("topic").alias("topic"), F.lower("product").alias("product"), "position", *attribute
    )
    names = F.when(F.col("topic").eqNullSafe(F.col("product")), F.array("topic")).otherwise(F.array("topic", "product"))
    keyed = named.select(
        "consumer_id", F.explode(names).alias("topic_key"), "topic", "position", *attribute
    ).where("topic_key IS NOT NULL")
    if topics is not None:
        keyed = keyed.join(topics, "topic_key", "left_semi")
    if only is not None:
        keyed = keyed_join(
            keyed,
            only,
            ["consumer_id", "topic_key"],
            how="left_semi",
            spread=["position", "attribute_name", "attribute_value"],
            salt=salt,
        )
    granted = F.max(F.coalesce(F.col("topic_key") == F.col("topic"), F.lit(False))).alias("granted")
    stated = [F.col("attribute_name").alias("name"), F.col("attribute_value").alias("value")]
    if not ordered:
        # Equal attributes are one in a set, so that nothing has to be folded before.
        found = F.collect_set(F.when(F.col("has_attribute"), F.struct(*stated)))
        return keyed.groupBy("consumer_id", "topic_key").agg(granted, F.array_sort(found).alias("attributes"))
    folded = keyed.groupBy("consumer_id", "topic_key", *attribute).agg(F.min("position").alias("position"), granted)
    return folded.groupBy("consumer_id", "topic_key").agg(
        F.max("granted").alias("granted"),
        F.transform(
            F.array_sort(F.collect_list(F.when(F.col("has_attribute"), F.struct("position", *stated)))),
            lambda a: F.struct(a["name"].alias("name"), a["value"].alias("value")),
        ).alias("attributes"),
    )


def access_pairs(grants: DataFrame) -> DataFrame:
    """Distinct ``(consumer_id, topic_key)`` a consumer may read: product topics only, any case."""
    return (
        grants.where("consumer_id IS NOT NULL AND topic IS NOT NULL")
        .select("consumer_id", F.lower("topic").alias("topic_key"))
        .distinct()
    )


def entitlements(
    grants: DataFrame,
    requests: DataFrame | None = None,
    *,
    require_topic_grant: bool = True,
    topics: DataFrame | None = None,
    ordered: bool = True,
) -> DataFrame:
    """``(consumer_id, topic_key, attributes)``: what each consumer may read and under which attributes.

    Without ``requests`` every granted pair counts. With them only requested pairs do; and without
    ``require_topic_grant`` a request of any known consumer is honoured even when no product grants the topic.
    ``topics`` and ``ordered`` are those of :func:`consumer_topics`; grants of other topics may be missing.
    """
    lists = consumer_topics(grants, topics=topics, ordered=ordered)
    if requests is None:
        if not require_topic_grant:
            raise ValueError("without topic grants the requested topics must be given")
        return lists.where("granted").drop("granted")
    asked = requests.select("consumer_id", F.lower(trim_all(F.col("topic"))).alias("topic_key")).distinct()
    if require_topic_grant:
        return asked.join(lists.where("granted").drop("granted"), ["consumer_id", "topic_key"])
    known = grants.select("consumer_id").distinct()
    joined = asked.join(known, "consumer_id", "left_semi").join(
        lists.drop("granted"), ["consumer_id", "topic_key"], "left"
    )
    return joined.withColumn("attributes", F.coalesce("attributes", F.array().cast(ATTRIBUTES)))


def attributes_for(requests: DataFrame, grants: DataFrame, *, salt: bool = False) -> DataFrame:
    """Attribute list of each requested ``(consumer_id, topic)``; empty when nothing matches. Topics are not trimmed."""
    asked = requests.select("consumer_id", "topic").distinct().withColumn("topic_key", F.lower("topic"))
    keys = asked.select("consumer_id", "topic_key").distinct()
    lists = consumer_topics(grants, keys, salt=salt).drop("granted")
    found = asked.join(lists, ["consumer_id", "topic_key"], "left")
    return found.select(
        "consumer_id", "topic", F.coalesce("attributes", F.array().cast(ATTRIBUTES)).alias("attributes")
    )


def has_topic_access(
    requests: DataFrame, grants: DataFrame, *, denied: bool = False, salt: bool = False
) -> DataFrame:
    """Requests whose trimmed topic is granted to exactly this consumer id; or the denied ones with a message.

    Extra columns of ``requests`` are kept.
    """
    asked = requests.withColumn("topic_key", F.lower(trim_all(F.col("topic"))))
    checked = keyed_join(
        asked,
        access_pairs(grants),
        ["consumer_id", "topic_key"],
        how="left_anti" if denied else "left_semi",
        spread=requests.columns,
        salt=salt,
    ).drop("topic_key")
    return checked.withColumn("details", F.format_string(TOPIC_REFUSED, "topic", "consumer_id")) if denied else checked


def known_consumer(requests: DataFrame, grants: DataFrame, *, salt: bool = False) -> DataFrame:
    """Requests of consumers that appear under any product."""
    known = grants.where("consumer_id IS NOT NULL").select("consumer_id").distinct()
    return keyed_join(
        requests, known, ["consumer_id"], how="left_semi", spread=requests.columns, salt=salt
    )


def active_feeds(feeds: DataFrame, status: DataFrame, *, salt: bool = False) -> DataFrame:
    """Feeds whose producer certificate is ACTIVE. Unlisted clients count as NOT_FOUND and yield nothing."""
    listed = status.select(F.col("client_id").alias("client_name"), F.col("status").alias("certificate_status"))
    # A client listed twice with different answers is not trusted.
    settled = listed.groupBy("client_name").agg(
        F.when(F.min("certificate_status") == F.max("certificate_status"), F.min("certificate_status")).alias(
            "certificate_status"
        )
    )
    joined = keyed_join(
        feeds, settled, ["client_name"], how="left", spread=["feed_id"], salt=salt
    )
    return joined.where(F.coalesce("certificate_status", F.lit("NOT_FOUND")) == "ACTIVE").drop("certificate_status")
