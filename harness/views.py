"""The engine's inputs (messages, grants, files, documents) as views over the given tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covenant.operators.grants import document_position, flatten_grants
from covenant.schemas import CONSUMER_DOCUMENT, GRANTS_DOCUMENT


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def header(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("key"), value.alias("value"))


def when_divides(number: int, column: str, value: Column) -> Column:
    return F.when(F.col(column) % number == 0, value)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as tagged messages: the source is the topic, the id the offset, the text the payload."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    label = (
        when_divides(50, "doc_id", F.lit("A="))
        .when(F.col("doc_id") % 31 == 0, "   ")
        .otherwise(
            F.concat(
                F.lit(" nationality : "),
                "lang",
                F.coalesce(F.concat(F.lit(",clearance="), F.col("quality").cast("string")), F.lit("")),
                F.coalesce(when_divides(13, "doc_id", F.lit(",organisation_type=gov")), F.lit("")),
            )
        )
    )
    notes = '{"note":1}'
    described = json.dumps({"orgName": "acme", "schemaType": "avro", "productType": "gas"})
    headers = F.array_compact(
        F.array(
            header("Security-Label", label),
            when_divides(11, "doc_id", header("security-label", F.lit("nationality=zz"))),
            header("Content-Type", F.lit("text/plain")),
            when_divides(9, "doc_id", header("content-type", F.lit("other"))),
            when_divides(10, "doc_id", header("Content-Type", F.lit("application/n-triples"))),
            when_divides(14, "doc_id", header("Content-Type", F.lit("Application/RDF-Patch"))),
            when_divides(5, "doc_id", header("orgName", F.concat(F.lit(" org-"), "lang", F.lit(" ")))),
            when_divides(12, "doc_id", header("metadata", F.lit(notes))),
            when_divides(8, "doc_id", header("metadata", F.lit(described))),
            when_divides(15, "doc_id", header("schemaType", F.lit("eq"))),
        )
    )
    return docs.join(labels, "doc_id", "left").select(
        F.col("source").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("doc_id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.when(F.col("doc_id") % 7 != 0, F.encode(F.concat(F.lit("k"), F.col("doc_id").cast("string")), "UTF-8")).alias(
            "key"
        ),
        F.encode("text", "UTF-8").alias("value"),
        headers.alias("headers"),
    )


# (product, topic, consumer, attributes): every case of the access rules over the twenty document topics.
POLICY: list[tuple[str, str, str, list[tuple[str | None, str | None]]]] = [
    ("alpha", "src0", "c-open", []),
    ("alpha", "src0", "c-en", [("nationality", "EN")]),
    ("alpha", "src0", "c-two", [("Nationality", "en"), ("CLEARANCE", "1")]),
    ("beta", "SRC1", "c-fr", [("nationality", "fr")]),
    ("beta", "SRC1", "c-noname", [(None, "fr")]),
    ("src2", "unused", "c-en", [("nationality", "de")]),
    ("gamma", "src2", "c-en", [("nationality", "en")]),
    ("src3", "src3", "c-novalue", [("nationality", None)]),
    ("src3", "src3", "c-dept", [("nationality", "en"), ("department", "x")]),
    ("eps-1", "src4", "c-two", [("nationality", "en")]),
    ("eps-2", "src4", "c-two", [("clearance", "1")]),
    *[(f"all-{i}", f"src{i}", "c-all", []) for i in range(20)],
    *[(f"en-{i}", f"Src{i}", "c-en", [("nationality", "en")]) for i in range(5, 20)],
]


def policy_json() -> str:
    products = [
        {
            "name": product,
            "topic": topic,
            "type": "topic",
            "ignored": True,
            "consumers": [
                None,
                {
                    "idpClientId": consumer,
                    "attributes": [None, *[{"name": n, "value": v} for n, v in attributes]],
                },
            ],
        }
        for product, topic, consumer, attributes in POLICY
    ]
    return json.dumps({"clientId": "owner", "producers": [None, {"name": "p-1", "products": products}]})


def grants(spark: SparkSession) -> DataFrame:
    return _grants_of(spark, policy_json())


def _grants_of(spark: SparkSession, text: str) -> DataFrame:
    return flatten_grants(spark.range(1).select(F.from_json(F.lit(text), GRANTS_DOCUMENT).alias("d")).select("d.*"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the order's customer, the lines of an order as one sorted list."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.array_sort(
            F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"))
        ).alias("lines")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"]).drop("l_orderkey")


def grant_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One grants document per order: its lines are products, its customer their consumer."""

    def attribute(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    def product(line: Column) -> Column:
        attributes = (
            F.when(line["l_linenumber"] == 1, F.array().cast("array<struct<name:string,value:string>>"))
            .when(
                line["l_linenumber"] == 2,
                F.array(F.lit(None), attribute("linestatus", line["l_linestatus"])),
            )
            .otherwise(
                F.array(attribute("returnflag", line["l_returnflag"]), attribute("linestatus", line["l_linestatus"]))
            )
        )
        return F.struct(
            F.concat(F.lit("P"), line["l_partkey"].cast("string")).alias("name"),
            F.concat(F.lit("T"), line["l_suppkey"].cast("string")).alias("topic"),
            F.array(
                F.struct(
                    F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("idpClientId"),
                    attributes.alias("attributes"),
                )
            ).alias("consumers"),
        )

    producer = F.struct(F.lit("orders").alias("name"), F.transform("lines", product).alias("products"))
    document = F.to_json(
        F.struct(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("clientId"), F.array(producer).alias("producers"))
    )
    return order_lines(spark, sf_dir).select(F.from_json(document, GRANTS_DOCUMENT).alias("d")).select("d.*")


def grant_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of :func:`grant_documents`, taken from the order lines directly."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    linestatus = F.struct(F.lit("linestatus").alias("name"), F.col("l_linestatus").alias("value"))
    returnflag = F.struct(F.lit("returnflag").alias("name"), F.col("l_returnflag").alias("value"))
    attributes = F.when(F.col("l_linenumber") == 2, F.array(linestatus)).when(
        F.col("l_linenumber") > 2, F.array(returnflag, linestatus)
    )
    return lines.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product"),
        F.concat(F.lit("T"), F.col("l_suppkey").cast("string")).alias("topic"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("consumer_id"),
        "l_linenumber",
        F.posexplode_outer(attributes).alias("attr_pos", "a"),
    ).select(
        "product",
        "topic",
        "consumer_id",
        document_position(F.lit(0), F.lit(0), F.col("l_linenumber"), F.lit(0), F.coalesce("attr_pos", F.lit(0))).alias("position"),
        F.col("a").isNotNull().alias("has_attribute"),
        F.col("a.name").alias("attribute_name"),
        F.col("a.value").alias("attribute_value"),
    )


def granted_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as messages on the topics of :func:`grant_rows`, labelled with the states that order lines have."""
    topics = table(spark, sf_dir, "supplier").select("s_suppkey")
    number = F.col("doc_id") % F.lit(topics.count()) + 1
    key = F.col("doc_id")
    status = F.when(key % 3 == 0, "linestatus=O").when(key % 3 == 1, "linestatus : f")
    flag = F.when(key % 4 == 0, "returnflag=A").when(key % 4 == 1, "returnflag=N").when(key % 4 == 2, "returnflag=R")
    label = F.when(key % 29 == 0, "linestatus=").otherwise(F.concat_ws(",", F.lit("kind=order"), flag, status))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select(
        F.concat(F.lit("t"), number.cast("string")).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("doc_id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(None).cast("binary").alias("key"),
        F.encode("text", "UTF-8").alias("value"),
        F.array(header("Security-Label", label)).alias("headers"),
    )


def topic_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic request per order, by its customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("consumer_id"),
        F.concat(
            F.when(F.col("o_orderkey") % 3 == 0, " t").otherwise("t"), (F.col("o_orderkey") % 100).cast("string")
        ).alias("topic"),
    )


def consumer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One consumer document per order: its customer is the producer, its lines the products."""
    key = F.col("o_orderkey")

    def product(line: Column) -> Column:
        number = line["l_linenumber"]
        configuration = F.struct(
            F.when(number != 3, "interval").alias("scheduleType"),
            F.when(number == 4, "PT5M").when(number == 5, "soon").alias("scheduleExpression"),
            F.concat(F.lit("in/"), line["l_partkey"].cast("string")).alias("destination"),
        )
        return F.struct(
            F.concat(F.lit("P"), line["l_partkey"].cast("string")).alias("name"),
            F.when(number != 6, F.concat(F.lit("T"), line["l_suppkey"].cast("string"))).alias("topic"),
            F.concat(F.lit("out/"), line["l_partkey"].cast("string")).alias("source"),
            F.when(line["l_returnflag"] == "A", "Topic").when(line["l_returnflag"] == "N", "file").alias("type"),
            F.when(number != 7, F.array(configuration)).alias("configurations"),
        )

    producer = F.struct(
        F.when(key % 17 != 0, F.concat(F.lit("Cust #"), F.col("o_custkey").cast("string"))).alias("name"),
        F.when(key % 2 == 0, F.concat(F.lit("https://h"), F.col("o_custkey").cast("string")))
        .otherwise(F.concat(F.lit("h"), F.col("o_custkey").cast("string")))
        .alias("host"),
        F.when(key % 19 == 0, -1).when(key % 4 == 0, 9000).alias("port"),
        F.when(key % 5 == 0, True).alias("tls"),
        F.when(key % 23 != 0, F.concat(F.lit("id"), F.col("o_custkey").cast("string"))).alias("idpClientId"),
        F.transform("lines", product).alias("products"),
    )
    document = F.to_json(
        F.struct(F.concat(F.lit("o"), key.cast("string")).alias("clientId"), F.array(producer).alias("producers"))
    )
    return order_lines(spark, sf_dir).select(F.from_json(document, CONSUMER_DOCUMENT).alias("d")).select("d.*")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: the id is the sequence, the text the bytes; beside every 41st there is an empty file."""
    docs = table(spark, sf_dir, "documents")
    empty = docs.where("doc_id % 41 = 0").withColumn("doc_id", F.col("doc_id") + 1_000_000_000).withColumn("text", F.lit(""))
    return docs.unionByName(empty).select(
        F.col("doc_id").alias("file_sequence_id"),
        F.concat("source", F.lit("/"), "lang", F.lit("-doc"), F.col("doc_id").cast("string"), F.lit(".txt")).alias(
            "file_name"
        ),
        F.encode("text", "UTF-8").alias("content"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as tagged messages on one topic per type."""
    return as_event_messages(table(spark, sf_dir, "events"))


def as_event_messages(events: DataFrame) -> DataFrame:
    level = F.when(F.col("value") >= 20, "high").otherwise("low")
    label = F.concat(
        F.lit("level="), level, F.lit(",home="), (F.col("user_id") % 5).cast("string")
    )
    return events.select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"),
        F.encode("props", "UTF-8").alias("value"),
        F.array(
            header("Security-Label", F.when(F.col("event_id") % 100 != 0, label).otherwise("level")),
            header("Content-Type", F.lit("application/json")),
        ).alias("headers"),
    )


EVENT_POLICY = [
    ("clicks", "click", "e-high", [("level", "high")]),
    ("views", "VIEW", "e-high", [("level", "high")]),
    ("views", "VIEW", "e-home", [("level", "low"), ("home", "3")]),
    ("errors", "error", "e-all", []),
]


#: What the policy is changed to in mid-stream: one consumer loses a topic, one gains one, one gets other attributes.
LATER_POLICY = [
    ("clicks", "click", "e-high", [("level", "low")]),
    ("views", "VIEW", "e-home", [("level", "low"), ("home", "3")]),
    ("errors", "error", "e-all", []),
    ("errors", "error", "e-home", [("home", "1")]),
]


def event_grants(spark: SparkSession, policy: list = EVENT_POLICY) -> DataFrame:
    products = [
        {"name": p, "topic": t, "consumers": [{"idpClientId": c, "attributes": [{"name": n, "value": v} for n, v in a]}]}
        for p, t, c, a in policy
    ]
    text = json.dumps({"clientId": "owner", "producers": [{"name": "p-1", "products": products}]})
    return _grants_of(spark, text)


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with the digest of their payload: damaged every 97th, absent every 89th, upper case every 3rd."""
    base = messages(spark, sf_dir)
    digest = F.sha2("value", 256)
    stated = (
        F.when(F.col("offset") % 97 == 0, F.sha2(F.concat("value", F.lit("x").cast("binary")), 256))
        .when(F.col("offset") % 89 == 0, " ")
        .when(F.col("offset") % 3 == 0, F.upper(digest))
        .otherwise(digest)
    )
    return base.withColumn("payload_checksum", stated).withColumn("checksum_algorithm", F.lit("SHA-256"))


def rdf_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as RDF: two statements each, some repeated, some in a graph, some broken."""
    key = F.col("c_custkey").cast("string")
    subject = F.concat(F.lit("<http://example.org/c/"), key, F.lit(">"))
    name = F.concat(subject, F.lit(' <http://example.org/name> "'), "c_name", F.lit('"'))
    nation = F.concat(
        subject, F.lit(" <http://example.org/nation>\t<http://example.org/n/"), F.col("c_nationkey").cast("string"), F.lit(">")
    )
    graph = F.when(F.col("c_custkey") % 7 == 0, " <http://example.org/g>").otherwise("")
    typed = F.when(F.col("c_custkey") % 3 == 0, "^^<http://www.w3.org/2001/XMLSchema#string>").otherwise("")
    broken = F.when(F.col("c_custkey") % 10 == 0, " <http://example.org/<<value>>> .").otherwise("")
    repeated = F.when(F.col("c_custkey") % 6 == 0, F.concat(F.lit("# again\n"), nation, graph, F.lit(" ."))).otherwise("")
    payload = F.concat(name, typed, graph, F.lit(" . "), nation, graph, F.lit(" .\n"), repeated, broken)
    return table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("c_custkey").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(None).cast("binary").alias("key"),
        F.encode(payload, "UTF-8").alias("value"),
        F.array(
            header(
                "Content-Type",
                F.when(F.col("c_custkey") % 14 == 0, "application/n-triples")
                .when(F.col("c_custkey") % 11 == 0, "text/turtle")
                .otherwise("application/n-quads"),
            )
        ).alias("headers"),
    )


def file_reference_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as file references, good and bad."""
    doc = F.col("doc_id").cast("string")
    kind = F.element_at(F.array(*[F.lit(k) for k in ("S3", "AZURE", "GCP", "LOCAL")]), (F.col("doc_id") % 4 + 1).cast("int"))
    good = F.concat(
        F.lit('{"sourceType":"'), kind, F.lit('","storageContainer":"box","path":"/d/'), doc, F.lit('.txt","extra":1}')
    )
    case = F.col("doc_id") % 20
    text = (
        F.when(case == 1, "not json")
        .when(case == 2, "null")
        .when(case == 3, '{"sourceType":"S3","storageContainer":"box","path":"  "}')
        .when(case == 5, '{"sourceType":"s3","storageContainer":"box","path":"a"}')
        .when(case == 6, '{"sourceType":"GCP","storageContainer":" ","path":"a"}')
        .when(case == 7, '{"storageContainer":"box","path":"a"}')
        .when(case == 9, F.lit(None).cast("string"))
        .when(case == 10, "[]")
        .otherwise(good)
    )
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("doc_id").alias("offset"),
        F.encode(text, "UTF-8").alias("value"),
    )


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What exists of the referenced objects: not every 8th; every 12th is a directory."""
    doc = F.col("doc_id").cast("string")
    kind = F.col("doc_id") % 4
    prefix = F.when(kind == 0, "s3a://box").when(kind == 1, "abfss://box@acct.dfs.core.windows.net").when(kind == 2, "gs://box").otherwise("file:")
    return table(spark, sf_dir, "documents").where("doc_id % 8 <> 0").select(
        F.concat(prefix, F.lit("/d/"), doc, F.lit(".txt")).alias("uri"),
        (F.col("doc_id") % 12 != 3).alias("is_file"),
        F.col("n_chars").alias("size"),
    )
