import json

import pytest
from pyspark.sql import functions as F

from covenant.operators import federation, grants
from covenant.operators.joins import keyed_join
from covenant.schemas import GRANTS_DOCUMENT, MESSAGE


def policy(spark, products, **producer):
    document = {"clientId": "owner", "producers": [{"name": "p", "products": products, **producer}]}
    text = spark.createDataFrame([(json.dumps(document),)], "j string")
    return grants.flatten_grants(text.select(F.from_json("j", GRANTS_DOCUMENT).alias("d")).select("d.*"))


def product(topic, *consumers, name=None):
    return {
        "name": name,
        "topic": topic,
        "consumers": [
            {"idpClientId": c, "attributes": None if a is None else [{"name": n, "value": v} for n, v in a]}
            for c, a in consumers
        ],
    }


def requests(spark, *pairs):
    return spark.createDataFrame(list(pairs), "consumer_id string, topic string")


def attribute_map(df):
    return {(r["consumer_id"], r["topic"]): [(a["name"], a["value"]) for a in r["attributes"]] for r in df.collect()}


def test_places_beyond_any_small_number_and_several_documents(spark):
    names = [f"n{i}" for i in range(40_000)]
    many = policy(spark, [product("t", ("c", [(n, "1") for n in reversed(names)]))])
    found = attribute_map(grants.attributes_for(requests(spark, ("c", "t")), many))
    assert [n for n, _ in found["c", "t"]] == list(reversed(names))
    documents = [
        (i, json.dumps({"clientId": "o", "producers": [{"name": "p", "products": [product("t", ("c", [(n, "1")]))]}]}))
        for i, n in ((0, "zz"), (1, "aa"), (2, "mm"))
    ]
    text = spark.createDataFrame(documents, "document bigint, j string").repartition(3)
    several = grants.flatten_grants(text.select("document", F.from_json("j", GRANTS_DOCUMENT).alias("d")).select("document", "d.*"))
    found = attribute_map(grants.attributes_for(requests(spark, ("c", "t")), several))
    assert [n for n, _ in found["c", "t"]] == ["zz", "aa", "mm"]


def test_attributes_for(spark):
    rows = policy(
        spark,
        [
            product("telemetry.raw", ("client-a", [("tenant", "alpha")])),
            product("other", ("client-a", [("zone", "1"), ("tenant", "alpha")]), name="TELEMETRY.RAW"),
            product("Telemetry.Raw", ("client-b", None)),
        ],
    )
    asked = requests(
        spark,
        ("client-a", "telemetry.raw"),
        ("client-a", "none"),
        ("client-c", "telemetry.raw"),
        ("client-b", "telemetry.raw"),
        ("CLIENT-A", "telemetry.raw"),
        ("client-a", " telemetry.raw"),
    )
    assert attribute_map(grants.attributes_for(asked, rows)) == {
        ("client-a", "telemetry.raw"): [("tenant", "alpha"), ("zone", "1")],
        ("client-a", "none"): [],
        ("client-c", "telemetry.raw"): [],
        ("client-b", "telemetry.raw"): [],
        ("CLIENT-A", "telemetry.raw"): [],
        ("client-a", " telemetry.raw"): [],
    }


@pytest.mark.parametrize("salt", [False, True])
def test_topic_access(spark, salt):
    rows = policy(spark, [product("dp1", ("CLIENT-123", [])), product("dp2", ("c2", None), name="dp3")])
    asked = requests(
        spark, ("CLIENT-123", "dp1"), ("CLIENT-123", " DP1 "), ("client-123", "dp1"), ("CLIENT-123", "dp2"), ("c2", "dp3")
    )
    allowed = {tuple(r) for r in grants.has_topic_access(asked, rows, salt=salt).collect()}
    assert allowed == {("CLIENT-123", "dp1"), ("CLIENT-123", " DP1 ")}
    denied = {r["details"] for r in grants.has_topic_access(asked, rows, denied=True, salt=salt).collect()}
    assert "Topic (dp1) is not valid for client (client-123)." in denied and len(denied) == 3
    known = {r["consumer_id"] for r in grants.known_consumer(asked, rows, salt=salt).collect()}
    assert known == {"CLIENT-123", "c2"}


def test_empty_documents(spark):
    for document in ({}, {"producers": None}, {"producers": [None]}, {"producers": [{"products": [None, {"topic": "t"}]}]}):
        text = spark.createDataFrame([(json.dumps(document),)], "j string")
        rows = grants.flatten_grants(text.select(F.from_json("j", GRANTS_DOCUMENT).alias("d")).select("d.*"))
        assert rows.count() == 0
        assert grants.has_topic_access(requests(spark, ("c", "t")), rows).count() == 0


def label_messages(spark, labels, topic="knowledge"):
    rows = [(topic, 0, i, None, None, b"x", [("Security-Label", label)]) for i, label in enumerate(labels)]
    return spark.createDataFrame(rows, MESSAGE)


# Label counts of the sample inputs: file, rows per nationality.
SAMPLES = [
    ({"GBR": 23, "US": 12, "AUS": 4, "NZ": 1}, 23, 12),
    ({"GBR": 8, "US": 2}, 8, 2),
    ({"GBR": 13, "US": 4, "AUS": 2, "NZ": 1}, 13, 4),
    ({"GBR": 27 * 50, "US": 8 * 50, "AUS": 9 * 50, "NZ": 3 * 50, "FRA": 30 * 50, "IRL": 23 * 50}, 1350, 400),
]


@pytest.mark.parametrize("counts, gbr, us", SAMPLES)
def test_sample_counts(spark, counts, gbr, us):
    labels = [f"nationality={n}" for n, number in counts.items() for _ in range(number)]
    rows = policy(
        spark,
        [product("Knowledge", ("g", [("nationality", "gbr")]), ("u", [("Nationality", "US")]), ("a", None))],
    )
    sent = federation.delivered_counts(federation.federate(label_messages(spark, labels), rows))
    assert {r["consumer_id"]: r["messages"] for r in sent.collect()} == {"g": gbr, "u": us, "a": len(labels)}


def test_bad_labels(spark):
    messages = label_messages(spark, ["a=1", "broken", ""])
    rows = policy(spark, [product("knowledge", ("open", []), ("strict", [("a", "1")]))])
    sent = {(r["consumer_id"], r["offset"]) for r in federation.federate(messages, rows).collect()}
    assert sent == {("open", 0), ("open", 1), ("open", 2), ("strict", 0)}
    why = {
        r["offset"]: r["reason"]
        for r in federation.federate_decisions(messages, rows).where("consumer_id = 'strict'").collect()
    }
    assert why == {0: None, 1: "BAD_LABEL", 2: "MISSING_ATTRIBUTE"}
    with pytest.raises(Exception, match="malformed security label"):
        federation.federate(messages, rows, on_bad_label="fail").collect()


def test_custom_predicate(spark):
    messages = label_messages(spark, ["a=1,level=3", "a=1,level=1", "a=1"])
    rows = policy(spark, [product("knowledge", ("c", [("a", "1")]))])
    sent = federation.federate(
        messages, rows, predicate=lambda label, attributes: F.coalesce(label("level").cast("int") >= 2, F.lit(False))
    )
    assert [r["offset"] for r in sent.collect()] == [0]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("string").alias("k")
    )
    right = spark.range(0, 40, 1).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))
    right = right.unionByName(right.where("v > 60"))
    found = keyed_join(left, right, ["k"], how=how, spread=["id"], salt=True)
    assert sorted(map(tuple, found.select("id", "k").collect())) == sorted(
        map(tuple, left.join(right, "k", how).select("id", "k").collect())
    )
    assert found.columns == left.columns + (["v"] if how in ("inner", "left") else [])


def test_joins_run_nothing_before_they_are_used(spark):
    rows = spark.range(100).select("id", F.raise_error(F.lit("was run")).cast("string").alias("text"))
    joined = keyed_join(rows, spark.range(50).select("id"), ["id"], spread=["id"])
    assert joined.columns == ["id", "text"]


def test_plan_digests_once_per_message_below_the_fan_out(spark):
    from covenant.plans.outbound import outbound_messages

    messages = spark.read.schema(MESSAGE).parquet(_stored(spark, label_messages(spark, ["a=1"])))
    rows = policy(spark, [product("knowledge", ("c", [("a", "1")]))])
    plan = outbound_messages(messages, rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Inner") < plan.index("sha2") < plan.index("LeftSemi")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def _stored(spark, df):
    from covenant.session import scratch_path

    path = scratch_path(spark, "plan")
    df.write.parquet(path)
    return path


def test_a_hot_key_is_spread(spark):
    left = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("string").alias("k")
    )
    right = spark.range(-1, 6000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = keyed_join(left, right, ["k"], spread=["id"], salt=True)
        sizes = [r["count"] for r in joined.where("k = '-1'").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 2000 and max(sizes) <= 1500 and joined.count() == 6000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_routing_reads_no_payload(spark):
    from harness import views

    from covenant.sources.messages import security_label

    rows = security_label(views.messages(spark, "/root/testdata/sf0.001"))
    plan = federation.federate(rows, views.grants(spark))._jdf.queryExecution().executedPlan().toString()
    assert "text:string" not in plan and "doc_id:bigint" in plan


def test_lists_of_some_topics_without_order(spark):
    fields = "product string, topic string, consumer_id string, position struct<document:bigint>, has_attribute boolean, attribute_name string, attribute_value string"
    given = [
        ("p", "T", "c", (1,), True, "b", "2"),
        ("q", "t", "c", (0,), True, "a", "1"),
        ("q", "t", "c", (5,), True, "b", "2"),
        ("t", "x", "c", (2,), True, None, "3"),
        ("r", "t", "d", (3,), False, None, None),
        ("r", "u", "d", (3,), True, "z", "1"),
        ("t", "u", "e", (4,), True, "z", None),
        ("t", "t", None, (4,), True, "z", "9"),
    ]
    table = spark.createDataFrame(given, fields)
    topics = spark.createDataFrame([("t",), (None,), ("v",)], "topic_key string")
    found = {(r["consumer_id"], r["topic_key"]): (r["granted"], [tuple(a) for a in r["attributes"]]) for r in grants.consumer_topics(table, topics=topics, ordered=False).collect()}
    assert found == {
        ("c", "t"): (True, [(None, "3"), ("a", "1"), ("b", "2")]),
        ("d", "t"): (True, []),
        ("e", "t"): (False, [("z", None)]),
    }
    every = {(r["consumer_id"], r["topic_key"]): (r["granted"], {tuple(a) for a in r["attributes"]}) for r in grants.consumer_topics(table).collect()}
    assert {k: (g, set(a)) for k, (g, a) in found.items()} == {k: v for k, v in every.items() if k[1] == "t"}
