"""Fan-out by rule and label classes against the plain one."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from covenant.operators.federation import federate
from covenant.operators.grants import flatten_grants
from covenant.operators.rules import accepted_classes, federate_classes, label_class, rule_classes
from covenant.schemas import GRANTS_DOCUMENT, MESSAGE

VALUES = {"shade": "red green blue".split(), "size": "s m l".split(), "made": "here there".split()}


def grants(spark, seed=1):
    rng = random.Random(seed)

    def attribute(name):
        return {"name": rng.choice([name, name.upper()]), "value": rng.choice(VALUES[name])}

    def consumer(i):
        names = rng.sample(sorted(VALUES), rng.randrange(4))
        listed = [attribute(n) for n in names]
        if i % 13 == 0:
            listed.append({"name": "shade", "value": None})
        if i % 11 == 0:
            listed.append({"name": "never", "value": "seen"})
        return {"idpClientId": f"c{i}", "attributes": listed if i % 17 else None}

    products = [
        {"name": f"p{t}", "topic": f"Topic{t}", "consumers": [consumer(i) for i in range(t, 60, 2)]} for t in range(3)
    ] + [{"name": "topic1", "topic": "other", "consumers": [consumer(i) for i in range(5)]}]
    text = spark.createDataFrame([(json.dumps({"producers": [{"products": products}]}),)], "j string")
    return flatten_grants(text.select(F.from_json("j", GRANTS_DOCUMENT).alias("d")).select("d.*"))


def messages(spark, seed=2, malformed=True):
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        parts = [f"{n}{rng.choice('=:')}{rng.choice(VALUES[n])}" for n in rng.sample(sorted(VALUES), rng.randrange(4))]
        label = rng.choice([",", " , "]).join(parts)
        if malformed and i % 20 == 0:
            label = "shade"
        headers = [] if i % 23 == 0 else [("Security-Label", label)]
        rows.append((rng.choice(["topic0", "TOPIC1", "Topic2", "nobody"]), i % 3, i, None, None, f"v{i}".encode(), headers))
    return spark.createDataFrame(rows, MESSAGE)


def found(df):
    return Counter((r["consumer_id"], r["topic"], r["offset"], bytes(r["value"])) for r in df.collect())


@pytest.mark.parametrize("salt", [False, True])
def test_same_rows_as_the_plain_fan_out(spark, salt):
    plain, classes = federate(messages(spark), grants(spark)), federate_classes(messages(spark), grants(spark), salt=salt)
    assert set(plain.columns) == set(classes.columns)
    assert found(classes) == found(plain) and sum(found(plain).values()) > 300


def test_requests_shape_and_predicate(spark):
    requests = spark.createDataFrame([("c1", " topic1 "), ("c2", "topic2"), ("c2", "nobody"), ("x", "topic1")], "consumer_id string, topic string")
    options = [
        {"requests": requests},
        {"requests": requests, "require_topic_grant": False},
        {"shape": lambda rows: rows.withColumn("value", F.concat("value", F.lit(b"!")))},
        {"predicate": lambda look, attributes: F.coalesce(look("size") != "M", F.lit(True)) & (F.size(attributes) < 3)},
    ]
    for given in options:
        assert found(federate_classes(messages(spark), grants(spark), **given)) == found(federate(messages(spark), grants(spark), **given))


def test_a_bad_label_stops_the_job_where_asked(spark):
    assert found(federate_classes(messages(spark, malformed=False), grants(spark), on_bad_label="fail"))
    with pytest.raises(Exception, match="malformed security label"):
        federate_classes(messages(spark), grants(spark), on_bad_label="fail").collect()


def test_classes_are_fewer_than_consumers_and_are_judged_once(spark):
    rows = [(f"c{i}", "t", [("Home", "gb"), ("Team", str(i % 2))]) for i in range(40)] + [
        (f"d{i}", "t", [("team", str(i % 2)), ("HOME", "GB")]) for i in range(40)
    ]
    rules = rule_classes(spark.createDataFrame(rows, "consumer_id string, topic_key string, attributes array<struct<name:string,value:string>>"))
    assert rules.select("rule_class").distinct().count() == 2
    labels = spark.createDataFrame(
        [("t", ([("HOME", "GB"), ("TEAM", "1")], False)), ("t", ([("TEAM", "1"), ("HOME", "GB")], False)), ("t", ([], True))],
        "topic_key string, label struct<entries:array<struct<key:string,value:string>>,malformed:boolean>",
    ).withColumn("label_class", label_class(F.col("label")))
    once = labels.dropDuplicates(["label_class"])
    assert once.count() == 2
    got = accepted_classes(once, rules.dropDuplicates(["rule_class"])).collect()
    assert len(got) == 1


def test_empty_tables(spark):
    assert federate_classes(messages(spark).limit(0), grants(spark)).collect() == []
    assert federate_classes(messages(spark), grants(spark).limit(0)).collect() == []
