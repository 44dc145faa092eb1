import json

from pyspark.sql import functions as F

from covenant.functions.naming import clean_host, clean_server_name, normalise_schedule
from covenant.operators import feeds, grants, snapshots
from covenant.schemas import CONSUMER_DOCUMENT
from covenant.sources.documents import parse_documents, read_feeds_config, read_grants


def documents(spark, *producers):
    text = json.dumps({"clientId": "me", "producers": list(producers)})
    return parse_documents(spark.createDataFrame([(text,)], "json string"), CONSUMER_DOCUMENT)


def product(topic="t", type="topic", configurations=({},), **more):
    return {"topic": topic, "type": type, "configurations": list(configurations), **more}


def producer(*products, **more):
    return {"name": "Server 1!", "host": "https://h.example", "idpClientId": "client", "products": list(products), **more}


def test_feeds(spark):
    document = documents(
        spark,
        producer(
            product("a", "TOPIC", [{"scheduleType": "cron", "scheduleExpression": "0 0 * * * *"}, {"scheduleExpression": "x"}]),
            product("b", "File", [{"destination": "in/", "scheduleExpression": "PT5M"}], source="out/b"),
            port=9443,
            tls=True,
        ),
    )
    rows = {r["feed_id"]: r for r in feeds.feeds(document, "node-1").collect()}
    assert set(rows) == {"Server1-a", "Server1-b"}
    a, b = rows["Server1-a"], rows["Server1-b"]
    assert (a["type"], a["host"], a["port"], a["tls"], a["client_name"]) == ("topic", "h.example", 9443, True, "client")
    assert (a["schedule_type"], a["schedule_expression"], a["retries"], a["immediate"]) == ("cron", "0 0 * * * *", 5, False)
    assert (a["source_path"], a["destination"]) == (None, None)
    assert (b["source_path"], b["destination"], b["schedule_type"]) == ("out/b", "in/", None)
    assert tuple(b["effective_schedule"]) == ("interval", "PT1H")
    defaults = feeds.feeds(documents(spark, producer(product())), "node-1").first()
    assert (defaults["port"], defaults["tls"], defaults["schedule_expression"]) == (8080, False, "PT1H")


def test_feed_rejects(spark):
    document = documents(
        spark,
        None,
        producer(product(), name="  "),
        producer(product(), host=None),
        {"name": "n", "host": "h"},
        producer(product(), idpClientId=" "),
        producer(product(), port=-1),
        producer(product(), host="http://"),
        producer(product(topic=None), product(type="queue"), product(type=None), product(configurations=()), None),
        producer(product("ok")),
        producer(),
    )
    reasons = sorted(r["reason"] for r in feeds.feed_rejects(document, "n").collect())
    assert reasons == sorted(
        ["INVALID_PRODUCER"] * 3
        + ["INVALID_CONNECTION"] * 3
        + ["INVALID_PRODUCT", "UNKNOWN_TYPE", "UNKNOWN_TYPE", "NO_CONFIGURATION"]
    )
    assert [r["topic"] for r in feeds.feeds(document, "n").collect()] == ["ok"]


def test_names(spark):
    names = spark.createDataFrame([("A-b 1",), ("--",), ("",), (None,)], "n string")
    assert [r[0] for r in names.select(clean_server_name(F.col("n"))).collect()] == ["Ab1", "Producer", "Producer", "Producer"]
    hosts = spark.createDataFrame([("https://a",), ("http://b",), ("c:1",), ("HTTP://d",), (None,)], "h string")
    assert [r[0] for r in hosts.select(clean_host(F.col("h"))).collect()] == ["a", "b", "c:1", "HTTP://d", None]


def test_connections(spark):
    cases = [
        (("c", "k", "h", 1, "s1"), None),
        ((" ", "k", "h", 1, "s"), "client name is blank"),
        (("c", None, "h", 1, "s"), "client key is blank"),
        (("c", "k", "", 1, "s"), "server host is blank"),
        (("c", "k", "h", -1, "s"), "server port is negative"),
        (("c", "k", "h", 0, "s-1"), "server name is not alphanumeric"),
        (("c", "k", "h", 0, None), "server name is not alphanumeric"),
    ]
    rows = spark.createDataFrame([c for c, _ in cases], "a string, b string, c string, d int, e string")
    found = rows.select(feeds.connection_problem(*[F.col(x) for x in "abcde"]))
    assert [r[0] for r in found.collect()] == [e for _, e in cases]


SCHEDULES = [
    (None, None, ("interval", "PT1H")),
    ("interval", "PT5M", ("interval", "PT5M")),
    ("INTERVAL", "P1DT2H3.5S", ("interval", "P1DT2H3.5S")),
    ("interval", "PT", ("interval", "PT1H")),
    ("interval", "5 minutes", ("interval", "PT1H")),
    ("cron", "0 0 * * * *", ("cron", "0 0 * * * *")),
    ("cron", "*/15 0-6,22 1 JAN MON-FRI", ("cron", "*/15 0-6,22 1 JAN MON-FRI")),
    ("cron", "* * * *", ("interval", "PT1H")),
    ("cron", "61 * * * *", ("interval", "PT1H")),
    ("weird", "PT10M", ("interval", "PT1H")),
    (None, "PT10M", ("interval", "PT1H")),
]


def test_schedules(spark):
    rows = spark.createDataFrame([(i, k, e) for i, (k, e, _) in enumerate(SCHEDULES)], "i int, k string, e string")
    for row in rows.select("i", normalise_schedule(F.col("k"), F.col("e")).alias("s")).collect():
        assert tuple(row["s"]) == SCHEDULES[row["i"]][2], SCHEDULES[row["i"]]


def test_feed_diff(spark):
    schema = "feed_id string, node_id string, retries int, ord int"
    current = spark.createDataFrame([("A", "node-1", 1, 0), ("B", "node-1", 1, 0), ("K", "node-1", 2, 0), ("X", "node-2", 1, 0)], schema)
    requested = spark.createDataFrame(
        [("B", "node-1", 3, 1), ("C", "node-1", 1, 2), ("K", "node-1", 9, 3), ("K", "node-1", 2, 4), ("Y", "node-2", 1, 5)], schema
    )
    found = feeds.diff_feeds(current, requested, "node-1", order="ord").collect()
    assert {r["feed_id"]: r["action"] for r in found} == {"A": "DELETE", "B": "REPLACE", "C": "ADD", "K": "KEEP"}
    nulls = spark.createDataFrame([("a", None), ("b", 1)], "k string, v int")
    same = snapshots.snapshot_diff(nulls, nulls, ["k"])
    assert {r["action"] for r in same.collect()} == {"KEEP"}


def test_active_feeds(spark):
    rows = spark.createDataFrame([(c, c) for c in ("a", "b", "c", "d", "e")], "client_name string, feed_id string")
    status = spark.createDataFrame(
        [("a", "ACTIVE"), ("b", "REVOKED"), ("c", "active"), ("e", "ACTIVE"), ("e", "EXPIRED")], "client_id string, status string"
    )
    assert [r["client_name"] for r in grants.active_feeds(rows, status).collect()] == ["a"]


def test_documents_from_files(spark, work):
    document = {
        "clientId": "owner",
        "unknown": {"x": 1},
        "producers": [
            {"name": "p", "port": 443, "products": [product("t", consumers=[{"idpClientId": "c", "attributes": []}])]}
        ],
    }
    with open(f"{work}/grants.json", "w") as out:
        json.dump(document, out, indent=2)
    row = read_grants(spark, f"{work}/grants.json").first()
    assert (row["consumer_id"], row["topic"], row["has_attribute"]) == ("c", "t", False)
    assert read_feeds_config(spark, f"{work}/grants.json").first()["clientId"] == "owner"
