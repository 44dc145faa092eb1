import hashlib

import pytest
from pyspark.sql import functions as F

from covenant.functions.exchange import exchange_metadata
from covenant.functions.headers import DEAD_LETTER_REASON
from covenant.functions.rdf import normalise_rdf, payload_kind, quads
from covenant.functions.text import compound_topic, target_topic
from covenant.operators import counts, messages
from covenant.schemas import ENVELOPE, MESSAGE


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def envelope(offset, good=True, checksum=None):
    data = f"payload {offset}".encode()
    stated = checksum if checksum is not None else sha(data if good else data + b"x")
    return ("t", 0, offset, None, b"k", data, [], stated, "SHA-256")


def good(n):
    return envelope(n)


def bad(n):
    return envelope(n, good=False)


@pytest.mark.parametrize(
    "rows, action, delivered, next_offset",
    [
        ([good(1), good(2), good(3)], "SKIP", 3, 4),
        ([], "SKIP", 0, None),
        ([bad(5), good(6)], "SKIP", 1, 7),
        ([bad(5)], "LOG_ONLY", 1, 6),
        ([bad(5)], "NOT_A_REAL_ACTION", 0, 6),
        ([bad(5)], None, 0, 6),
        ([envelope(4, checksum=" "), envelope(5, checksum=sha(b"payload 5").upper())], " skip ", 2, 6),
    ],
)
def test_checksum_actions(spark, rows, action, delivered, next_offset):
    df = spark.createDataFrame(rows, ENVELOPE)
    assert messages.verify_checksum(df, action).count() == delivered
    following = messages.next_offsets(df, ["topic", "partition"]).collect()
    assert [r["next_offset"] for r in following] == ([] if next_offset is None else [next_offset])


def test_checksum_abort(spark):
    df = spark.createDataFrame([bad(5), good(6)], ENVELOPE)
    with pytest.raises(Exception, match="checksum mismatch on topic t offset 5"):
        messages.verify_checksum(df, "abort").collect()
    with pytest.raises(messages.ChecksumMismatch):
        messages.abort_on_mismatch(messages.with_checksum_status(df))
    messages.abort_on_mismatch(messages.with_checksum_status(df.where("offset = 6")))


@pytest.mark.parametrize(
    "use",
    [
        lambda df, path: df.select("topic", "offset").collect(),
        lambda df, path: df.count(),
        lambda df, path: df.select("offset", "value").write.parquet(path),
        lambda df, path: df.drop("checksum_status", "actual_checksum").agg(F.max("offset")).first(),
    ],
)
def test_abort_holds_whichever_columns_are_used(spark, work, use):
    df = spark.createDataFrame([good(4), bad(5), good(6)], ENVELOPE)
    with pytest.raises(Exception, match="checksum mismatch on topic t offset 5"):
        use(messages.verify_checksum(df, "ABORT"), f"{work}/out")
    assert messages.verify_checksum(df.where("offset <> 5"), "ABORT").count() == 2


def test_report_values(spark):
    df = spark.createDataFrame([good(1), bad(2), envelope(3, checksum="")], ENVELOPE)
    rows = {
        r["offset"]: r
        for r in messages.checksum_report(messages.with_checksum_status(df), "SKIP", F.lit("hub")).collect()
    }
    assert [rows[i]["match"] for i in (1, 2, 3)] == [
        "PASS",
        "FAIL -- exception",
        "ABSENT -- no checksum (tolerated)",
    ]
    assert [rows[i]["output_bytes"] for i in (1, 2, 3)] == [9, 0, 9]
    assert [rows[i]["algorithm"] for i in (1, 2, 3)] == ["SHA-256", "SHA-256", "none"]
    assert rows[1]["org_name"] == "hub" and rows[2]["exception"] and rows[1]["exception"] is None
    kept = messages.checksum_report(messages.with_checksum_status(df), "LOG_ONLY", F.lit("hub"))
    assert [r["output_bytes"] for r in kept.orderBy("offset").collect()] == [9, 9, 9]
    total = messages.checksum_summary(kept, with_totals=True).where("topic IS NULL AND org_name IS NULL").first()
    assert (total["ok"], total["mismatch"], total["unchecked"], total["input_bytes"]) == (1, 1, 1, 27)


JSON = '{"orgName":"acme","schemaType":"csv","productType":"wind"}'
METADATA = [
    ([("orgName", " gridco "), ("schemaType", "load"), ("productType", "week7")], ("gridco", "load", "week7")),
    ([("ORGNAME", "a"), ("orgname", "b")], ("b", None, None)),
    ([("metadata", JSON)], ("acme", "csv", "wind")),
    ([("metadata", "")], ("hub", None, None)),
    ([("metadata", "plain text")], ("hub", None, None)),
    ([("metadata", '{"other":1}')], ("hub", None, None)),
    ([("metadata", '{"orgName":')], ("hub", None, None)),
    ([("Security-Label", "COUNTRY=NL,ORGANISATION_TYPE=AGRI")], ("AGRI", None, None)),
    ([("Security-Label", "ORGANISATION=EDU")], ("EDU", None, None)),
    ([("Security-Label", "ORGANISATION=EDU,ORGANISATION_TYPE=AGRI")], ("AGRI", None, None)),
    ([("orgName", "gridco"), ("Security-Label", "ORGANISATION_TYPE=AGRI")], ("gridco", None, None)),
    ([("Security-Label", "@@@ not a label @@@")], ("hub", None, None)),
    ([("Security-Label", "A=B"), ("security-label", "ORGANISATION=EDU")], ("EDU", None, None)),
    ([("orgName", "first"), ("m", '{"schemaType":"csv"}'), ("schemaType", "late")], ("first", "csv", None)),
    ([("schemaType", "load"), ("m", '{"orgName":null,"schemaType":null}'), ("orgName", "late")], ("hub", "load", None)),
    ([("m", '{"x":1}'), ("m", ' {"productType": 7}')], ("hub", None, "7")),
    ([], ("hub", None, None)),
]


def test_exchange_metadata(spark):
    rows = spark.createDataFrame(
        [(i, headers) for i, (headers, _) in enumerate(METADATA)], "i int, h array<struct<key:string,value:string>>"
    )
    for row in rows.select("i", exchange_metadata(F.col("h"), F.lit("hub")).alias("m")).collect():
        headers, expected = METADATA[row["i"]]
        assert tuple(row["m"]) == expected, headers


def test_envelope(spark):
    headers = [("Security-Label", "a=1"), ("Content-Type", "text/plain"), ("content-type", "no")]
    df = spark.createDataFrame(
        [("t", 0, 3, None, None, b"raw \xff bytes", headers), ("t", 0, 4, None, b"k", b"", headers)], MESSAGE
    )
    first, second = messages.to_envelope(df).orderBy("offset").collect()
    assert bytes(first["key"]) == b"Missing Key - 3 t" and bytes(second["key"]) == b"k"
    assert [tuple(h) for h in first["headers"]] == [("Content-Type", "text/plain")]
    assert bytes(first["value"]) == b"raw \xff bytes" and first["payload_checksum"] == sha(b"raw \xff bytes")
    assert second["payload_checksum"] == sha(b"") and second["checksum_algorithm"] == "SHA-256"
    shouted = messages.to_envelope(df, payload=lambda value, h: F.upper(value.cast("string")).cast("binary"))
    assert bytes(shouted.where("offset = 3").first()["value"]).startswith(b"RAW")


S, P, G = "<http://e/s>", "<http://e/p>", "<http://e/g>"
XSD = "<http://www.w3.org/2001/XMLSchema#"
RDF_CASES = [
    (f'{S} {P} "a \\"b\\" c" . {S} {P} _:b1 .', "application/n-triples", 2),
    (f"{S} {P} {S} . {S} {P} {S} .", "application/n-quads", 1),
    (f"{S} {P} {S} {G} .\n# note\n_:x {P} \"v\"@en-GB {G} .  # end", "application/n-quads", 2),
    (f"{S} {P} {S} {G} .", "application/n-triples", None),
    (f'{S} {P} "1"^^{XSD}integer> . {S} {P} "京B"^^{XSD}string> .', "application/n-triples", 2),
    ("<http://e/fake#<<your specific value>>> <http://e/p> <http://e/o> .", "application/n-triples", None),
    (f"{S} {P} {S} . and more", "application/n-quads", None),
    (f"{S} {P} {S} . <http://e/left-over>", "application/n-quads", None),
    (f"{S} {P} {S}", "application/n-quads", None),
    ("plain prose", "text/plain", None),
    ("", "application/n-quads", 0),
    ("  \n# only a comment", "application/n-quads", None),
    (f"{S} {P} {S} .", "text/turtle", None),
    (f"{S} {P} {S} .", "application/RDF-Patch", None),
    (f'{S} {P} "{"x" * 50000}\\n{"y" * 50000}" .', "application/n-quads", 1),
    ("<http://e/" + "a" * 100000, "application/n-quads", None),
    (f'{S} {P} "a\u0001b" .', "application/n-quads", 1),
]


def test_rdf(spark):
    rows = spark.createDataFrame(
        [(i, text.encode(), [("Content-Type", kind)]) for i, (text, kind, _) in enumerate(RDF_CASES)],
        "i int, value binary, headers array<struct<key:string,value:string>>",
    )
    text = F.col("value").cast("string")
    kind = F.get("headers", F.lit(0))["value"]
    found = rows.select(
        "i", quads(text, kind).alias("q"), normalise_rdf(F.col("value"), F.col("headers")).alias("n")
    ).collect()
    for row in found:
        source, _, expected = RDF_CASES[row["i"]]
        assert (None if row["q"] is None else len(row["q"])) == expected, source[:80]
        if expected is None:
            assert bytes(row["n"]).decode() == source
        else:
            lines = bytes(row["n"]).decode().splitlines()
            assert lines == sorted(lines) and len(lines) == expected
    by_case = {r["i"]: r for r in found}
    assert [tuple(q) for q in by_case[0]["q"]] == [(S, P, '"a \\"b\\" c"', None), (S, P, "_:b1", None)]
    assert [q["graph"] for q in by_case[2]["q"]] == [G, G]
    assert {q["object"] for q in by_case[4]["q"]} == {f'"1"^^{XSD}integer>', '"京B"'}
    assert by_case[16]["q"][0]["object"] == '"a\u0001b"'
    kinds = rows.select("i", payload_kind(F.col("headers")).alias("k")).collect()
    assert {r["i"] for r in kinds if r["k"] == "patch"} == {13}


def test_target_topics(spark):
    row = spark.range(1).select(
        target_topic(F.lit("t"), F.lit("out"), F.lit("s")).alias("given"),
        target_topic(F.lit("t"), F.lit(""), F.lit("s")).alias("empty"),
        target_topic(F.lit("t"), F.lit(None).cast("string"), F.lit("s")).alias("null"),
        compound_topic(F.lit("t"), F.lit("p"), F.lit("s")).alias("compound"),
        compound_topic(F.lit("t"), F.lit(""), F.lit("s")).alias("plain"),
    ).first()
    assert tuple(row) == ("out", "s-t", "s-t", "p-s-t", "s-t")


def test_dead_letters_and_counts(spark):
    rejected = spark.createDataFrame(
        [("t", None, "WHY"), ("u", [("a", "1")], "BECAUSE")],
        "topic string, headers array<struct<key:string,value:string>>, reason string",
    )
    last = {r["topic"]: tuple(r["headers"][-1]) for r in messages.dead_letters(rejected).collect()}
    assert last == {"t": (DEAD_LETTER_REASON, "WHY"), "u": (DEAD_LETTER_REASON, "BECAUSE")}
    expected = spark.createDataFrame([("t", 1), ("u", 2), ("none", 0), ("gone", 1)], "topic string, expected bigint")
    ok = {r["topic"]: r["ok"] for r in counts.verify_counts(rejected, expected).collect()}
    assert ok == {"t": True, "u": False, "none": True, "gone": False}


def test_ordered_delivery_splits_a_hot_topic(spark):
    rows = spark.range(4000).select(
        F.lit("c").alias("consumer_id"), F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset")
    )
    ordered = counts.ordered_delivery(rows.orderBy(F.rand(3)), 4)
    parts = [[r["offset"] for r in part] for part in ordered.rdd.glom().collect()]
    assert [o for part in parts for o in part] == list(range(4000))
    assert max(map(len, parts)) < 2000
