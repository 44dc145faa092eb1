import pytest
from pyspark.sql import functions as F

from covenant.functions.headers import header_all, header_first, header_last, select_headers, shared_header_names
from covenant.functions.labels import attributes_allow, parse_label, refusal_reason
from covenant.schemas import ATTRIBUTES

LABEL = "country=nl,grade=amber,sector=health"

CASES = [
    (None, {}),
    ("", {}),
    ("   \t  ", {}),
    (" ", {}),
    ("A=B", {"A": "B"}),
    (" country : nl ", {"COUNTRY": "NL"}),
    ("A=B,C=D", {"A": "B", "C": "D"}),
    (", a=b , , c : d , ", {"A": "B", "C": "D"}),
    ("A=1,a=2", {"A": "2"}),
    ("A=1,B=1,a=2,b=3,A=4", {"A": "4", "B": "3"}),
    ("a=b:c", {"A": "B:C"}),
    ("k:=v", {"K": "=V"}),
    ("a\u0001=\u0002b", {"A": "B"}),
    ("A", None),
    ("=B", None),
    (":B", None),
    ("A=", None),
    ("A:", None),
    ("A=B,C", None),
    (" = b", None),
    (" ", None),
]


def test_parse_label(spark):
    rows = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "i int, t string")
    for row in rows.select("i", parse_label(F.col("t")).alias("l")).collect():
        text, expected = CASES[row["i"]]
        assert row["l"]["malformed"] == (expected is None), text
        assert {e["key"]: e["value"] for e in row["l"]["entries"]} == (expected or {}), text
        assert len(row["l"]["entries"]) == len(expected or {})


ATTRIBUTE_CASES = [
    (None, None),
    ([], None),
    ([("country", "NL")], None),
    ([("desk", "NORTH")], "MISSING_ATTRIBUTE"),
    ([("grade", "CRIMSON")], "VALUE_MISMATCH"),
    ([("country", "NL"), ("grade", "AMBER")], None),
    ([("country", "NL"), ("desk", "NORTH")], "MISSING_ATTRIBUTE"),
    ([("country", "NL"), ("grade", "CRIMSON")], "VALUE_MISMATCH"),
    ([None, ("country", "nl")], None),
    ([None], None),
    ([(None, "nl")], "INVALID_FILTER"),
    ([("country", None)], "INVALID_FILTER"),
    ([("country", " nl")], "VALUE_MISMATCH"),
    ([("country", "pl"), ("desk", "x")], "VALUE_MISMATCH"),
    ([("desk", "x"), ("country", "pl")], "MISSING_ATTRIBUTE"),
]


@pytest.mark.parametrize("label, bad", [(LABEL, False), (LABEL.upper(), False), ("A=", True)])
def test_attribute_rules(spark, label, bad):
    rows = spark.createDataFrame(
        [(i, label, attributes) for i, (attributes, _) in enumerate(ATTRIBUTE_CASES)], f"i int, t string, a {ATTRIBUTES}"
    ).withColumn("l", parse_label(F.col("t")))
    found = rows.select(
        "i", attributes_allow(F.col("a"), F.col("l")).alias("ok"), refusal_reason(F.col("a"), F.col("l")).alias("why")
    ).collect()
    for row in found:
        attributes, reason = ATTRIBUTE_CASES[row["i"]]
        expected = "BAD_LABEL" if bad and attributes else reason
        assert row["why"] == expected, attributes
        assert row["ok"] == (expected is None), attributes


def test_headers(spark):
    pairs = [("a", "1"), ("Content-Type", "x"), ("A", "2"), ("content-type", "y"), ("Content-Type", "z")]
    rows = spark.createDataFrame([(pairs,)], "h array<struct<key:string,value:string>>")
    h = F.col("h")
    row = rows.select(
        header_first(h, "CONTENT-TYPE").alias("first"),
        header_first(h, "none").alias("absent"),
        header_last(h, "content-type").alias("last"),
        header_last(h, "none").alias("no_last"),
        header_all(h, "a").alias("all"),
        select_headers(h, shared_header_names("Content-Type^A")).alias("some"),
        select_headers(h).alias("every"),
    ).first()
    assert (row["first"], row["absent"], row["last"], row["no_last"], row["all"]) == ("x", "", "z", None, ["1", "2"])
    assert [tuple(p) for p in row["some"]] == [("Content-Type", "x"), ("A", "2"), ("Content-Type", "z")]
    assert [tuple(p) for p in row["every"]] == pairs
    assert shared_header_names("") == ("Content-Type",)
