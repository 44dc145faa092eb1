import hashlib
import json

import pytest
from pyspark.sql import functions as F

from covenant.functions import naming
from covenant.operators import files, versions
from covenant.operators.ranking import number_rows

TEXT = b"Rivers bend slowly where the ground is s."
FILES = "file_sequence_id bigint, file_name string, content binary"


def sha(data):
    return hashlib.sha256(data).hexdigest()


CONTENTS = {
    42: ("dir/rivers.txt", TEXT),
    43: ("empty.txt", b""),
    44: ("exact.bin", bytes(range(16))),
    45: ("multi.txt", "añ京🙂" .encode() * 7),
    46: ("one.bin", b"z"),
}


@pytest.fixture(scope="module")
def chunks(spark):
    rows = [(k, name, data) for k, (name, data) in CONTENTS.items()]
    return files.chunk_files(spark.createDataFrame(rows, FILES), 8).cache()


def test_chunking(chunks):
    rows = [r for r in chunks.orderBy("chunk_index").collect() if r["file_sequence_id"] == 42]
    assert [r["chunk_index"] for r in rows] == list(range(7))
    assert [r["is_last_chunk"] for r in rows] == [False] * 6 + [True]
    assert b"".join(bytes(r["chunk_data"]) for r in rows[:-1]) == TEXT
    assert rows[-1]["chunk_data"] is None and rows[-1]["file_checksum"] == sha(TEXT)
    assert {(r["total_chunks"], r["file_size"], r["file_name"]) for r in rows} == {(6, 41, "rivers.txt")}
    sizes = {k: [r for r in chunks.collect() if r["file_sequence_id"] == k] for k in (43, 44)}
    assert [(r["chunk_index"], r["is_last_chunk"], r["total_chunks"]) for r in sizes[43]] == [(0, True, 0)]
    assert sorted(r["chunk_index"] for r in sizes[44]) == [0, 1, 2]


@pytest.mark.parametrize("block_chunks", [1, 2, 3, 64])
def test_round_trip(chunks, block_chunks):
    built = files.verify_files(files.assemble_files(chunks.orderBy(F.rand(5)), block_chunks)).collect()
    assert {r["file_sequence_id"] for r in built} == set(CONTENTS)
    for row in built:
        _, data = CONTENTS[row["file_sequence_id"]]
        assert (row["actual_checksum"], row["actual_size"], row["error"]) == (sha(data), len(data), None)
        assert row["chunk_count"] == -(-len(data) // 8)
    joined = files.joined_blocks(files.file_blocks(chunks.orderBy(F.rand(5)), block_chunks)).collect()
    assert {r["file_sequence_id"]: bytes(r["content"]) for r in joined} == {k: data for k, (_, data) in CONTENTS.items()}


def test_blocks_hold_every_byte(chunks):
    blocks = files.file_blocks(chunks, 2).orderBy("file_sequence_id", "block_index").collect()
    for key, (_, data) in CONTENTS.items():
        parts = [bytes(b["content"]) for b in blocks if b["file_sequence_id"] == key]
        assert b"".join(parts) == data and max(map(len, parts)) <= 16


@pytest.mark.parametrize("block_chunks", [1, 2, 64])
def test_one_form_for_all_sizes(chunks, block_chunks):
    blocks = files.file_blocks(chunks.unionAll(chunks).orderBy(F.rand(5)), block_chunks)
    facts = files.verify_files(files.file_facts(blocks))
    assert "content" not in facts.columns
    parts = {(b["file_sequence_id"], b["block_index"]): bytes(b["content"]) for b in blocks.collect()}
    found = {r["file_sequence_id"]: r for r in facts.collect()}
    for key, (_, data) in CONTENTS.items():
        assert b"".join(parts[k] for k in sorted(parts) if k[0] == key) == data
        row = found[key]
        assert (row["actual_checksum"], row["actual_size"], row["error"]) == (sha(data), len(data), None)
        assert row["chunk_count"] == row["total_chunks"] == -(-len(data) // 8)


@pytest.mark.parametrize("block_chunks", [2, 64])
def test_repeated_chunks_count_once(chunks, block_chunks):
    built = files.verify_files(files.assemble_files(chunks.unionAll(chunks).unionAll(chunks), block_chunks))
    assert [r["error"] for r in built.collect()] == [None] * len(CONTENTS)
    repeated = {r["file_sequence_id"]: r["repeated"] for r in files.chunk_counts(chunks.unionAll(chunks)).collect()}
    assert repeated == {42: 6, 43: 0, 44: 2, 45: 9, 46: 1}


@pytest.mark.parametrize("block_chunks", [2, 64])
def test_damaged_files(chunks, block_chunks):
    damaged = chunks.where("NOT (file_sequence_id = 42 AND chunk_index = 1)").where(
        "NOT (file_sequence_id = 44 AND is_last_chunk)"
    )
    damaged = damaged.withColumn(
        "file_size", F.when(F.col("file_sequence_id") == 46, 5).otherwise(F.col("file_size")).cast("bigint")
    ).withColumn(
        "file_checksum", F.when(F.col("file_sequence_id") != 45, F.upper("file_checksum")).otherwise(F.lit(" "))
    )
    found = {
        r["file_sequence_id"]: (r["checksum_status"], r["error"])
        for r in files.verify_files(files.assemble_files(damaged, block_chunks)).collect()
    }
    assert found == {
        42: ("FAIL", "CHECKSUM_MISMATCH"),
        43: ("PASS", None),
        45: ("ABSENT", None),
        46: ("PASS", "SIZE_MISMATCH"),
    }
    counts = {r["file_sequence_id"]: r for r in files.chunk_counts(damaged).collect()}
    assert (counts[42]["missing"], counts[42]["has_gaps"], counts[44]["finished"]) == (1, True, False)


def test_copies_that_differ_are_reported(spark):
    sent = files.chunk_files(spark.createDataFrame([(1, "f", b"abcdefgh"), (2, "g", b"same")], FILES), 4)
    other = sent.where("file_sequence_id = 1 AND NOT is_last_chunk AND chunk_index = 1").withColumns(
        {"chunk_data": F.lit(b"zz"), "file_size": F.lit(3).cast("bigint")}
    )
    for block_chunks in (1, 64):
        built = files.verify_files(files.assemble_files(sent.unionAll(other).unionAll(sent), block_chunks)).collect()
        found = {r["file_sequence_id"]: (r["conflicting"], r["error"]) for r in built}
        # One copy is taken as a whole: the size that came with the other bytes is not mixed in.
        assert found == {1: (1, "CHECKSUM_MISMATCH"), 2: (0, None)}


REQUESTS = [
    (b"invalid json", "DESERIALIZATION"),
    (b"", "DESERIALIZATION"),
    (b"[]", "DESERIALIZATION"),
    (b'{"sourceType":"FTP","path":"a"}', "DESERIALIZATION"),
    (b'{"sourceType":"s3","storageContainer":"b","path":"a"}', "DESERIALIZATION"),
    (b'{"sourceType":"LOCAL","storageContainer":null,"path":null}', "DESERIALIZATION"),
    (b'{"storageContainer":"b","path":"a"}', "DESERIALIZATION"),
    (b"null", "VALIDATION"),
    (None, "VALIDATION"),
    (b'{"sourceType":"LOCAL","path":"   "}', "VALIDATION"),
    (b'{"sourceType":"S3","storageContainer":" ","path":"a"}', "VALIDATION"),
    (b'{"sourceType":"AZURE","path":"a"}', "VALIDATION"),
    (b'{"sourceType":"GCP","storageContainer":"b","path":"missing"}', "VALIDATION"),
    (b'{"sourceType":"LOCAL","path":"/directory"}', "VALIDATION"),
    (b'{"sourceType":"S3","storageContainer":"b","path":"/a","more":[1]}', None),
    (b'{"sourceType":"LOCAL","path":"/file"}', None),
]


def test_file_requests(spark):
    rows = spark.createDataFrame(
        [("t", 0, i, value) for i, (value, _) in enumerate(REQUESTS)],
        "topic string, partition int, offset bigint, value binary",
    )
    listing = spark.createDataFrame(
        [("s3a://b/a", True, 3), ("file:/file", True, 4), ("file:/directory", False, None)],
        "uri string, is_file boolean, size bigint",
    )
    checked = files.check_file_requests(files.decode_file_requests(rows), listing)
    for row in checked.collect():
        value, reason = REQUESTS[row["file_sequence_id"]]
        assert row["reason"] == reason, value
    valid = files.valid_file_requests(checked).orderBy("file_sequence_id").collect()
    assert [(r["uri"], r["size"]) for r in valid] == [("s3a://b/a", 3), ("file:/file", 4)]
    assert files.rejected_file_requests(checked).count() == len(REQUESTS) - 2


def test_references_without_an_answer(spark):
    values = [b'{"sourceType":"AZURE","storageContainer":"b","path":"x"}', b'{"sourceType":"S3","storageContainer":"b","path":"y"}']
    rows = spark.createDataFrame(
        [("t", 0, i, v) for i, v in enumerate(values)], "topic string, partition int, offset bigint, value binary"
    )
    listing = spark.createDataFrame(
        [("s3a://b/y", None, None, "FETCH: OSError")], "uri string, is_file boolean, size bigint, error string"
    )
    checked = files.check_file_requests(files.decode_file_requests(rows), listing).collect()
    assert {r["file_sequence_id"]: r["reason"] for r in checked} == {0: "VALIDATION", 1: "FETCH"}


def test_uris(spark):
    kinds = spark.createDataFrame([("S3",), ("AZURE",), ("GCP",), ("LOCAL",), ("?",)], "k string")
    uri = files.file_uri(F.col("k"), F.lit("box"), F.lit("/d/f.txt"), "account")
    assert [r[0] for r in kinds.select(uri).collect()] == [
        "s3a://box/d/f.txt",
        "abfss://box@account.dfs.core.windows.net/d/f.txt",
        "gs://box/d/f.txt",
        "file:/d/f.txt",
        None,
    ]


def test_file_progress(spark):
    stored = spark.createDataFrame([("t", 7), ("t", 9), ("u", 3)], "topic string, file_sequence_id bigint")
    rejects = spark.createDataFrame([("t", 5), ("u", 100)], "topic string, file_sequence_id bigint")
    found = {r["topic"]: r["next_sequence_id"] for r in files.file_progress(stored, rejects).collect()}
    assert found == {"t": 10, "u": 101}
    assert files.file_progress(stored.limit(0), rejects.limit(0)).count() == 0
    # A failed or unfinished file is read again, whatever came after it.
    pending = spark.createDataFrame([("t", 8), ("t", 12), ("v", 4)], "topic string, file_sequence_id bigint")
    found = {r["topic"]: r["next_sequence_id"] for r in files.file_progress(stored, rejects, pending=pending).collect()}
    assert found == {"t": 8, "u": 101, "v": 4}


def test_copies_that_differ_are_reported(spark, chunks):
    other = chunks.where("file_sequence_id = 42 AND chunk_index = 1").withColumn("chunk_data", F.lit(b"zzzz"))
    counts = {r["file_sequence_id"]: r for r in files.chunk_counts(chunks.unionByName(other)).collect()}
    assert {k: r["conflicting"] for k, r in counts.items()} == {42: 1, 43: 0, 44: 0, 45: 0, 46: 0}
    folded = files.fold_repeats(chunks.unionByName(other).unionByName(chunks)).where("conflict").collect()
    assert [(r["file_sequence_id"], r["chunk_index"]) for r in folded] == [(42, 1)]


DESTINATIONS = [
    ("profile-watts-meters-v1.nt", ("profile", "watts", "meters")),
    ("/landing/table-harbour-tides-v1.xlsx", ("table", "harbour", "tides")),
    ("store/in/tree-oakfield-rings-v3.xml", ("tree", "oakfield", "rings")),
    ("a\\b\\s- o -p", ("s", "o", "p")),
    (".s-o-p", (".s", "o", "p")),
    (None, None),
    ("  ", None),
    ("one_name.nt", None),
    ("nodashes.nt", None),
    ("schema-org.nt", None),
    ("--meters-v1.nt", None),
    ("a-b-c/", None),
]


def test_destination_metadata(spark):
    rows = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(DESTINATIONS)], "i int, d string")
    for row in rows.select("i", naming.destination_metadata(F.col("d")).alias("m")).collect():
        destination, expected = DESTINATIONS[row["i"]]
        assert (None if row["m"] is None else tuple(row["m"])) == expected, destination


# destination, source name, plain, version 1, product key
NAMES = [
    ("out/s-o-p-x.nt", "a.txt", "out/s-o-p.nt", "out/s-o-p-v1.nt", "s-o-p"),
    ("out/", "a/b.txt", "out/b.txt", "out/b-v1.txt", "out"),
    ("plain", "a.txt", "plain", "plain-v1", "plain"),
    (None, "a/b.tar.gz", "b.tar.gz", "b.tar-v1.gz", "default"),
    ("  ", ".hidden", ".hidden", ".hidden-v1", "default"),
    (" out/x.y.nt ", "a", "out/x.y.nt", "out/x.y-v1.nt", "x.y"),
    ("a.b/plain", "a", "a.b/plain", "a.b/plain-v1", "plain"),
]


def test_destination_names(spark):
    rows = spark.createDataFrame([(i, n[0], n[1]) for i, n in enumerate(NAMES)], "i int, d string, s string")
    d, s = F.col("d"), F.col("s")
    found = rows.select(
        "i",
        naming.unversioned_destination(d, s),
        naming.versioned_destination(d, s, F.lit(1)),
        naming.product_key(d),
    )
    for row in found.collect():
        assert tuple(row)[1:] == NAMES[row["i"]][2:], NAMES[row["i"]]


def test_storage_keys(spark):
    cases = [
        (None, "dir/name.txt", "name.txt"),
        ("   ", "x/../name.txt", "name.txt"),
        ("a/b/", "c/d/name.txt", "a/b/name.txt"),
        ("/a/b/c.txt", "any", "a/b/c.txt"),
        ("/a/", "n", "a/n"),
    ]
    rows = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(cases)], "i int, d string, s string")
    found = rows.select("i", naming.storage_key(F.col("d"), F.col("s")).alias("k")).collect()
    assert {r["i"]: r["k"] for r in found} == {i: c[2] for i, c in enumerate(cases)}
    paths = spark.createDataFrame([("/a/../b/./c",), ("x//y",), ("../z",)], "d string")
    local = [r[0] for r in paths.select(naming.local_target(F.col("d"), "/root/in")).collect()]
    assert local == ["/b/c", "/root/in/x/y", "/root/z"]


def plan(spark, rows, counters):
    df = spark.createDataFrame(rows, "file_sequence_id bigint, destination string, file_name string")
    found = versions.plan_versions(df, spark.createDataFrame(counters, "product_key string, counter bigint"), width=2)
    return {r["file_sequence_id"]: (r["final_destination"], r["version"]) for r in found.collect()}


def test_versions(spark):
    destination = "out/s-o-p-x.nt"
    assert plan(spark, [(9, destination, "f")], [("s-o-p", 2)]) == {9: ("out/s-o-p.nt", None)}
    three = plan(spark, [(30, destination, "f"), (10, destination, "f"), (20, destination, "f")], [("s-o-p", 2)])
    assert three == {10: ("out/s-o-p-v3.nt", 3), 20: ("out/s-o-p-v4.nt", 4), 30: ("out/s-o-p-v5.nt", 5)}
    fresh = plan(spark, [(1, "x", "f"), (2, "x", "f"), (3, "y", "f")], [("z", 5)])
    assert fresh == {1: ("x-v1", 1), 2: ("x-v2", 2), 3: ("y", None)}


def test_first_failure(spark):
    results = spark.createDataFrame(
        [("r", 1, True), ("r", 2, True), ("r", 3, False), ("r", 4, True), ("q", 9, True), ("w", 1, False)],
        "run string, file_sequence_id bigint, ok boolean",
    )
    kept = versions.store_until_first_failure(results).collect()
    assert {(r["run"], r["file_sequence_id"]) for r in kept} == {("r", 1), ("r", 2), ("q", 9)}
    planned = spark.createDataFrame([("r", "p1", 7), ("q", "p2", 4), ("q", "p3", None)], "run string, product_key string, version bigint")
    counters = spark.createDataFrame([("p1", 5), ("p3", 1)], "product_key string, counter bigint")
    after = versions.next_counters(planned, counters, versions.first_failures(results))
    assert {r["product_key"]: r["counter"] for r in after.collect()} == {"p1": 5, "p2": 4, "p3": 1}
    # What was published in spite of a failed publication is never to be replaced.
    out = spark.createDataFrame([("p1", 6), ("p1", 7), ("p3", None)], "product_key string, version bigint")
    after = versions.next_counters(planned, counters, versions.first_failures(results), published=out)
    assert {r["product_key"]: r["counter"] for r in after.collect()} == {"p1": 7, "p2": 4, "p3": 1}
    shared = planned.union(spark.createDataFrame([("w", "p2", 9)], planned.schema))
    waiting = versions.held_back(shared, versions.first_failures(results)).collect()
    assert [r["product_key"] for r in waiting] == ["p2"]


def test_numbering_matches_a_plain_window(spark):
    rows = spark.range(5000).select(
        (F.col("id") * 37 % 50021).alias("n"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11).alias("g")
    )
    found = number_rows(rows, ["g"], "n", width=100)
    expected = rows.selectExpr(
        "n", "g", "row_number() OVER (PARTITION BY g ORDER BY n) AS row_number", "count(*) OVER (PARTITION BY g) AS group_rows"
    )
    assert found.exceptAll(expected.select(found.columns)).isEmpty() and found.count() == 5000


def test_json_names_are_case_sensitive(spark):
    rows = spark.createDataFrame(
        [("t", 0, 1, json.dumps({"sourceType": "LOCAL", "path": "/x", "Path": "/y"}).encode())],
        "topic string, partition int, offset bigint, value binary",
    )
    assert files.decode_file_requests(rows).first()["path"] == "/x"
