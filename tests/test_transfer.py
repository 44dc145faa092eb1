"""Sources, sinks and whole transfers through files."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from covenant.operators import files
from covenant.operators.grants import flatten_grants
from covenant.plans import outbound
from covenant.plans.inbound import land_files
from covenant.plans.outbound import outbound_files
from covenant.schemas import GRANTS_DOCUMENT, MESSAGE
from covenant.session import check_reachable
from covenant.sinks.files import publish_files, write_files, write_large_files
from covenant.sinks.messages import write_messages
from covenant.sources import messages as source
from covenant.sources.objects import read_files, read_large_chunks, scan_files, stat_files
from harness.queries import QUERIES


def sha(data):
    return hashlib.sha256(data).hexdigest()


def uris(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "uri string")


def test_reading_objects(spark, work):
    data = os.urandom(5000)
    for name, content in (("big.bin", data), ("small.bin", b"abc"), ("empty.bin", b"")):
        with open(f"{work}/{name}", "wb") as out:
            out.write(content)
    asked = uris(spark, *[f"file:{work}/{n}" for n in ("big.bin", "small.bin", "empty.bin", "none.bin", "small.bin")], f"file:{work}")
    listing = stat_files(asked).cache()
    found = {r["uri"].rsplit("/", 1)[1]: (r["is_file"], r["size"]) for r in listing.collect()}
    assert found == {
        "big.bin": (True, 5000),
        "small.bin": (True, 3),
        "empty.bin": (True, 0),
        os.path.basename(work): (False, None),
    }
    small = {r["uri"].rsplit("/", 1)[1]: bytes(r["content"]) for r in read_files(listing, 1000).collect()}
    assert small == {"small.bin": b"abc", "empty.bin": b""}
    chunks = read_large_chunks(listing, 700, inline_bytes=1000, range_chunks=3).withColumn("file_sequence_id", F.lit(1).cast("bigint"))
    rows = chunks.orderBy("chunk_index").collect()
    assert b"".join(bytes(r["chunk_data"]) for r in rows[:-1]) == data
    assert (rows[-1]["is_last_chunk"], rows[-1]["chunk_index"], rows[-1]["file_checksum"]) == (True, 8, sha(data))
    built = files.verify_files(files.assemble_files(chunks.drop("uri"), 3)).first()
    assert (built["error"], built["actual_size"], built["file_name"]) == (None, 5000, "big.bin")
    assert scan_files(spark, work, "*.bin").count() == 2


def test_writing_files(spark, work):
    rows = spark.createDataFrame(
        [(1, f"file:{work}/out/a.txt", b"one"), (2, f"file:{work}/out/b.txt", b""), (3, "file:/proc/none/c", b"x")],
        "file_sequence_id bigint, uri string, content binary",
    )
    for _ in range(2):
        results = {r["file_sequence_id"]: r for r in write_files(rows).collect()}
        assert [results[i]["ok"] for i in (1, 2, 3)] == [True, True, False] and results[3]["error"]
    assert sorted(os.listdir(f"{work}/out")) == ["a.txt", "b.txt"]
    assert open(f"{work}/out/a.txt", "rb").read() == b"one"
    staged = spark.createDataFrame(
        [(1, f"file:{work}/out/a.txt", f"file:{work}/final/x/a.txt"), (9, f"file:{work}/out/none", f"file:{work}/final/none")],
        "file_sequence_id bigint, staged_uri string, uri string",
    )
    for _ in range(2):
        assert {r["file_sequence_id"]: r["ok"] for r in publish_files(staged).collect()} == {1: True, 9: False}
    assert os.listdir(f"{work}/final/x") == ["a.txt"]


def test_writing_large_files(spark, work):
    parts = [(1, i, bytes([i]) * 100) for i in range(5)] + [(2, i, b"z") for i in range(3)]
    whole = {1: b"".join(p[2] for p in parts if p[0] == 1), 2: b"wrong"}
    rows = spark.createDataFrame(
        [(s, f"file:{work}/large/{s}", i, data, sha(whole[s])) for s, i, data in parts],
        "file_sequence_id bigint, uri string, block_index int, content binary, file_checksum string",
    )
    results = {r["file_sequence_id"]: r["ok"] for r in write_large_files(rows.orderBy(F.rand(1))).collect()}
    assert results == {1: True, 2: False}
    assert open(f"{work}/large/1", "rb").read() == whole[1] and not os.path.exists(f"{work}/large/2")


def test_landing_stops_at_the_first_failure(spark, work):
    contents = {i: f"file number {i} ".encode() * i for i in range(1, 7)}
    sent = files.chunk_files(
        spark.createDataFrame(
            [(i, f"src/f{i}.txt", data) for i, data in contents.items()],
            "file_sequence_id bigint, file_name string, content binary"
        ),
        10,
    ).withColumn("run", F.when(F.col("file_sequence_id") <= 4, "a").otherwise("b"))
    damaged = sent.where("NOT (file_sequence_id = 3 AND chunk_index = 1)")
    destinations = spark.createDataFrame([("a", "in/s-o-p.txt"), ("b", "in/")], "run string, destination string")
    counters = spark.createDataFrame([("s-o-p", 4)], "product_key string, counter bigint")
    landing = land_files(damaged, destinations, counters, f"file:{work}/store", f"{work}/work", block_chunks=4)
    found = sorted(os.listdir(f"{work}/store/in"))
    assert found == ["f5-v1.txt", "f6-v2.txt", "s-o-p-v5.txt", "s-o-p-v6.txt"]
    assert open(f"{work}/store/in/s-o-p-v6.txt", "rb").read() == contents[2]
    assert open(f"{work}/store/in/f6-v2.txt", "rb").read() == contents[6]
    assert {r["run"]: r["next_sequence_id"] for r in landing.progress.collect()} == {"a": 3, "b": 7}
    assert {r["product_key"]: r["counter"] for r in landing.counters.collect()} == {"s-o-p": 4, "in": 2}


def test_outbound_files(spark, work):
    with open(f"{work}/a.txt", "wb") as out:
        out.write(b"content")
    values = [
        {"sourceType": "LOCAL", "path": f"{work}/a.txt"},
        {"sourceType": "LOCAL", "path": f"{work}/none.txt"},
        {"sourceType": "LOCAL", "path": f"{work}/a.txt"},
    ]
    rows = [
        ("files", 0, i, None, None, json.dumps(v).encode(), [("Security-Label", f"n={i}")]) for i, v in enumerate(values)
    ]
    text = json.dumps(
        {
            "producers": [
                {
                    "products": [
                        {
                            "topic": "files",
                            "consumers": [
                                {"idpClientId": "c1"},
                                {"idpClientId": "c2", "attributes": [{"name": "n", "value": "0"}]},
                            ],
                        }
                    ]
                }
            ]
        }
    )
    grants = flatten_grants(
        spark.createDataFrame([(text,)], "j string").select(F.from_json("j", GRANTS_DOCUMENT).alias("d")).select("d.*")
    )
    chunks, deliveries, rejects = outbound_files(spark.createDataFrame(rows, MESSAGE), grants, chunk_size=4)
    assert sorted((r["file_sequence_id"], r["chunk_index"]) for r in chunks.collect()) == [(s, i) for s in (0, 2) for i in range(3)]
    assert sorted((r["consumer_id"], r["file_sequence_id"]) for r in deliveries.collect()) == [("c1", 0), ("c1", 2), ("c2", 0)]
    assert [(r["file_sequence_id"], r["reason"]) for r in rejects.collect()] == [(1, "VALIDATION")]


def grants_of(spark, **topics):
    products = [{"topic": t, "consumers": [{"idpClientId": c} for c in consumers]} for t, consumers in topics.items()]
    text = spark.createDataFrame([(json.dumps({"producers": [{"products": products}]}),)], "j string")
    return flatten_grants(text.select(F.from_json("j", GRANTS_DOCUMENT).alias("d")).select("d.*"))


@pytest.mark.parametrize("inline_bytes", [1 << 20, 4])
def test_files_stay_within_their_topic(spark, work, inline_bytes):
    """Two topics and two partitions with the same offsets and file names; small objects, and the same read in ranges."""
    rows, wanted = [], {}
    for topic, partition in (("ta", 0), ("ta", 1), ("tb", 0)):
        os.makedirs(f"{work}/{topic}{partition}")
        path = f"{work}/{topic}{partition}/f.txt"
        wanted[topic, partition] = f"bytes of {topic} {partition}".encode()
        with open(path, "wb") as out:
            out.write(wanted[topic, partition])
        value = json.dumps({"sourceType": "LOCAL", "path": path}).encode()
        rows.append((topic, partition, 0, None, None, value, []))
    grants = grants_of(spark, ta=["ca"], tb=["cb"])
    chunks, deliveries, rejects = outbound_files(
        spark.createDataFrame(rows, MESSAGE), grants, chunk_size=6, inline_bytes=inline_bytes, work=f"{work}/run"
    )
    keys = ["topic", "partition", "file_sequence_id"]
    sent = chunks.join(deliveries, keys)
    by = ["consumer_id", "topic", "partition"]
    built = files.verify_files(files.assemble_files(sent, by=by)).collect()
    joined = files.joined_blocks(files.file_blocks(sent, by=by), by=by).collect()
    found = {(r["consumer_id"], r["topic"], r["partition"]): bytes(r["content"]) for r in joined}
    assert found == {("ca", "ta", 0): wanted["ta", 0], ("ca", "ta", 1): wanted["ta", 1], ("cb", "tb", 0): wanted["tb", 0]}
    assert all(r["error"] is None for r in built) and rejects.count() == 0


@pytest.mark.parametrize("inline_bytes", [1 << 20, 2])
def test_unreadable_objects_are_rejects(spark, work, monkeypatch, inline_bytes):
    with open(f"{work}/there", "wb") as out:
        out.write(b"content")
    values = [{"sourceType": "LOCAL", "path": f"{work}/{name}"} for name in ("there", "gone")]
    rows = [("t", 0, i, None, None, json.dumps(v).encode(), []) for i, v in enumerate(values)]
    listing = spark.createDataFrame(
        [(f"file:{work}/{name}", True, 7, None) for name in ("there", "gone")],
        "uri string, is_file boolean, size bigint, error string",
    )
    # The second object goes away between the listing and the reading.
    monkeypatch.setattr(outbound, "stat_files", lambda requests: listing)
    chunks, deliveries, rejects = outbound_files(
        spark.createDataFrame(rows, MESSAGE), grants_of(spark, t=["c"]), chunk_size=4, inline_bytes=inline_bytes, work=f"{work}/run"
    )
    assert [(r["file_sequence_id"], r["reason"]) for r in rejects.collect()] == [(1, "FETCH")]
    assert [r["file_sequence_id"] for r in deliveries.collect()] == [0]
    assert sorted((r["file_sequence_id"], r["chunk_index"]) for r in chunks.collect()) == [(0, 0), (0, 1), (0, 2)]


def landing_of(spark, work, runs, destinations, counters, lost=None):
    rows = [(i, f"f{i}.txt", f"{run} {i}".encode(), run) for run, ids in runs.items() for i in ids]
    table = spark.createDataFrame(rows, "file_sequence_id bigint, file_name string, content binary, run string")
    chunks = files.chunk_files(table, 3, by=["run"])
    chunks = chunks.where(lost) if lost else chunks
    return land_files(
        chunks,
        spark.createDataFrame(list(destinations.items()), "run string, destination string"),
        spark.createDataFrame(list(counters.items()), "product_key string, counter bigint"),
        f"file:{work}/store",
        f"{work}/work",
    )


def next_ids(landing):
    return {r["run"]: r["next_sequence_id"] for r in landing.progress.collect()}


@pytest.mark.parametrize(
    "root, master, mounted, fine",
    [
        ("file:/data/in", "local[4]", False, True),
        ("file:/data/in", "spark://h:7077", False, False),
        ("/data/in", "yarn", False, False),
        ("/data/in", "yarn", True, True),
        ("file:///shared/run/in", "yarn", False, True),
        ("file:/shared-not/in", "yarn", False, False),
        ("s3a://box/in", "yarn", False, True),
    ],
)
def test_folders_of_one_machine_are_refused_on_a_cluster(root, master, mounted, fine):
    try:
        check_reachable(root, master, "file:/shared", mounted=mounted)
    except ValueError:
        assert not fine
    else:
        assert fine


def test_an_unfinished_file_is_read_again(spark, work):
    landing = landing_of(spark, work, {"a": [1, 2, 3]}, {"a": "in/s-o-p.txt"}, {}, "NOT (file_sequence_id = 2 AND is_last_chunk)")
    assert next_ids(landing) == {"a": 2}


def test_a_failed_publication_is_read_again_and_nothing_is_replaced(spark, work):
    os.makedirs(f"{work}/store/in/s-o-p-v11.txt/blocked")
    landing = landing_of(spark, work, {"a": [1, 2, 3]}, {"a": "in/s-o-p.txt"}, {"s-o-p": 10})
    assert next_ids(landing) == {"a": 1}
    assert {r["product_key"]: r["counter"] for r in landing.counters.collect()} == {"s-o-p": 13}


def partitioned(spark, lost="false"):
    """Two topics and two partitions with the same offsets and the same file names, in one run."""
    places = [(t, p) for t in ("t/a", "t b") for p in (0, 1)]
    rows = [("r", t, p, i, f"f{i}.txt", f"{t} {p} {i} ".encode() * i) for t, p in places for i in range(1, 4)]
    table = spark.createDataFrame(
        rows, "run string, topic string, partition int, file_sequence_id bigint, file_name string, content binary"
    )
    by = ["run", "topic", "partition"]
    return {r[1:4]: r[5] for r in rows}, files.chunk_files(table, 7, by=by).where(f"NOT ({lost})")


def land(spark, work, chunks, counter=0, **options):
    return land_files(
        chunks,
        spark.createDataFrame([("r", "in/s-o-p.txt")], "run string, destination string"),
        spark.createDataFrame([("s-o-p", counter)], "product_key string, counter bigint"),
        f"file:{work}/store",
        f"{work}/work",
        block_chunks=2,
        **options,
    )


def contents_of(landing):
    return {
        (r["topic"], r["partition"], r["file_sequence_id"]): open(r["uri"].removeprefix("file:"), "rb").read()
        for r in landing.published.where("ok").collect()
    }


def place_of(rows):
    return {(r["topic"], r["partition"]): r["next_sequence_id"] for r in rows.collect()}


def test_equal_offsets_of_partitions_are_different_files(spark, work):
    wanted, chunks = partitioned(spark)
    landing = land(spark, work, chunks)
    assert contents_of(landing) == wanted and landing.results.count() == landing.published.count() == len(wanted)
    versions = [
        (r["topic"], r["partition"], r["file_sequence_id"])
        for r in landing.manifest.orderBy("version").collect()
    ]
    assert versions == sorted(wanted, key=lambda k: (k[2], k[0], k[1]))
    assert place_of(landing.progress) == {(t, p): 4 for t in ("t/a", "t b") for p in (0, 1)}


def test_a_failure_in_one_partition_ends_the_run_there(spark, work):
    wanted, chunks = partitioned(spark, "topic = 't/a' AND partition = 0 AND file_sequence_id = 2 AND chunk_index = 0")
    landing = land(spark, work, chunks)
    before = {k for k in wanted if (k[2], k[0], k[1]) < (2, "t/a", 0)}
    assert contents_of(landing) == {k: wanted[k] for k in before}
    assert place_of(landing.progress) == {("t/a", 0): 2, ("t/a", 1): 2, ("t b", 0): 3, ("t b", 1): 3}
    assert [r["counter"] for r in landing.counters.collect()] == [0]


def test_a_repeated_attempt_follows_its_manifest(spark, work):
    wanted, chunks = partitioned(spark)
    first = land(spark, work, chunks, counter=5)
    names = {tuple(r)[:4]: r["uri"] for r in first.manifest.collect()}
    # The attempt ended while it was moving files: some are at their names, some are not, and nothing was reported.
    moved = sorted(names.values())[::2]
    for r in first.manifest.collect():
        if r["uri"] not in moved:
            os.rename(r["uri"].removeprefix("file:"), r["staged_uri"].removeprefix("file:"))
    os.rename(f"{work}/work/published", f"{work}/lost")
    again = land(spark, work, chunks.limit(0), counter=99)
    assert {tuple(r)[:4]: r["uri"] for r in again.manifest.collect()} == names
    assert contents_of(again) == wanted and not os.listdir(f"{work}/store/.staged")
    # A foreign file at the place of one that was moved is not taken for it.
    os.rename(f"{work}/work/published", f"{work}/lost-too")
    with open(moved[0].removeprefix("file:"), "wb") as out:
        out.write(b"foreign")
    failed = land(spark, work, chunks).published.where("NOT ok").collect()
    assert [r["target"] for r in failed] == [moved[0]] and "another file" in failed[0]["error"]


def test_equal_targets_are_an_error_of_the_later_file(spark, work):
    rows = [("a", 1, "x.txt", b"one"), ("b", 1, "x.txt", b"two"), ("c", 1, "y.txt", b"three")]
    table = spark.createDataFrame(rows, "run string, file_sequence_id bigint, file_name string, content binary")
    landing = land_files(
        files.chunk_files(table, 2, by=["run"]),
        spark.createDataFrame([("a", "in/"), ("b", "/in/x.txt"), ("c", "out/")], "run string, destination string"),
        spark.createDataFrame([], "product_key string, counter bigint"),
        f"file:{work}/store",
        f"{work}/work",
    )
    assert {r["run"]: r["error"] for r in landing.results.collect()} == {"a": None, "b": "DUPLICATE_TARGET", "c": None}
    assert open(f"{work}/store/in/x.txt", "rb").read() == b"one" and next_ids(landing) == {"a": 2, "b": 1, "c": 2}


@pytest.mark.parametrize(
    "provider, bucket, stored, progress",
    [
        ("S3", "box", "s3://box/in/s-o-p-v1.txt", 4),
        ("GCP", "box", "gs://box/in/s-o-p-v1.txt", 4),
        ("AZURE", "box", "azure://box/in/s-o-p-v1.txt", 4),
        ("LOCAL", "", "in/s-o-p-v1.txt", 4),
        ("S3", " ", None, 1),
        ("GCP", "", None, 1),
        ("AZURE", "", None, 4),
    ],
)
def test_stores_are_named_and_a_blank_bucket_takes_nothing(spark, work, provider, bucket, stored, progress):
    _, chunks = partitioned(spark)
    landing = land(spark, work, chunks, provider=provider, bucket=bucket)
    first = landing.published.where("version = 1").collect()
    assert [r["stored"] for r in first] == ([stored] if progress > 1 else [])
    assert set(place_of(landing.progress).values()) == {progress}
    assert os.path.exists(f"{work}/store/in") == (stored is not None)


def test_runs_of_one_product_wait_for_each_other(spark, work):
    lost = "NOT (run = 'a' AND file_sequence_id = 2 AND chunk_index = 0)"
    landing = landing_of(spark, work, {"a": [1, 2], "b": [1, 5]}, {"a": "in/s-o-p.txt", "b": "in/s-o-p.txt"}, {"s-o-p": 10}, lost)
    assert landing.published.count() == 0 and next_ids(landing) == {"a": 1, "b": 1}
    assert {r["product_key"]: r["counter"] for r in landing.counters.collect()} == {"s-o-p": 10}


def test_published_files_are_read_back_without_a_broadcast(spark, work):
    """A table with a row per file is not collected by the driver, however small it is taken for."""
    texts = {i: f"text {i} " * 200 * i for i in range(1, 6)}
    rows = [(i, text, "en", "src") for i, text in texts.items()]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    documents.write.parquet(f"{work}/documents.parquet")
    landed = QUERIES["landed_files"](spark, work)
    assert "Broadcast" not in landed._jdf.queryExecution().executedPlan().toString()
    found = {r["file_sequence_id"]: (r["name"], r["checksum"]) for r in landed.collect()}
    assert found == {i: (f"in/p0-v{10 + i}.txt", sha(text.encode())) for i, text in texts.items()}


def test_tagged_text(spark, work):
    lines = [
        "Security-Label:nationality=GBR¬Content-Type:application/n-triples\t<s> <p> \"a:b\tc\" .",
        "Security-Label:k:v\t京",
        "",
    ]
    with open(f"{work}/x.dat", "w", encoding="utf-8") as out:
        out.write("\n".join(lines))
    rows = source.read_tagged_text(spark, f"{work}/x.dat", "knowledge").orderBy("offset").collect()
    assert [tuple(h) for h in rows[0]["headers"]] == [
        ("Security-Label", "nationality=GBR"),
        ("Content-Type", "application/n-triples"),
    ]
    assert bytes(rows[0]["value"]).decode() == '<s> <p> "a:b\tc" .'
    assert [tuple(h) for h in rows[1]["headers"]] == [("Security-Label", "k:v")]
    assert bytes(rows[1]["value"]).decode() == "京" and len(rows) == 2 and rows[0]["topic"] == "knowledge"


def test_messages_through_files(spark, work):
    rows = [("t", 0, 1, None, b"k", b"v", [("a", "b")]), ("u", 0, 2, None, None, b"w", [])]
    df = spark.createDataFrame(rows, MESSAGE).withColumn("consumer_id", F.lit("c"))
    write_messages(df, f"{work}/sink")
    assert sorted(os.listdir(f"{work}/sink/consumer_id=c")) == ["topic=t", "topic=u"]
    df.drop("consumer_id").write.parquet(f"{work}/messages")
    back = source.read_messages(spark, f"{work}/messages", ["t"], format="parquet")
    assert [(r["offset"], [tuple(h) for h in r["headers"]]) for r in back.collect()] == [(1, [("a", "b")])]
    assert source.read_messages(spark, df, ["u"]).count() == 1


def test_start_offsets(spark):
    committed = spark.createDataFrame([("t", 0, 7)], "topic string, partition int, next_offset bigint")
    requested = spark.createDataFrame([("t", 0, 3), ("t", 1, 0)], "topic string, partition int, offset bigint")

    def found(**options):
        rows = source.start_offsets(committed, requested, **options).orderBy("partition").collect()
        return [(r["offset"], r["is_seek"]) for r in rows]

    assert found() == [(7, False), (-2, True)]
    assert found(force_reset=True) == [(3, True), (-2, True)]
    only = source.start_offsets(committed, requested.limit(0))
    assert [(r["offset"], r["is_seek"]) for r in only.collect()] == [(7, False)]
    latest = source.start_offsets(committed, requested.limit(0), force_reset=True, default=source.LATEST)
    assert source.starting_offsets_json(latest) == '{"t": {"0": -1}}'
