"""Micro-batch runs: the same rows as a batch, resumed without loss or repetition."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from covenant.operators import federation, files
from covenant.operators.grants import flatten_grants
from covenant.operators.ranges import position_ranges
from covenant.schemas import CHUNK, ENVELOPE, GRANTS_DOCUMENT, MESSAGE
from covenant.streaming import federation as streams
from covenant.streaming.progress import KEYS, ProgressTable, not_yet_delivered
from covenant.streaming.reassembly import reassemble
from covenant.streaming.refresh import Refreshed
from harness import queries

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def grants(spark, *attributes):
    product = {
        "topic": "t",
        "consumers": [
            {"idpClientId": "c", "attributes": [{"name": n, "value": v} for n, v in attributes]},
            {"idpClientId": "open"},
        ],
    }
    text = json.dumps({"producers": [{"products": [product]}]})
    rows = spark.createDataFrame([(text,)], "j string")
    return flatten_grants(rows.select(F.from_json("j", GRANTS_DOCUMENT).alias("d")).select("d.*"))


def messages(spark, numbers):
    rows = [("t", i % 2, i, None, None, str(i).encode(), [("Security-Label", f"odd={i % 2}")]) for i in numbers]
    return spark.createDataFrame(rows, MESSAGE).coalesce(1)


def test_run_resumes(spark, work):
    rules = grants(spark, ("odd", "1"))
    progress = ProgressTable(spark, f"{work}/progress")
    assert progress.current().isEmpty()

    def run():
        stream = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).parquet(f"{work}/in")
        streams.run_federation(
            stream, rules, f"{work}/sink", f"{work}/checkpoint", server="hub", progress=progress
        ).awaitTermination()
        rows = streams.read_sink(spark, f"{work}/sink").collect()
        return sorted((r["consumer_id"], r["offset"]) for r in rows if r["reason"] is None), rows

    messages(spark, range(0, 5)).write.mode("append").parquet(f"{work}/in")
    messages(spark, range(5, 9)).write.mode("append").parquet(f"{work}/in")
    delivered, rows = run()
    batch = federation.federate(messages(spark, range(9)), rules).collect()
    assert delivered == sorted((r["consumer_id"], r["offset"]) for r in batch)
    assert {r["value"] for r in rows if r["reason"]} == {None}
    messages(spark, [9, 10]).write.mode("append").parquet(f"{work}/in")
    again, _ = run()
    assert len(again) == len(set(again)) == len(delivered) + 3
    assert run()[0] == again
    saved = {(r["client"], r["partition"]): r["next_offset"] for r in progress.current().collect()}
    assert saved == {("c", 1): 10, ("open", 0): 11, ("open", 1): 10}


def test_grants_are_read_again(spark):
    now = [0.0]
    loads = []

    def load():
        loads.append(now[0])
        return spark.range(len(loads))

    held = Refreshed(load, ttl=60, clock=lambda: now[0])
    assert held.get().count() == 1 and held.get().count() == 1
    now[0] = 60.0
    assert held.get().count() == 2
    held.clear()
    assert held.get().count() == 3 and held.refresh().count() == 4


def envelopes(spark, *numbers, bad=()):
    rows = []
    for i in numbers:
        data = str(i).encode()
        digest = hashlib.sha256(data if i not in bad else b"other").hexdigest()
        rows.append(("t", 0, i, None, None, data, [("orgName", "o")], digest, "SHA-256"))
    return spark.createDataFrame(rows, ENVELOPE)


@pytest.mark.parametrize("action, kept", [("SKIP", [1, 3]), ("LOG_ONLY", [1, 2, 3])])
def test_inbound(spark, work, action, kept):
    progress = ProgressTable(spark, f"{work}/progress")
    write = streams.inbound_writer(
        f"{work}/sink", client="c", server="s", on_mismatch=action, progress=progress, reports=f"{work}/reports", exact=True
    )
    for _ in range(2):
        write(envelopes(spark, 1, 2, 3, 3, bad=[2]), 0)
        found = streams.read_sink(spark, f"{work}/sink").where("NOT skipped").select("offset").collect()
        assert sorted(r["offset"] for r in found) == kept
        assert [r["next_offset"] for r in progress.current().collect()] == [4]
    assert streams.read_sink(spark, f"{work}/reports").count() == 3
    write(envelopes(spark, 3, 4), 1)
    found = streams.read_sink(spark, f"{work}/sink").where("NOT skipped").select("offset").collect()
    assert sorted(r["offset"] for r in found) == [*kept, 4]


def test_inbound_abort_writes_nothing(spark, work):
    progress = ProgressTable(spark, f"{work}/progress")
    write = streams.inbound_writer(f"{work}/sink", client="c", server="s", on_mismatch="ABORT", progress=progress)
    with pytest.raises(Exception, match="checksum mismatch on topic t offset 5"):
        write(envelopes(spark, 5, 6, bad=[5]), 0)
    assert not os.path.exists(f"{work}/sink") and progress.current().isEmpty()


def test_redelivery(spark):
    rows = spark.createDataFrame(
        [("c", "s", "t", 0, 1), ("c", "s", "t", 0, 2), ("c", "s", "t", 0, 2), ("c", "s", "u", 0, 1)],
        "client string, server string, topic string, partition int, offset bigint",
    )
    # Offset 1 came after 2: it is not covered by what was delivered.
    before = position_ranges(spark.createDataFrame([("c", "s", "t", 0, 2)], rows.schema), KEYS, "offset")
    assert sorted((r["topic"], r["offset"]) for r in not_yet_delivered(rows, before).collect()) == [("t", 1), ("u", 1)]
    assert not_yet_delivered(rows, None).count() == 3


def test_file_references_in_a_stream(spark, work):
    values = [b"broken", b'{"sourceType":"LOCAL","path":"/a"}', b'{"sourceType":"LOCAL","path":"/gone"}']
    batch = spark.createDataFrame(
        [("f", 0, i, v) for i, v in enumerate(values)], "topic string, partition int, offset bigint, value binary"
    )
    contents = spark.createDataFrame(
        [("file:/a", b"hello", None), ("file:/gone", None, "FETCH: OSError")], "uri string, content binary, error string"
    )
    write = streams.file_outbound_writer(lambda valid: contents, f"{work}/chunks", f"{work}/rejects", chunk_size=3)
    write(batch, 0)
    rejects = streams.read_sink(spark, f"{work}/rejects").collect()
    assert {r["file_sequence_id"]: r["reason"] for r in rejects} == {0: "DESERIALIZATION", 2: "FETCH"}
    assert streams.read_sink(spark, f"{work}/chunks").count() == 3


def test_reassembly(spark, work):
    contents = {i: (f"{i}-" * (i * 7)).encode() for i in range(6)}
    chunks = files.chunk_files(
        spark.createDataFrame([(i, f"d/f{i}", data) for i, data in contents.items()], "file_sequence_id bigint, file_name string, content binary"),
        8,
    )
    lost = chunks.where("NOT (file_sequence_id = 2 AND chunk_index = 0)")
    # Every chunk twice, in any order, over several micro-batches.
    lost.unionAll(lost).withColumns({"topic": F.lit("t"), "partition": F.lit(0)}).repartition(5, F.rand(2)).write.parquet(f"{work}/in")
    schema = spark.read.parquet(f"{work}/in").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{work}/in")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        query = reassemble(stream, block_chunks=3).writeStream.format("parquet").option("path", f"{work}/blocks")
        query.option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    blocks = spark.read.parquet(f"{work}/blocks").drop("topic", "partition", "actual_checksum", "abandoned")
    done = files.verify_files(files.file_digests(blocks)).collect()
    found = {r["file_sequence_id"]: r["actual_checksum"] for r in done if r["error"] is None}
    assert found == {i: hashlib.sha256(data).hexdigest() for i, data in contents.items() if i != 2}
    assert set(CHUNK.fieldNames()) <= set(schema.fieldNames())


def test_stream_files_grow_in_number_not_in_size(spark, work, monkeypatch):
    monkeypatch.setattr(queries, "FED_BYTES", 1000)
    rows = spark.range(400).select("id", F.rpad(F.lit("x"), 50, "y").alias("value"))
    for key, files_, each in (("a", 3, 2), ("b", 8, 4), ("c", 40, 10)):
        place = F.lit(0) if key == "c" else F.xxhash64("id")
        fed = queries._feed(rows, f"{work}/{key}", place, F.octet_length("value"), files=files_, each=each)
        back = spark.read.parquet(f"{work}/{key}")
        assert sorted(r["id"] for r in back.collect()) == list(range(400))
        assert fed == -(-max(20, files_) * each // files_)
    assert len(spark.read.parquet(f"{work}/a").inputFiles()) > 10
    few = queries._feed(rows.limit(3), f"{work}/d", F.xxhash64("id"), F.octet_length("value"), files=3, each=2)
    assert few == 2 and queries._feed(rows.limit(0), f"{work}/e", F.col("id"), F.octet_length("value"), files=4, each=1) == 1
