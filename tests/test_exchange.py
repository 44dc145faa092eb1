"""The exchange sink's commits, and batches bound to a version of the grants."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from covenant.sinks import exchange
from covenant.sinks.exchange import DEAD_LETTER, DELIVERED, committed_files, read_exchange, write_exchange
from covenant.streaming import federation as streams
from covenant.streaming.progress import ProgressTable
from covenant.streaming.refresh import VersionedTable
from tests.test_streams import grants, messages

SCHEMA = "kind string, topic string, consumer_id string, offset bigint"


def rows(spark, numbers, kind=DELIVERED):
    return spark.createDataFrame([(kind, f"t/{i % 2}", f"c {i % 3}", i) for i in numbers], SCHEMA).repartition(3)


def offsets(df):
    return sorted(r["offset"] for r in df.collect()) if df is not None else []


def files_below(work):
    return sorted(f for top, _, names in os.walk(f"{work}/sink") for f in names if f.endswith(".parquet"))


def test_what_a_batch_has_committed_stands(spark, work):
    sink = f"file:{work}/sink"
    assert committed_files(spark, sink).collect() == [] and read_exchange(spark, sink, DELIVERED) is None
    write_exchange(rows(spark, range(10)), sink, 0)
    before = files_below(work)
    write_exchange(rows(spark, range(5, 20)), sink, 0)
    assert offsets(read_exchange(spark, sink, DELIVERED)) == list(range(10)) and files_below(work) == before
    write_exchange(rows(spark, [100, 101], DEAD_LETTER), sink, 1)
    assert offsets(read_exchange(spark, sink, DEAD_LETTER)) == [100, 101]
    assert offsets(read_exchange(spark, sink, DELIVERED, topic="t/1", consumer="c 0")) == [3, 9]
    assert offsets(read_exchange(spark, sink, DEAD_LETTER, batch=0)) == []
    write_exchange(rows(spark, []), sink, 2)
    write_exchange(rows(spark, [7]), sink, 2)
    assert offsets(read_exchange(spark, sink, DELIVERED, batch=2)) == []


def test_a_failed_write_leaves_nothing_to_see(spark, work):
    sink = f"file:{work}/sink"
    bad = F.when(F.col("offset") == 9, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("offset"))
    with pytest.raises(Exception, match="broken"):
        write_exchange(rows(spark, range(10)).withColumn("offset", bad), sink, 0)
    assert read_exchange(spark, sink, DELIVERED) is None
    write_exchange(rows(spark, range(10)), sink, 0)
    assert offsets(read_exchange(spark, sink, DELIVERED)) == list(range(10))


def test_appends_name_their_batch(spark, work):
    spark.dataSource.register(exchange.ExchangeSink)
    with pytest.raises(Exception, match="name the batch"):
        rows(spark, [1]).write.format("exchange").option("path", f"file:{work}/sink").mode("append").save()


def test_files_are_closed_when_many_are_open(work, monkeypatch):
    monkeypatch.setattr(exchange, "OPEN_FILES", 2)
    batches = [
        pa.RecordBatch.from_pydict({"kind": ["k"] * 6, "topic": list("abcabc"), "consumer_id": [None, "x"] * 3, "n": list(range(6 * i, 6 * i + 6))})
        for i in range(3)
    ]
    sink = exchange._Sink(f"file:{work}/sink")
    done = sink.write(iter(batches))
    found = [n for f in done.files for n in pq.ParquetFile(f"{work}/sink/{f}").read().column("n").to_pylist()]
    assert sorted(found) == list(range(18))
    sink.abort([done, None])
    assert files_below(work) == []


def test_a_stream_writer_of_its_own(spark, work):
    spark.dataSource.register(exchange.ExchangeSink)
    for half in (range(4), range(4, 9)):
        rows(spark, half).write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{work}/in")
        query = stream.writeStream.format("exchange").option("path", f"file:{work}/sink").option("checkpointLocation", f"{work}/c")
        query.trigger(availableNow=True).start().awaitTermination()
    assert offsets(read_exchange(spark, f"file:{work}/sink", DELIVERED)) == list(range(9))


def test_a_run_into_the_exchange(spark, work):
    sink, progress = f"file:{work}/sink", ProgressTable(spark, f"{work}/progress")
    rules = grants(spark, ("odd", "1"))
    messages(spark, range(6)).write.parquet(f"{work}/in")
    stream = spark.readStream.schema(messages(spark, []).schema).parquet(f"{work}/in")
    streams.run_federation(stream, rules, sink, f"{work}/c", server="s", progress=progress, exchange=True).awaitTermination()
    assert offsets(read_exchange(spark, sink, DELIVERED, topic="s-t", consumer="c")) == [1, 3, 5]
    assert offsets(read_exchange(spark, sink, DELIVERED, consumer="open")) == list(range(6))
    letters = read_exchange(spark, sink, DEAD_LETTER).collect()
    assert sorted(r["offset"] for r in letters) == [0, 2, 4] and all(r["headers"][-1]["key"] == "Dead-Letter-Reason" for r in letters)
    found = {(r["client"], r["topic"], r["partition"]): r["next_offset"] for r in progress.current().collect()}
    assert found == {("c", "t", 1): 6, ("open", "t", 0): 5, ("open", "t", 1): 6}


def test_batches_go_by_the_version_they_were_planned_with(spark, work):
    table = VersionedTable(spark, f"{work}/grants")
    with pytest.raises(ValueError, match="no version"):
        table.bound(0)
    assert table.publish(spark.range(1)) == 0 and table.bound(0).count() == 1
    assert table.publish(spark.range(2)) == 1
    # Another driver finds the mark of the first.
    again = VersionedTable(spark, f"{work}/grants")
    assert again.bound(0).count() == 1 and again.bound(1).count() == 2 and again.version_of(1) == 1
    again.KEEP = 3
    for batch in range(2, 8):
        again.publish(spark.range(batch + 1))
        assert again.bound(batch).count() == batch + 1
    assert len(again._marks()) <= 4 and min(again._versions()) >= 3 and again.bound(7).count() == 8
