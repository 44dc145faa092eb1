"""Starts and limits of message tables."""

import os

import pyarrow as pa
import pytest

from covenant.schemas import MESSAGE
from covenant.sources import messages as source
from covenant.sources import objects


def table(spark, places):
    return spark.createDataFrame([(t, p, o, None, None, str(o).encode(), []) for t, p, o in places], MESSAGE)


def found(df):
    return sorted((r["topic"], r["partition"], r["offset"]) for r in df.collect())


def test_starts_and_limits_of_frames_and_files(spark, work):
    places = [(t, p, o) for t in "tu" for p in (0, 1) for o in range(6)]
    df = table(spark, places)
    df.write.parquet(f"{work}/m")
    start = {"t": {"0": 4, "1": source.LATEST}, "u": {"1": source.EARLIEST}}
    wanted = sorted(x for x in places if (x[0], x[1]) != ("t", 1) and (x[:2] != ("t", 0) or x[2] >= 4))
    for given in (df, f"{work}/m"):
        assert found(source.read_messages(spark, given, ["t", "u"], start=start, format="parquet")) == wanted
        assert found(source.read_messages(spark, given, ["t", "u"], start="latest", format="parquet")) == []
        few = source.read_messages(spark, given, ["t", "u"], max_records=6, format="parquet")
        assert found(few) == [("t", 0, 0), ("t", 0, 1), ("t", 1, 0), ("t", 1, 1), ("u", 0, 0), ("u", 1, 0)]
    with pytest.raises(ValueError):
        source.read_messages(spark, df, ["t"], max_records=0)


def test_only_files_that_hold_wanted_offsets_are_opened(spark, work):
    # Files of ten offsets each; one more file lies across two of them.
    for first in range(0, 60, 10):
        table(spark, [("t", 0, o) for o in range(first, first + 10) if o != 34]).coalesce(1).write.mode("append").parquet(f"{work}/m")
    table(spark, [("t", 0, 34), ("t", 0, 60), ("t", 1, 7)]).coalesce(1).write.mode("append").parquet(f"{work}/m")
    index = source.index_messages(spark.read.parquet(f"{work}/m"))
    assert index.count() == 8

    def starts(*rows):
        return spark.createDataFrame(rows, "topic string, partition int, offset bigint")

    df = source.read_from(spark, index, starts(("t", 0, 33)))
    assert found(df) == [("t", 0, o) for o in range(33, 61)] and len(df.inputFiles()) == 4
    df = source.read_from(spark, index, starts(("t", 0, 13)), max_records=9)
    assert found(df) == [("t", 0, o) for o in range(13, 22)] and len(df.inputFiles()) == 2
    df = source.read_from(spark, index, starts(("t", 0, 33), ("t", 1, source.EARLIEST)), max_records=3)
    assert found(df) == [("t", 0, 33), ("t", 0, 34), ("t", 0, 35), ("t", 1, 7)]
    df = source.read_from(spark, index, starts(("t", 0, source.LATEST), ("x", 0, 1), ("t", 1, None), ("t", 0, 61)))
    assert found(df) == []


def test_small_files_are_read_together(work, monkeypatch):
    os.makedirs(work, exist_ok=True)
    sizes = [10, 0, 30, 100, 5, 5]
    for i, size in enumerate(sizes):
        with open(f"{work}/f{i}", "wb") as out:
            out.write(b"x" * size)
    monkeypatch.setattr(objects, "GATHER_BYTES", 40)
    uris = [f"file:{work}/f{i}" for i in range(3)] + [f"file:{work}/none"] + [f"file:{work}/f{i}" for i in range(3, 6)]
    read = list(objects._read_whole([pa.RecordBatch.from_pydict({"uri": uris})]))
    assert [b.num_rows for b in read] == [4, 1, 2]
    rows = [r for b in read for r in b.to_pylist()]
    assert [r["uri"] for r in rows] == uris and [r["size"] for r in rows] == [10, 0, 30, None, 100, 5, 5]
    assert [r["error"] for r in rows] == [None] * 3 + ["FETCH: FileNotFoundError"] + [None] * 3
