"""Ranges of positions, and the journals that keep them."""

import random

import pytest
from pyspark.sql import functions as F

from covenant.operators import ranges
from covenant.streaming.progress import KEYS, DeliveredTable, ProgressTable

SCHEMA = "client string, server string, topic string, partition int, offset bigint"


def rows(spark, places):
    return spark.createDataFrame([("c", "s", t, p, o) for t, p, o in places], SCHEMA)


def islands(positions):
    out = []
    for p in sorted(positions):
        if out and out[-1][1] + 1 == p:
            out[-1][1] = p
        else:
            out.append([p, p])
    return [tuple(r) for r in out]


def as_sets(df):
    found = {}
    for r in df.collect():
        found.setdefault((r["topic"], r["partition"]), []).append((r["first"], r["last"]))
    return {k: sorted(v) for k, v in found.items()}


@pytest.mark.parametrize("stretch", [4, 1 << 16])
def test_positions_as_ranges(spark, monkeypatch, stretch):
    monkeypatch.setattr(ranges, "STRETCH", stretch)
    rng = random.Random(stretch)
    places = [(rng.choice("tu"), 0, rng.randrange(60)) for _ in range(90)] + [("t", 1, -3), ("t", 1, -2), ("t", 1, None)]
    expected = {}
    for t, p, o in places:
        if o is not None:
            expected.setdefault((t, p), set()).add(o)
    got = ranges.position_ranges(rows(spark, places).repartition(3), KEYS, "offset")
    assert as_sets(got) == {k: islands(v) for k, v in expected.items()}
    asked = rows(spark, [("t", 0, i) for i in range(70)] + [("t", 1, -2), ("t", 1, 5), ("v", 0, 1), (None, 0, 1), ("t", 0, None)])
    left = ranges.not_covered(asked, got, KEYS, "offset").collect()
    outside = {("t", 0, i) for i in range(70)} - {("t", 0, i) for i in expected["t", 0]}
    assert {(r["topic"], r["partition"], r["offset"]) for r in left} == outside | {("t", 1, 5), ("v", 0, 1), (None, 0, 1), ("t", 0, None)}


def test_merging(spark):
    given = [("a", 1, 3), ("a", 4, 6), ("a", 5, 5), ("a", 9, 12), ("a", 10, 11), ("b", 2, 1), ("b", 7, 7), ("b", 7, 7), ("c", 1, 100), ("c", 3, 4)]
    table = spark.createDataFrame(given, "k string, first bigint, last bigint")
    merged = {(r["k"], r["first"], r["last"]) for r in ranges.merge_ranges(table, ["k"]).collect()}
    assert merged == {("a", 1, 6), ("a", 9, 12), ("b", 7, 7), ("c", 1, 100)}
    assert ranges.merge_ranges(table.limit(0), ["k"]).collect() == []


@pytest.mark.parametrize("stretch", [4, 16])
def test_merging_across_stretches(spark, monkeypatch, stretch):
    monkeypatch.setattr(ranges, "STRETCH", stretch)
    rng = random.Random(stretch)
    given = [(rng.choice(["a", "b", None]), rng.choice([1, None]), p := rng.randrange(-200, 800), p + rng.choice([-1, 0, 1, 3, 4, 40])) for _ in range(220)]
    given += [("c", 1, 0, 3), ("c", 1, 4, 7), ("c", 1, 8, 90), ("c", 1, 9, 11), ("c", 1, 92, 93), ("d", 1, 3, None)]
    expected = {}
    for k, n, first, last in given:
        if last is not None:
            expected.setdefault((k, n), set()).update(range(first, last + 1))
    table = spark.createDataFrame(given, "k string, n int, first bigint, last bigint")
    for short in (False, True):
        got = {}
        for r in ranges.merge_ranges(table, ["k", "n"], short=short).collect():
            got.setdefault((r["k"], r["n"]), []).append((r["first"], r["last"]))
        assert {k: sorted(v) for k, v in got.items()} == {k: islands(v) for k, v in expected.items() if v}


def test_ranges_of_one_key_are_merged_by_many_tasks(spark, work, monkeypatch):
    monkeypatch.setattr(ranges, "STRETCH", 64)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        table = spark.range(0, 4000, 2).selectExpr("'a' AS k", "id AS first", "id AS last")
        merged = ranges.merge_ranges(table, ["k"])
        assert merged.count() == 2000 and merged.select(F.spark_partition_id()).distinct().count() > 4
        delivered = DeliveredTable(spark, f"{work}/delivered", every=2)
        for run in range(3):
            delivered.commit(rows(spark, [("t", 0, o) for o in range(run, 3000, 6)]), run)
        snapshot = spark.read.parquet(f"{work}/delivered/snapshot/upto=1")
        assert snapshot.count() == 500 and len(snapshot.inputFiles()) > 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_journals_stay_small_and_lose_nothing(spark, work):
    progress, delivered = ProgressTable(spark, f"{work}/progress", every=3), DeliveredTable(spark, f"{work}/delivered", every=3)
    everything = set()
    for run in range(14):
        # Batches come in no order of their offsets; the tenth is attempted twice, the first attempt with other rows.
        offsets = {run * 3 % 14 * 2, run * 3 % 14 * 2 + 1}
        for attempt in [{999}, offsets] if run == 10 else [offsets]:
            delivered.commit(rows(spark, [("t", 0, o) for o in attempt]), run)
            progress.commit(rows(spark, [("t", 0, max(attempt))]).withColumn("next_offset", F.col("offset") + 1), run)
        before = as_sets(delivered.ranges(before=run)).get(("t", 0), [])
        assert before == islands(everything)
        everything |= offsets
        assert as_sets(delivered.ranges())["t", 0] == islands(everything)
        assert [(r["next_offset"], r["run"]) for r in progress.current().collect()] == [(max(offsets) + 1, run)]
        assert max(progress.journal.folders(), delivered.journal.folders()) <= 10
    assert as_sets(delivered.ranges()) == {("t", 0): [(0, 27)]}


def test_an_unfinished_snapshot_is_not_read(spark, work):
    progress = ProgressTable(spark, f"{work}/progress", every=2)
    for run in range(5):
        progress.commit(rows(spark, [("t", 0, run)]).withColumn("next_offset", F.col("offset")), run)
    rows(spark, []).write.parquet(f"{work}/progress/snapshot/upto=4")
    spark.sparkContext._jvm.java.io.File(f"{work}/progress/snapshot/upto=4/_SUCCESS").delete()
    assert [r["next_offset"] for r in progress.current().collect()] == [4]
