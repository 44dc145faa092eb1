"""Files put together from a stream: state of numbers, marks that expire, attempts that are repeated."""

import hashlib
import random

from pyspark.sql import functions as F

from covenant.operators import files
from covenant.streaming.intake import Intake

CONTENTS = {i: (f"{i}-" * (i * 7)).encode() for i in range(7)}


def chunks(spark):
    table = spark.createDataFrame(
        [("t", i % 2, i, f"d/f{i}", data) for i, data in CONTENTS.items()],
        "topic string, partition int, file_sequence_id bigint, file_name string, content binary",
    )
    return files.chunk_files(table, 8, by=["topic", "partition"]).cache()


def found(intake):
    blocks = intake.blocks()
    if blocks is None:
        return {}
    facts = files.verify_files(files.file_facts(blocks, by=["topic", "partition"])).collect()
    assert all(r["error"] is None for r in facts) and len({r["file_sequence_id"] for r in facts}) == len(facts)
    return {r["file_sequence_id"]: r["actual_checksum"] for r in facts}


def test_files_in_any_order_and_attempts_repeated(spark, work):
    sent = chunks(spark)
    lost = sent.where("NOT (file_sequence_id = 2 AND chunk_index = 0)")
    dealt = [r.asDict() for r in lost.collect()] * 2
    random.Random(3).shuffle(dealt)
    intake = Intake(spark, f"{work}/in", block_chunks=3, every=2)
    for batch in range(5):
        part = spark.createDataFrame(dealt[batch::5], sent.schema)
        if batch == 2:
            intake.take(part.limit(3), batch)
        intake.take(part, batch)
        assert intake.journal.folders() <= 9
    wanted = {i: hashlib.sha256(data).hexdigest() for i, data in CONTENTS.items()}
    assert found(intake) == {i: digest for i, digest in wanted.items() if i != 2}
    # Of finished files there is a mark, of the unfinished one its ranges and its marker.
    state = intake.state().collect()
    assert {r["file_sequence_id"] for r in state if r["done_at"] is None} == {2}
    assert [(r["first"], r["last"]) for r in state if r["first"] is not None] == [(1, 3)]
    # Late repeats open nothing again; the missing chunk completes its file.
    intake.take(sent.where("file_sequence_id IN (1, 3)"), 5)
    intake.take(sent.where("file_sequence_id = 2 AND chunk_index = 0"), 6)
    assert found(intake) == wanted and all(r["done_at"] is not None for r in intake.state().collect())


def test_marks_expire(spark, work):
    sent = chunks(spark)
    intake = Intake(spark, f"{work}/in", ttl=3600)
    intake.take(sent, 0)
    assert intake.state().count() == len(CONTENTS)
    assert Intake(spark, f"{work}/in", ttl=0).state().count() == 0


def test_empty_batches(spark, work):
    intake = Intake(spark, f"{work}/in")
    intake.take(chunks(spark).where(F.lit(False)), 0)
    assert intake.blocks() is None and intake.state().collect() == []
