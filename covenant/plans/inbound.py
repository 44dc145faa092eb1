"""Receiving files: put together, verify, name, store, publish up to the first failure, advance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covenant.functions.naming import storage_key
from covenant.operators.files import AZURE, BLOCK_CHUNKS, GCP, LOCAL, S3, file_blocks, file_facts, file_progress, verify_files
from covenant.operators.joins import keyed_join
from covenant.operators.versions import first_failures, held_back, next_counters, plan_versions, store_until_first_failure
from covenant.session import check_reachable, settled
from covenant.sinks.files import publish_files, stored_uri, write_files, write_large_files

#: What names a received file: offsets repeat from partition to partition, and names anywhere.
FILE = ["run", "topic", "partition", "file_sequence_id"]
#: The order of a run's files, which gives versions and decides what comes before a failure.
ORDER = ["file_sequence_id", "topic", "partition"]

# Why a file that is in order itself is not stored.
DUPLICATE_TARGET, NO_BUCKET = "DUPLICATE_TARGET", "NO_BUCKET"


@dataclass
class Landing:
    """What a run of received files did, as tables below its work folder; rows of files carry ``FILE``."""

    plan: DataFrame
    results: DataFrame
    manifest: DataFrame
    published: DataFrame
    counters: DataFrame
    progress: DataFrame


def _named(chunks: DataFrame) -> DataFrame:
    """Chunks with topic and partition; where there are none, all are of one partition."""
    given = {
        "topic": F.coalesce("topic", F.lit("")) if "topic" in chunks.columns else F.lit(""),
        "partition": F.coalesce("partition", F.lit(0)) if "partition" in chunks.columns else F.lit(0),
    }
    return chunks.withColumns(given)


def _staged_name() -> Column:
    """One name per file of a run, whatever characters its topic has."""
    parts = [F.concat(F.octet_length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")) for c in FILE]
    return F.sha2(F.concat(*parts), 256)


def _with_duplicates(plan: DataFrame) -> DataFrame:
    """The plan with ``error`` for files whose place an earlier file of the plan has."""
    place = F.row_number().over(Window.partitionBy("uri").orderBy(*ORDER, "run"))
    return plan.withColumn("error", F.when(place > 1, F.lit(DUPLICATE_TARGET)))


def land_files(
    chunks: DataFrame,
    destinations: DataFrame,
    counters: DataFrame,
    root: str,
    work: str,
    *,
    block_chunks: int = BLOCK_CHUNKS,
    mounted: bool = False,
    provider: str = LOCAL,
    bucket: str = "",
) -> Landing:
    """Store the files of some runs below ``root``. On a cluster that is a store, a folder below the shared one, or, with
    ``mounted``, a path that all machines have mounted.

    ``chunks`` has the chunk columns, ``run`` and, where they come from several partitions, ``topic`` and ``partition``;
    ``destinations`` gives ``run, destination``. Files are stored under staging names, in any order. Then the *manifest* is
    written: the prefix of each run up to its first failure, in the order of sequence ids (then topics and partitions),
    with staging name, final name, size and digest of every file. It decides; publication moves what it lists. Two files of one
    final name are an error of the later one.

    All steps are tables below ``work``, a folder all executors reach. An attempt that is repeated with the same ``work``
    takes up finished steps: with a manifest it names and publishes nothing else, whatever counters or chunks it is given, and a
    file that was moved before is known by its digest. What is staged but not in the manifest stays below ``.staged``.

    ``provider`` and ``bucket`` say what the store is called where files are reported (``published.stored``). A remote store
    with a blank bucket takes nothing: S3 and GCP fail every file, AZURE goes on without storing any.
    """
    spark = chunks.sparkSession
    check_reachable(root, spark.sparkContext.master, spark.conf.get("spark.checkpoint.dir", None), mounted=mounted)
    base = root.rstrip("/")
    chunks = _named(chunks)
    by = FILE[:-1]
    skipped = provider in (S3, AZURE, GCP) and not bucket.strip()
    refused = skipped and provider != AZURE
    staged_uri = F.concat(F.lit(f"{base}/.staged/"), _staged_name())

    blocks = settled(spark, lambda: file_blocks(chunks, block_chunks, by=by), f"{work}/blocks")
    received = settled(
        spark,
        lambda: keyed_join(verify_files(file_facts(blocks, by=by)), destinations, ["run"], spread=["file_sequence_id"]),
        f"{work}/received",
    )
    final = storage_key(F.col("final_destination"), F.col("file_name"))
    plan = settled(
        spark,
        lambda: _with_duplicates(
            plan_versions(received.where("error IS NULL"), counters, ties=["topic", "partition", "run"])
            .withColumn("key", final)
            .withColumns(
                {
                    "uri": F.concat(F.lit(f"{base}/"), "key"),
                    "staged_uri": staged_uri,
                    "stored": stored_uri(F.lit(provider), F.lit(bucket), F.col("key")),
                }
            )
        ),
        f"{work}/plan",
    )

    def stored() -> DataFrame:
        """One result per file received: staged, or why not."""
        broken = received.select(*FILE, "error").unionByName(plan.select(*FILE, "error")).where("error IS NOT NULL")
        failed = broken.select(*FILE, F.lit(None).cast("string").alias("staged_uri"), F.lit(False).alias("ok"), "error")
        fine = plan.where("error IS NULL")
        if refused:
            return failed.unionByName(
                fine.select(
                    *FILE, F.lit(None).cast("string").alias("staged_uri"), F.lit(False).alias("ok"), F.lit(NO_BUCKET).alias("error")
                )
            )
        if skipped:
            return failed.unionByName(
                fine.select(
                    *FILE, F.lit(None).cast("string").alias("staged_uri"), F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error")
                )
            )
        # Files of one block are stored where their block is; the bytes of the others are brought into order anyway.
        uri = staged_uri.alias("uri")
        facts = blocks.where("whole").withColumns(
            {"actual_checksum": F.col("digest"), "actual_size": F.octet_length("content").cast("bigint")}
        )
        small = write_files(verify_files(facts).where("error IS NULL").select(*FILE, uri, "content"), FILE)
        names = fine.select(*FILE, "file_name", F.col("actual_checksum").alias("file_checksum"))
        parts = blocks.where("NOT whole").drop("file_checksum").join(names, [*FILE, "file_name"])
        large = write_large_files(parts.select(*FILE, uri, "block_index", "content", "file_checksum"), FILE)
        done = small.unionByName(large).join(fine.select(*FILE), FILE, "left_semi")
        return done.select(*FILE, F.col("target").alias("staged_uri"), "ok", "error").unionByName(failed)

    results = settled(spark, stored, f"{work}/results")
    failures = first_failures(results, order=ORDER)

    def listed() -> DataFrame:
        prefix = store_until_first_failure(results, order=ORDER).select(*FILE)
        columns = ["product_key", "version", "staged_uri", "uri", "stored", "actual_size", "actual_checksum"]
        rows = prefix.join(plan.select(*FILE, *columns), FILE)
        return rows.join(held_back(plan, failures), "product_key", "left_anti").select(*FILE, *columns)

    manifest = settled(spark, listed, f"{work}/manifest")

    def moved() -> DataFrame:
        if skipped:
            nothing = F.lit(None).cast("string")
            return manifest.select(*FILE, nothing.alias("target"), nothing.alias("uri"), F.lit(True).alias("ok"), nothing.alias("error"))
        return publish_files(manifest, FILE)

    reported = manifest.select(*FILE, "stored", "product_key", "version")
    published = settled(spark, lambda: moved().join(reported, FILE), f"{work}/published")
    published = published.withColumn("stored", F.when(F.col("ok"), F.col("stored")))
    done, undone = published.where("ok"), published.where(~F.col("ok"))
    # A failed publication ends its run as a failed store does. What came after it is under its name already, so the
    # counter of its product goes past that.
    stopped = first_failures(undone, order=ORDER)
    broken_products = undone.select("product_key").distinct()
    after = done.join(broken_products, "product_key", "left_semi").select("product_key", "version")
    # Everything that did not get to its name is read again: failed, held back, not published, or without its marker.
    pending = chunks.select(*FILE).distinct().join(done.select(*FILE), FILE, "left_anti")
    return Landing(
        plan=plan,
        results=results,
        manifest=manifest,
        published=published,
        counters=next_counters(plan, counters, failures.unionByName(stopped), published=after),
        progress=file_progress(done, done.limit(0), by, pending=pending),
    )
