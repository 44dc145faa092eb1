"""Versioned landing: which name each received file gets, and which files may be published."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covenant.functions.naming import product_key, unversioned_destination, versioned_destination
from covenant.operators.joins import keyed_join
from covenant.operators.ranking import number_rows


def plan_versions(
    files: DataFrame, counters: DataFrame, *, width: int = 100_000, salt: bool = False, ties: Sequence[str] = ()
) -> DataFrame:
    """Final destination of every file of a run.

    ``files`` has ``destination, file_name, file_sequence_id``; ``counters`` has ``product_key, counter``. A product's
    only file keeps the plain name; two or more get the versions after its counter, in sequence order. ``ties`` orders files
    with equal sequence ids, as those of several partitions have.
    """
    keyed = files.withColumn("product_key", product_key(F.col("destination")))
    numbered = number_rows(
        keyed, ["product_key"], "file_sequence_id", number="__position", total="run_files", width=width, ties=ties
    )
    counted = keyed_join(
        numbered, counters, ["product_key"], how="left", spread=["file_sequence_id"], salt=salt
    ).withColumn("counter", F.coalesce("counter", F.lit(0)).cast("bigint"))
    version = F.when(F.col("run_files") > 1, F.col("counter") + F.col("__position"))
    return (
        counted.withColumn("version", version)
        .withColumn(
            "final_destination",
            F.when(
                F.col("version").isNull(), unversioned_destination(F.col("destination"), F.col("file_name"))
            ).otherwise(versioned_destination(F.col("destination"), F.col("file_name"), F.col("version"))),
        )
        .drop("__position", "counter")
    )


def _place(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def first_failures(
    results: DataFrame, run_keys: Sequence[str] = ("run",), *, order: Sequence[str] = ("file_sequence_id",)
) -> DataFrame:
    """Lowest failed sequence id of each run that had a failure; with several columns of ``order``, the lowest place."""
    return results.where(~F.col("ok")).groupBy(*run_keys).agg(F.min(_place(order)).alias("failed_at"))


def store_until_first_failure(
    results: DataFrame,
    run_keys: Sequence[str] = ("run",),
    *,
    salt: bool = False,
    order: Sequence[str] = ("file_sequence_id",),
) -> DataFrame:
    """Stored files a run may publish: those before its first failure in ``order``."""
    joined = keyed_join(
        results,
        first_failures(results, run_keys, order=order),
        list(run_keys),
        how="left",
        spread=["file_sequence_id"],
        salt=salt,
    )
    return joined.where(F.col("failed_at").isNull() | (_place(order) < F.col("failed_at"))).drop(
        "failed_at"
    )


def held_back(plan: DataFrame, failures: DataFrame, run_keys: Sequence[str] = ("run",)) -> DataFrame:
    """Products several runs of which are planned and one of which failed. Versions are given by product, so what another
    run would publish now could be replaced when the failed one is repeated: nothing of such a product is published."""
    runs = plan.select("product_key", *run_keys).distinct()
    several = runs.groupBy("product_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("product_key")
    failed = runs.join(failures.select(*run_keys), list(run_keys), "left_semi").select("product_key").distinct()
    return several.join(failed, "product_key", "left_semi")


def next_counters(
    plan: DataFrame,
    counters: DataFrame,
    failures: DataFrame,
    run_keys: Sequence[str] = ("run",),
    *,
    published: DataFrame | None = None,
) -> DataFrame:
    """Counters after a run: the highest version given, unless a run of the product failed (then unchanged).

    ``published`` holds ``product_key, version`` of files that reached their names although a publication before them in
    the product failed. A counter never stays below those, so that no later run can replace them.
    """
    failed = plan.join(failures.select(*run_keys), list(run_keys), "left_semi").select("product_key").distinct()
    advanced = (
        plan.where("version IS NOT NULL")
        .groupBy("product_key")
        .agg(F.max("version").alias("advanced"))
        .join(failed, "product_key", "left_anti")
    )
    if published is not None:
        reached = published.where("version IS NOT NULL").groupBy("product_key").agg(F.max("version").alias("advanced"))
        advanced = advanced.unionByName(reached).groupBy("product_key").agg(F.max("advanced").alias("advanced"))
    return counters.join(advanced, "product_key", "full_outer").select(
        "product_key", F.coalesce("advanced", "counter").cast("bigint").alias("counter")
    )
