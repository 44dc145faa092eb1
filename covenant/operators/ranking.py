"""Numbering the rows of groups of any size without putting a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    number: str = "row_number",
    total: str = "group_rows",
    width: int = 100_000,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Add the 1-based position of each row in its group by ``order`` (a whole number), then ``ties``, and the group's size.

    The order column is cut into ranges of ``width`` values. Ranges are numbered on their own, each starting where the
    row counts of the ranges before it end, so the largest sort is one range of one group and only the counts of a
    group meet in one task.
    """
    ranged = df.withColumn("__range", F.floor(F.col(order) / F.lit(width)))
    groups = [*keys, "__range"]
    counts = ranged.groupBy(*groups).agg(F.count(F.lit(1)).alias("__rows"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *groups,
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"),
        F.sum("__rows").over(whole).alias(total),
    )
    local = ranged.withColumn("__local", F.row_number().over(Window.partitionBy(*groups).orderBy(order, *ties)))
    return (
        local.join(starts, groups)
        .withColumn(number, F.col("__start") + F.col("__local"))
        .drop("__range", "__local", "__start")
    )
