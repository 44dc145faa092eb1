"""Comparing two snapshots of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Actions of a diff.
ADD, DELETE, REPLACE, KEEP = "ADD", "DELETE", "REPLACE", "KEEP"


def last_request_wins(requests: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The latest row of each key. An aggregate, so repeats of a key fold before the shuffle."""
    others = [c for c in requests.columns if c not in keys and c != order]
    latest = F.max(F.struct(order, *others))
    return (
        requests.groupBy(*keys)
        .agg(latest.alias("__latest"))
        .select(*keys, F.col(f"__latest.{order}").alias(order), *[F.col(f"__latest.{c}").alias(c) for c in others])
        .select(*requests.columns)
    )


def snapshot_diff(
    current: DataFrame,
    requested: DataFrame,
    keys: Sequence[str],
    *,
    compare: Sequence[str] | None = None,
    scope: Column | None = None,
    order: str | None = None,
) -> DataFrame:
    """Action per key to get from one snapshot to the other, with both rows as structs.

    ``scope`` limits both sides (rows outside are left alone); ``compare`` names the columns that make a difference,
    by default all but the key. With ``order`` repeated requested keys are settled first.
    """
    values = list(compare or [c for c in requested.columns if c not in keys and c != order])
    if scope is not None:
        current, requested = current.where(scope), requested.where(scope)
    if order is not None:
        requested = last_request_wins(requested.select(*keys, order, *values), keys, order)
    old = current.select(*keys, F.struct(*values).alias("current"), F.lit(True).alias("__old"))
    new = requested.select(*keys, F.struct(*values).alias("requested"), F.lit(True).alias("__new"))
    action = (
        F.when(F.col("__new").isNull(), DELETE)
        .when(F.col("__old").isNull(), ADD)
        .when(F.col("current").eqNullSafe(F.col("requested")), KEEP)
        .otherwise(REPLACE)
    )
    return old.join(new, list(keys), "full_outer").select(*keys, action.alias("action"), "current", "requested")
