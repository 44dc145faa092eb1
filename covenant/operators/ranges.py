"""Sets of positions as ranges: folding, merging, and taking out what is covered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions are cut into stretches of this many, so that a hot key is many groups and a range meets few rows.
STRETCH = 1 << 16


def _islands(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merged ranges of each group of ``keys``, whose rows meet in one task."""
    order = Window.partitionBy(*keys).orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = ranges.withColumn("__new", (F.coalesce(before, F.col("first") - 2) + 1 < F.col("first")).cast("int"))
    numbered = marked.withColumn("__island", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy(*keys, "__island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.drop("__island")


def _across(folded: DataFrame) -> DataFrame:
    """Ranges (__key, __stretch, first, last) that are merged within the stretch of their first position, merged across stretches.

    How far the stretches before one reach is a row per stretch. Ranges that lie inside their stretch, behind that reach, are
    done; those that are within it are covered, and of the others a stretch has two at most, which meet by key.
    """
    shift = STRETCH.bit_length() - 1
    before = Window.partitionBy("__key").orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    reach = folded.groupBy("__key", "__stretch").agg(F.max("last").alias("__reach"))
    met = folded.join(reach.select("__key", "__stretch", F.max("__reach").over(before).alias("__before")), ["__key", "__stretch"])
    follows = F.coalesce(F.col("__before") + 1 >= F.col("first"), F.lit(False))
    ends = (F.shiftright("last", shift) == F.col("__stretch")) & (F.col("last").bitwiseAND(STRETCH - 1) < STRETCH - 1)
    inside = met.where(~follows & ends).select("__key", "first", "last")
    reaching = met.where((~follows & ~ends) | (follows & (F.col("last") > F.col("__before")))).select("__key", "first", "last")
    return inside.union(_islands(reaching, ["__key"]))


def _unkeyed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.select(*[F.col("__key")[f"k{i}"].alias(k) for i, k in enumerate(keys)], "first", "last")


def _key(keys: Sequence[str]) -> Column:
    """The keys as one value, which is equal to itself where they are null."""
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("__key")


def merge_ranges(ranges: DataFrame, keys: Sequence[str], *, short: bool = False) -> DataFrame:
    """``ranges`` (keys, first, last) as the fewest ranges that cover the same positions; adjacent ones are joined.

    Ranges without an end or with ``last < first`` are left out. They are merged within the stretch they begin in first, so that
    a key with most of them is merged by many tasks. ``short`` says that keys are many and have few ranges each: those of a key
    meet in one group then.
    """
    given = ranges.where("first <= last")
    if short:
        return _islands(given, keys)
    stretch = F.shiftright("first", STRETCH.bit_length() - 1).alias("__stretch")
    return _unkeyed(_across(_islands(given.select(_key(keys), stretch, "first", "last"), ["__key", "__stretch"])), keys)


def position_ranges(rows: DataFrame, keys: Sequence[str], position: str, *, short: bool = False) -> DataFrame:
    """The positions of ``rows`` as merged ranges (keys, first, last); null positions are left out, repeated ones count once.

    Positions are folded within their stretch first, so that a key with most of the rows is folded by many tasks. ``short`` is
    that of :func:`merge_ranges`.
    """
    stretch = F.shiftright(position, STRETCH.bit_length() - 1).alias("__stretch")
    at = F.col(position).cast("bigint").alias("__at")
    places = rows.where(F.col(position).isNotNull()).select(_key(keys), stretch.cast("bigint").alias("__stretch"), at).distinct()
    near = Window.partitionBy("__key", "__stretch").orderBy("__at")
    islands = places.withColumn("__island", F.col("__at") - F.row_number().over(near))
    folded = islands.groupBy("__key", "__stretch", "__island").agg(F.min("__at").alias("first"), F.max("__at").alias("last"))
    if short:
        return merge_ranges(_unkeyed(folded, keys), keys, short=True)
    return _unkeyed(_across(folded.drop("__island")), keys)


def not_covered(rows: DataFrame, ranges: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """``rows`` whose position is in none of ``ranges`` (keys, first, last); those with a null key or position stay.

    Ranges are cut to the stretches that rows of their key lie in, so that the join costs what the rows do and not what was
    covered before.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    shift = STRETCH.bit_length() - 1
    placed = rows.withColumn("__stretch", F.shiftright(position, shift))
    asked = placed.select(*keys, "__stretch").distinct()
    spans = asked.groupBy(*keys).agg(F.min("__stretch").alias("__low"), F.max("__stretch").alias("__high"))
    low, high = F.greatest("__low", F.shiftright("first", shift)), F.least("__high", F.shiftright("last", shift))
    cut = ranges.join(spans, list(keys)).where(low <= high).withColumn("__stretch", F.explode(F.sequence(low, high)))
    cut = cut.join(asked, [*keys, "__stretch"], "left_semi")
    cut = cut.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col("__stretch").alias("__s"), "first", "last")
    on = (F.col("__stretch") == F.col("__s")) & F.col(position).between(F.col("first"), F.col("last"))
    for key, name in zip(keys, names, strict=True):
        on = on & (F.col(key) == F.col(name))
    return placed.join(cut, on, "left_anti").drop("__stretch")
