"""Equi-joins with one side that may have hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: A key with this share of the rows is hot where a caller asks for salting.
HOT_SHARE = 0.02


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    how: str = "inner",
    spread: Sequence[str],
    residual: Column | None = None,
    salt: bool = False,
) -> DataFrame:
    """Equi-join on ``keys`` (columns named alike on both sides; the left ones are kept).

    Spark chooses: a side is broadcast below its threshold, judged by what it measured, and adaptive execution splits skewed
    shuffles. Inner, left, semi and anti joins only, whose left side it can split. With ``salt`` both sides are shuffled, one
    job counts the left keys, and the rows of a hot one are spread over several partitions by ``spread`` while the matching
    right rows are repeated once per partition: for sessions without adaptive execution, and for rows so large that a
    partition of average size is too much.
    """
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = None
    for key in keys:
        equal = left[key] == renamed[f"__r_{key}"]
        condition = equal if condition is None else condition & equal
    dropped = [f"__r_{key}" for key in keys]
    hot = _hot_keys(left, keys) if salt else {}
    if not hot:
        full = condition if residual is None else condition & residual
        other = renamed.hint("merge") if salt else renamed
        return left.join(other, full, how).drop(*dropped)
    salts = F.create_map(*[F.lit(v) for pair in hot.items() for v in pair])

    def copies(cols: list[Column]) -> Column:
        return F.coalesce(F.try_element_at(salts, F.xxhash64(*cols)), F.lit(1))

    salted = left.withColumn(
        "__salt", F.pmod(F.xxhash64(*spread), copies([F.col(k) for k in keys]).cast("bigint")).cast("int")
    )
    repeated = renamed.withColumn(
        "__r_salt", F.explode(F.sequence(F.lit(0), copies([F.col(d) for d in dropped]) - 1))
    )
    full = condition & (salted["__salt"] == repeated["__r_salt"])
    if residual is not None:
        full = full & residual
    return salted.join(repeated.hint("merge"), full, how).drop("__salt", "__r_salt", *dropped)


def shuffled_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` that shuffles both sides whatever Spark takes them for: for tables with a row per file.

    Before it has run, a Parquet table counts as its compressed bytes, shared out over its columns by their types. Numbers and
    names that differ little take up a fortieth of what they are in memory, so a table of hundreds of MB passes for one below
    the threshold and is collected by the driver.
    """
    return left.join(right.hint("merge"), list(keys), how)


def _hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> dict[int, int]:
    """Hashes of keys holding at least ``share`` of the rows, with the number of partitions each deserves.

    At most ``1 / share`` keys can qualify, so the result collected here is bounded. A hash collision only changes
    how a key is spread, never the result.
    """
    counts = df.groupBy(F.xxhash64(*keys).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    seen = Observation()
    largest = counts.observe(seen, F.sum("rows").alias("total")).orderBy(F.desc("rows")).limit(int(1 / share)).collect()
    if not largest:
        return {}
    total = seen.get["total"]
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return {
        row["key"]: max(2, -(-row["rows"] * partitions // total)) for row in largest if row["rows"] >= total * share
    }
