"""Small tables that every micro-batch adds to: a log of runs, folded into snapshots."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from covenant.session import list_names, remove_path

#: Log folders that are kept before they are folded into a snapshot.
EVERY = 20


class Journal:
    """Rows of runs below ``path``: ``log/run=N`` as they come, ``snapshot/upto=N`` for all runs up to N, folded.

    A run's rows replace those of an earlier attempt at it, so a run that may still be repeated is never folded: a snapshot is
    written when a later run commits, and holds the runs before that one. Readers take the newest finished snapshot and the
    log after it; a snapshot is finished when its ``_SUCCESS`` is there, which is the switch. What two snapshots cover is removed,
    so that readers of the one before are not disturbed, and the number of folders stays below twice ``every`` and a few.

    ``fold`` gives fewer rows of the same columns that mean the same, whatever is folded first; ``run`` is among the columns.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, fold: Callable[[DataFrame], DataFrame], *, every: int = EVERY) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.fold = fold
        self.every = every

    def _runs(self) -> list[int]:
        return sorted(int(m[1]) for n in list_names(self.spark, f"{self.path}/log") if (m := re.fullmatch(r"run=(-?\d+)", n)))

    def _snapshots(self) -> list[int]:
        found = [int(m[1]) for n in list_names(self.spark, f"{self.path}/snapshot") if (m := re.fullmatch(r"upto=(-?\d+)", n))]
        return sorted(s for s in found if "_SUCCESS" in list_names(self.spark, f"{self.path}/snapshot/upto={s}"))

    def _read(self, snapshots: list[int], runs: list[int]) -> DataFrame:
        """The newest of some snapshots and the runs after it."""
        after = snapshots[-1] if snapshots else None
        paths = [f"{self.path}/snapshot/upto={after}"] if snapshots else []
        paths += [f"{self.path}/log/run={r}" for r in runs if after is None or r > after]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def commit(self, rows: DataFrame, run: int) -> None:
        """Save the rows of a run, which has ended by now; all runs before it have, too."""
        rows.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/log/run={run}")
        self.compact(run)

    def compact(self, before: int) -> None:
        """Fold the runs before this one, if they are many, and remove what the last two snapshots cover."""
        runs, snapshots = self._runs(), self._snapshots()
        earlier = [s for s in snapshots if s < before]
        settled = [r for r in runs if r < before and (not earlier or r > earlier[-1])]
        if len(settled) < self.every:
            return
        upto = settled[-1]
        # As many files as the fold has partitions: a snapshot may hold as much as everything delivered.
        folded = self.fold(self._read(earlier, settled)).select(*self.schema.fieldNames())
        folded.write.mode("overwrite").parquet(f"{self.path}/snapshot/upto={upto}")
        if earlier:
            for run in (r for r in runs if r <= earlier[-1]):
                remove_path(self.spark, f"{self.path}/log/run={run}")
            for snapshot in earlier[:-1]:
                remove_path(self.spark, f"{self.path}/snapshot/upto={snapshot}")

    def rows(self, before: int | None = None) -> DataFrame:
        """Rows of all runs, or of those before a run: what an earlier attempt at that run wrote is not among them."""
        snapshots, runs = self._snapshots(), self._runs()
        if before is not None:
            snapshots, runs = [s for s in snapshots if s < before], [r for r in runs if r < before]
        return self._read(snapshots, runs)

    def folders(self) -> int:
        """How many folders there are now."""
        return len(self._runs()) + len(self._snapshots())
