"""Configuration that is read again when it gets old."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from covenant.session import create_mark, list_names, remove_path, scratch_path, written


class Refreshed:
    """A DataFrame loaded again once ``ttl`` seconds have passed, or on demand.

    Each load is written as a table of its own below the shared folder, so that whatever reads the frame until the next
    load sees one version, also when the source changes meanwhile. Ask for it inside ``foreachBatch``.
    """

    # Fixed value: seconds a loaded document stays valid by default.
    DEFAULT_TTL = 3600.0

    def __init__(
        self,
        load: Callable[[], DataFrame],
        ttl: float = DEFAULT_TTL,
        clock: Callable[[], float] = time.monotonic,
    ) -> None:
        self._load, self._ttl, self._clock = load, ttl, clock
        self._value: DataFrame | None = None
        self._loaded_at = 0.0

    def get(self) -> DataFrame:
        if self._value is None or self._clock() - self._loaded_at >= self._ttl:
            self.refresh()
        return self._value

    def refresh(self) -> DataFrame:
        loaded = self._load()
        self._value, self._loaded_at = written(loaded, scratch_path(loaded.sparkSession, "refreshed")), self._clock()
        return self._value

    def clear(self) -> None:
        self._value = None


class VersionedTable:
    """A table whose versions are kept below a shared path, and which version each micro-batch goes by.

    A batch is bound to the newest version when it is first planned, by a mark that is created before anything is decided. An
    attempt that is repeated, by this driver or the next, finds the mark and decides alike, whatever was published meanwhile.
    Marks of the last ``KEEP`` batches stay, and with them the versions they name; older ones are removed.
    """

    # Fixed value: batches whose version is remembered.
    KEEP = 100

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def _versions(self) -> list[int]:
        names = list_names(self.spark, f"{self.path}/versions")
        found = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
        return sorted(v for v in found if "_SUCCESS" in list_names(self.spark, f"{self.path}/versions/version={v}"))

    def _marks(self) -> dict[int, int]:
        """Version by batch."""
        pairs = (n.split(".version=") for n in list_names(self.spark, f"{self.path}/batches") if ".version=" in n)
        return {int(batch.removeprefix("batch=")): int(version) for batch, version in pairs}

    def publish(self, rows: DataFrame) -> int:
        """Write a new version; batches planned from now on go by it."""
        version = (self._versions() or [-1])[-1] + 1
        rows.write.mode("overwrite").parquet(f"{self.path}/versions/version={version}")
        return version

    def version_of(self, batch: int) -> int:
        """The version a batch goes by, bound now if it is not yet."""
        marks = self._marks()
        if batch in marks:
            return marks[batch]
        versions = self._versions()
        if not versions:
            raise ValueError(f"no version was published below {self.path}")
        create_mark(self.spark, f"{self.path}/batches/batch={batch}.version={versions[-1]}")
        old = {b: v for b, v in marks.items() if b <= batch - self.KEEP}
        kept = {v for b, v in marks.items() if b not in old} | {versions[-1]}
        for b, v in old.items():
            remove_path(self.spark, f"{self.path}/batches/batch={b}.version={v}")
        for version in versions:
            if version < min(kept):
                remove_path(self.spark, f"{self.path}/versions/version={version}")
        return versions[-1]

    def read(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/versions/version={version}")

    def bound(self, batch: int) -> DataFrame:
        """The version that a batch goes by."""
        return self.read(self.version_of(batch))
