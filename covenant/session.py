"""Session settings and the shared folder jobs may write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "covenant", cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine. On a cluster use the session it provides."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, whose executors are this very process, may do without the setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = f"{tempfile.gettempdir()}/covenant"
    return folder.rstrip("/")


def check_reachable(root: str, master: str, shared: str | None, *, mounted: bool = False) -> None:
    """Refuse a local folder that the executors of a cluster do not share: files staged there by one machine could not be
    published by another. ``mounted`` says that the folder is a mount that all of them have."""
    path, inside = (x and x.removeprefix("file://").removeprefix("file:").rstrip("/") for x in (root, shared))
    on_machine = root.startswith(("file:", "/"))
    if on_machine and not mounted and not master.startswith(("local[", "local ")) and master != "local":
        if not inside or not (path == inside or path.startswith(f"{inside}/")):
            raise ValueError(f"{root} is a folder of one machine; name one that all executors share, or say it is mounted")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: the plan behind it runs once and survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _located(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, as the session's filesystems see it."""
    filesystem, found = _located(spark, path)
    return filesystem.exists(found)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    filesystem, found = _located(spark, path)
    return [s.getPath().getName() for s in filesystem.listStatus(found)] if filesystem.exists(found) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path and all below it."""
    filesystem, found = _located(spark, path)
    filesystem.delete(found, True)


def create_mark(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it was there already."""
    filesystem, found = _located(spark, path)
    return filesystem.createNewFile(found)


def settled(spark: SparkSession, make: Callable[[], DataFrame], path: str) -> DataFrame:
    """The table an earlier attempt finished at ``path``, or else the one that ``make`` gives, written there."""
    if path_exists(spark, f"{path}/_SUCCESS"):
        return spark.read.parquet(path)
    return written(make(), path)
