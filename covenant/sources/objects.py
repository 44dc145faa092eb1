"""Reading referenced objects in parallel, one reference at a time, without listing stores on the driver."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covenant.functions.text import base_name
from covenant.operators.files import DEFAULT_CHUNK_SIZE, FETCH

# Objects up to this size are read as one value; larger ones are read in ranges.
INLINE_BYTES = 64 * 1024 * 1024
_READ_STEP = 8 * 1024 * 1024


def open_filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow filesystem and path of a URI."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def scan_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Whole directories as ``uri, content, size``: Spark's own binary scan. It leaves out empty files."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return found.load(root).select(F.col("path").alias("uri"), "content", F.col("length").alias("size"))


def stat_files(requests: DataFrame, partitions: int | None = None) -> DataFrame:
    """``uri, is_file, size, error`` of the distinct referenced objects; many requests ask for one object once.

    Objects that do not exist have no row. Those a store gave no answer about have an ``error`` and nothing else.
    """
    uris = requests.where("uri IS NOT NULL").select("uri").distinct()
    return _spread(uris, partitions, "uri").mapInArrow(_stat, "uri string, is_file boolean, size bigint, error string")


def _spread(references: DataFrame, partitions: int | None, *columns: str) -> DataFrame:
    """Even shares of references. Their rows are tiny but the work behind each is not, so the number of partitions is
    fixed here; left to adaptive execution they would be merged into a few."""
    spark = references.sparkSession
    shares = partitions or max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism
    )
    return references.repartition(shares, *columns)


def _stat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("uri", pa.string()), ("is_file", pa.bool_()), ("size", pa.int64()), ("error", pa.string())])
    for batch in batches:
        found = []
        for uri in batch.column("uri").to_pylist():
            try:
                filesystem, path = open_filesystem(uri)
                info = filesystem.get_file_info(path)
            except (OSError, ValueError, pa.ArrowException) as problem:
                found.append({"uri": uri, "error": f"{FETCH}: {type(problem).__name__}"})
                continue
            if info.type != pafs.FileType.NotFound:
                is_file = info.type == pafs.FileType.File
                found.append({"uri": uri, "is_file": is_file, "size": info.size if is_file else None})
        yield pa.RecordBatch.from_pylist(found, schema=schema)


def read_files(listing: DataFrame, inline_bytes: int = INLINE_BYTES, partitions: int | None = None) -> DataFrame:
    """``uri, content, size, error`` of listed files up to ``inline_bytes``; :func:`read_large_chunks` takes the rest."""
    small = listing.where(F.col("is_file") & (F.col("size") <= inline_bytes)).select("uri")
    return _spread(small, partitions, "uri").mapInArrow(_read_whole, "uri string, content binary, size bigint, error string")


_WHOLE = pa.schema([("uri", pa.string()), ("content", pa.binary()), ("size", pa.int64()), ("error", pa.string())])


#: Bytes of files that a task gathers before it hands them on; a larger file goes by itself.
GATHER_BYTES = 4 << 20


def _read_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, held = [], 0
        for uri in batch.column("uri").to_pylist():
            row = {"uri": uri, "content": None, "size": None, "error": None}
            try:
                filesystem, path = open_filesystem(uri)
                with filesystem.open_input_stream(path) as stream:
                    row["content"] = stream.read()
                row["size"] = len(row["content"])
            except (OSError, ValueError, pa.ArrowException) as problem:
                row["error"] = f"{FETCH}: {type(problem).__name__}"
            if rows and held + (row["size"] or 0) > GATHER_BYTES:
                yield pa.RecordBatch.from_pylist(rows, schema=_WHOLE)
                rows, held = [], 0
            rows.append(row)
            held += row["size"] or 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_WHOLE)


def read_large_chunks(
    listing: DataFrame,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    *,
    inline_bytes: int = INLINE_BYTES,
    range_chunks: int = 64,
    partitions: int | None = None,
) -> DataFrame:
    """Chunks of listed files above ``inline_bytes``: ``uri`` and the chunk columns without the sequence id.

    A file is cut into ranges of ``range_chunks`` chunks that are read by different tasks. Its closing marker comes
    from a second pass that digests the file in order, a step at a time. What cannot be read gives a row with ``error``.
    """
    large = (
        listing.where(F.col("is_file") & (F.col("size") > inline_bytes))
        .withColumn("total_chunks", F.ceil(F.col("size") / F.lit(chunk_size)).cast("int"))
        .select("uri", "size", "total_chunks")
    )
    ranges = large.withColumn(
        "first_chunk", F.explode(F.sequence(F.lit(0), F.col("total_chunks") - 1, F.lit(range_chunks)))
    )
    ranges = _spread(ranges, partitions, "uri", "first_chunk")
    schema = "uri string, chunk_index int, total_chunks int, file_size bigint, chunk_data binary, file_checksum string, error string"
    data = ranges.mapInArrow(_range_reader(chunk_size, range_chunks), schema)
    markers = _spread(large, partitions, "uri").mapInArrow(_digest, schema)
    return data.unionByName(markers).select(
        "uri",
        base_name(F.col("uri")).alias("file_name"),
        "chunk_index",
        "total_chunks",
        F.col("file_checksum").isNotNull().alias("is_last_chunk"),
        "chunk_data",
        "file_size",
        "file_checksum",
        "error",
    )


_PIECES = pa.schema(
    [
        ("uri", pa.string()),
        ("chunk_index", pa.int32()),
        ("total_chunks", pa.int32()),
        ("file_size", pa.int64()),
        ("chunk_data", pa.binary()),
        ("file_checksum", pa.string()),
        ("error", pa.string()),
    ]
)


def _piece(
    row: dict, index: int, data: bytes | None, checksum: str | None, problem: Exception | None = None
) -> pa.RecordBatch:
    piece = {
        "uri": row["uri"],
        "chunk_index": index,
        "total_chunks": row["total_chunks"],
        "file_size": row["size"],
        "chunk_data": data,
        "file_checksum": checksum,
        "error": f"{FETCH}: {type(problem).__name__}" if problem else None,
    }
    return pa.RecordBatch.from_pylist([piece], schema=_PIECES)


def _range_reader(chunk_size: int, range_chunks: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                stop = min(row["first_chunk"] + range_chunks, row["total_chunks"])
                try:
                    filesystem, path = open_filesystem(row["uri"])
                    with filesystem.open_input_file(path) as source:
                        source.seek(row["first_chunk"] * chunk_size)
                        for index in range(row["first_chunk"], stop):
                            yield _piece(row, index, source.read(chunk_size), None)
                except (OSError, ValueError, pa.ArrowException) as problem:
                    yield _piece(row, row["first_chunk"], None, None, problem)

    return read


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            digest = hashlib.sha256()
            try:
                filesystem, path = open_filesystem(row["uri"])
                with filesystem.open_input_stream(path) as stream:
                    while step := stream.read(_READ_STEP):
                        digest.update(step)
                yield _piece(row, row["total_chunks"], None, digest.hexdigest())
            except (OSError, ValueError, pa.ArrowException) as problem:
                yield _piece(row, row["total_chunks"], None, None, problem)
