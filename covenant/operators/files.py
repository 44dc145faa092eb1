"""Referenced files: decoding and checking requests, cutting into chunks, putting together and verifying."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covenant.functions.checksums import checksum_status
from covenant.functions.text import base_name, is_blank
from covenant.operators.joins import keyed_join
from covenant.schemas import FILE_REQUEST

# Storage kinds of a file reference, reject reasons and the default chunk size in bytes.
S3, AZURE, GCP, LOCAL = "S3", "AZURE", "GCP", "LOCAL"
DESERIALIZATION, VALIDATION, FETCH = "DESERIALIZATION", "VALIDATION", "FETCH"
DEFAULT_CHUNK_SIZE = 1_000_000

# Chunks joined into one binary value at most; larger files stay a sequence of blocks of this many chunks.
BLOCK_CHUNKS = 64


def file_uri(source_type: Column, container: Column, path: Column, azure_account: str | None = None) -> Column:
    """Filesystem URI of a reference, understood by Spark's and Arrow's filesystems; null for AZURE without an account."""
    host = F.lit(f"@{azure_account}.dfs.core.windows.net/" if azure_account else None).cast("string")
    key = F.regexp_replace(path, "^/+", "")
    return (
        F.when(source_type == S3, F.concat(F.lit("s3a://"), container, F.lit("/"), key))
        .when(source_type == AZURE, F.concat(F.lit("abfss://"), container, host, key))
        .when(source_type == GCP, F.concat(F.lit("gs://"), container, F.lit("/"), key))
        .when(source_type == LOCAL, F.concat(F.lit("file:"), path))
    )


def decode_file_requests(messages: DataFrame, azure_account: str | None = None) -> DataFrame:
    """File references out of message values: the message position as sequence id, the parsed reference, its URI.

    ``parse_state`` is ``OK``, ``NULL`` (no value, or JSON null) or ``BAD`` (not a usable JSON object).
    """
    text = F.col("value").cast("string")
    parsed = messages.withColumn(
        "__r",
        F.from_json(
            text,
            f"{FILE_REQUEST}, broken string",
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"},
        ),
    )
    state = (
        F.when(F.col("value").isNull() | (F.trim(text) == "null"), "NULL")
        .when(F.col("__r").isNull() | F.col("__r.broken").isNotNull() | ~F.ltrim(text).startswith("{"), "BAD")
        .otherwise("OK")
    )
    source_type, container, path = (F.col(f"__r.{n}") for n in ("sourceType", "storageContainer", "path"))
    return parsed.select(
        *[c for c in messages.columns if c not in ("value", "offset")],
        F.col("offset").alias("file_sequence_id"),
        state.alias("parse_state"),
        source_type.alias("source_type"),
        container.alias("storage_container"),
        path.alias("path"),
        file_uri(source_type, container, path, azure_account).alias("uri"),
    )


def check_file_requests(
    requests: DataFrame, listing: DataFrame | None = None, *, salt: bool = False
) -> DataFrame:
    """Add ``reason`` and ``details``: null for a valid request.

    ``listing`` has ``uri, is_file, size`` of objects that exist and, if it has the column, an ``error`` for those that
    could not be asked about, which are FETCH rejects. With it, missing objects and local directories are rejected too,
    and valid requests get their ``size``.
    """
    kind, path = F.col("source_type"), F.col("path")
    known = kind.isin(S3, AZURE, GCP, LOCAL)
    problem = (
        F.when(F.col("parse_state") == "NULL", F.struct(F.lit(VALIDATION), F.lit("request is null")))
        .when(F.col("parse_state") == "BAD", F.struct(F.lit(DESERIALIZATION), F.lit("not a file request")))
        .when(kind.isNull() | path.isNull(), F.struct(F.lit(DESERIALIZATION), F.lit("type and path are required")))
        .when(~known, F.struct(F.lit(DESERIALIZATION), F.concat(F.lit("unknown type "), kind)))
        .when(is_blank(path), F.struct(F.lit(VALIDATION), F.lit("path is blank")))
        .when(
            (kind != LOCAL) & is_blank(F.col("storage_container")),
            F.struct(F.lit(VALIDATION), F.lit("storage container is required")),
        )
        .when(F.col("uri").isNull(), F.struct(F.lit(VALIDATION), F.lit("no storage account is configured")))
    )
    checked = requests.withColumn("__p", problem)
    if listing is not None:
        failure = F.col("error") if "error" in listing.columns else F.lit(None).cast("string")
        found = listing.select("uri", F.col("is_file").alias("__is_file"), F.col("size"), failure.alias("__error"))
        checked = keyed_join(
            checked.drop("size"), found, ["uri"], how="left", spread=["file_sequence_id"], salt=salt
        )
        checked = checked.withColumn(
            "__p",
            F.when(F.col("__p").isNotNull(), F.col("__p"))
            .when(F.col("__error").isNotNull(), F.struct(F.lit(FETCH), F.col("__error").alias("col2")))
            .when(
                F.col("__is_file").isNull(),
                F.struct(F.lit(VALIDATION), F.concat(F.lit("object does not exist: "), path)),
            )
            .when(
                (kind == LOCAL) & ~F.col("__is_file"),
                F.struct(F.lit(VALIDATION), F.concat(F.lit("not a file: "), path)),
            ),
        ).drop("__is_file", "__error")
    return (
        checked.withColumn("reason", F.col("__p.col1")).withColumn("details", F.col("__p.col2")).drop("__p")
    )


def valid_file_requests(checked: DataFrame) -> DataFrame:
    return checked.where("reason IS NULL").drop("reason", "details", "parse_state")


def rejected_file_requests(checked: DataFrame) -> DataFrame:
    """Rejects as ``(file_sequence_id, reason, details)`` with the request's topic and partition."""
    return checked.where("reason IS NOT NULL").select("topic", "partition", "file_sequence_id", "reason", "details")


def chunk_files(files: DataFrame, chunk_size: int = DEFAULT_CHUNK_SIZE, *, by: Sequence[str] = ()) -> DataFrame:
    """Cut ``(file_sequence_id, file_name, content)`` into fixed-size chunks and one closing marker per file.

    Sequence ids are unique within a partition of a topic only: ``by`` names the columns that go with them, and every
    chunk carries them. The marker follows the last data chunk and carries the digest of the whole file; an empty file is its marker only.
    """
    size = F.octet_length("content")
    sized = files.withColumn("total_chunks", F.ceil(size / F.lit(chunk_size)).cast("int")).withColumn(
        "file_size", size.cast("bigint")
    )
    numbered = sized.withColumn("chunk_index", F.explode(F.sequence(F.lit(0), F.col("total_chunks"))))
    last = F.col("chunk_index") == F.col("total_chunks")
    return numbered.select(
        *by,
        "file_sequence_id",
        base_name(F.col("file_name")).alias("file_name"),
        "chunk_index",
        "total_chunks",
        last.alias("is_last_chunk"),
        F.when(~last, F.substring("content", F.col("chunk_index") * chunk_size + 1, F.lit(chunk_size))).alias(
            "chunk_data"
        ),
        "file_size",
        F.when(last, F.sha2("content", 256)).alias("file_checksum"),
    )


_JOINED = "listagg(CASE WHEN NOT is_last_chunk THEN chunk_data END) WITHIN GROUP (ORDER BY chunk_index)"
_FILE_KEYS = ["file_sequence_id", "file_name"]


def _keys(by: Sequence[str]) -> list[str]:
    return [*by, *_FILE_KEYS]


_VALUES = ("chunk_data", "total_chunks", "file_size", "file_checksum")


def _parts() -> list[Column]:
    last = F.col("is_last_chunk")
    return [
        F.expr(f"coalesce({_JOINED}, X'')").alias("content"),
        F.count_if(~last).cast("bigint").alias("chunk_count"),
        F.max(F.when(last, F.col("chunk_index"))).alias("marker_index"),
        F.max("total_chunks").alias("total_chunks"),
        F.max("file_size").alias("file_size"),
        F.max(F.when(last, F.col("file_checksum"))).alias("file_checksum"),
        F.count_if("conflict").cast("bigint").alias("conflicting"),
    ]


def _one_copy(keys: Sequence[str], chunks: DataFrame) -> DataFrame:
    """One of the copies of every chunk, as a whole: of copies that differ the greatest, and ``conflict`` is true."""
    copy = F.struct(*_VALUES)
    picked = chunks.groupBy(*keys, "is_last_chunk", "chunk_index").agg(
        F.max(copy).alias("__copy"), (F.min(copy) != F.max(copy)).alias("conflict")
    )
    return picked.select(*keys, "is_last_chunk", "chunk_index", "__copy.*", "conflict")


def block_of(chunk_index: Column, block_chunks: int) -> Column:
    """Block of a chunk. A marker after a full block makes an empty block of its own, so full blocks need not wait."""
    return F.floor(chunk_index / F.lit(block_chunks)).cast("int")


def file_digests(blocks: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Size and digest of finished files from their blocks, read in order with one block in memory at a time.

    SHA-256 is sequential, so a file is one pass; its blocks were joined in parallel before. A block that is a whole file may
    bring its ``digest`` and no content. Missing blocks or chunks show as a wrong size and digest; a repeated block is read
    once.
    """
    keys = _keys(by)
    given = {f.name for f in blocks.schema.fields}
    ordered = (
        blocks.select(
            *keys,
            "block_index",
            "content",
            (F.col("size") if "size" in given else F.octet_length("content")).cast("bigint").alias("size"),
            (F.col("digest") if "digest" in given else F.lit(None)).cast("string").alias("digest"),
            F.col("chunk_count").cast("bigint").alias("chunk_count"),
            "marker_index",
            "total_chunks",
            "file_size",
            "file_checksum",
            (F.col("conflicting") if "conflicting" in given else F.lit(0)).cast("bigint").alias("conflicting"),
        )
        .repartition(*keys)
        .sortWithinPartitions(*keys, "block_index")
    )
    key_fields = [field for field in ordered.schema.fields if field.name in keys]
    return ordered.mapInArrow(_block_folder(keys), T.StructType(key_fields + _DIGEST_FIELDS))


_DIGEST_FIELDS = [
    T.StructField("chunk_count", T.LongType()),
    T.StructField("block_count", T.IntegerType()),
    T.StructField("total_chunks", T.IntegerType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("file_checksum", T.StringType()),
    T.StructField("conflicting", T.LongType()),
    T.StructField("actual_size", T.LongType()),
    T.StructField("actual_checksum", T.StringType()),
]
_DIGEST_ARROW = [
    ("chunk_count", pa.int64()),
    ("block_count", pa.int32()),
    ("total_chunks", pa.int32()),
    ("file_size", pa.int64()),
    ("file_checksum", pa.string()),
    ("conflicting", pa.int64()),
    ("actual_size", pa.int64()),
    ("actual_checksum", pa.string()),
]
_BLOCK_FACTS = (
    "block_index",
    "size",
    "digest",
    "chunk_count",
    "marker_index",
    "total_chunks",
    "file_size",
    "file_checksum",
    "conflicting",
)


class _OpenFile:
    """Running totals of the file whose blocks are being read."""

    def __init__(self, key: tuple) -> None:
        self.key = key
        self.digest = hashlib.sha256()
        self.known = None
        self.size = self.chunks = self.blocks = self.conflicting = 0
        self.finished = False
        self.last_block = None
        self.total_chunks = self.file_size = self.checksum = None

    def add(self, facts: dict, content: pa.Scalar) -> None:
        if facts["block_index"] == self.last_block:
            return
        self.last_block = facts["block_index"]
        if facts["digest"] is None:
            self.digest.update(content.as_buffer() or b"")
        else:
            self.known = facts["digest"]
        self.size += facts["size"] or 0
        self.chunks += facts["chunk_count"]
        self.blocks += 1
        self.conflicting += facts["conflicting"]
        self.total_chunks = _larger(self.total_chunks, facts["total_chunks"])
        self.file_size = _larger(self.file_size, facts["file_size"])
        if facts["marker_index"] is not None:
            self.finished, self.checksum = True, facts["file_checksum"]

    def row(self, names: Sequence[str]) -> dict:
        # Blocks after a whole one are leftovers of copies that differed in their length: no digest fits them.
        whole = self.known is not None and self.blocks == 1
        return {
            **dict(zip(names, self.key)),
            "chunk_count": self.chunks,
            "block_count": self.blocks,
            "total_chunks": self.total_chunks,
            "file_size": self.file_size,
            "file_checksum": self.checksum,
            "conflicting": self.conflicting,
            "actual_size": self.size,
            "actual_checksum": self.known if whole else self.digest.hexdigest(),
        }


def _larger(a, b):
    return a if b is None else b if a is None else max(a, b)


def _block_folder(keys: Sequence[str]):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = schema = None
        for batch in batches:
            schema = pa.schema([batch.schema.field(k) for k in keys] + [pa.field(*f) for f in _DIGEST_ARROW])
            done = []
            facts = batch.select([*keys, *_BLOCK_FACTS]).to_pylist()
            contents = batch.column("content")
            for i, row in enumerate(facts):
                key = tuple(row[k] for k in keys)
                if current is None or current.key != key:
                    if current is not None and current.finished:
                        done.append(current.row(keys))
                    current = _OpenFile(key)
                current.add(row, contents[i])
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        if current is not None and current.finished:
            yield pa.RecordBatch.from_pylist([current.row(keys)], schema=schema)

    return fold


def fold_repeats(chunks: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """One row per chunk of a file. Delivery is at least once, so copies of a chunk are not part of the file twice.

    Of copies that differ one is kept as a whole and ``conflict`` is true.
    """
    return _one_copy(_keys(by), chunks.withColumn("file_name", base_name(F.col("file_name"))))


def file_blocks(chunks: DataFrame, block_chunks: int = BLOCK_CHUNKS, *, by: Sequence[str] = ()) -> DataFrame:
    """The bytes of files in one form for all sizes: runs of ``block_chunks`` chunks, in the order of ``block_index``.

    A block never grows with its file, so a file holding most of the rows spreads over all tasks. ``by`` names columns that
    tell files with equal ids and names apart. Repeated chunks are folded as in :func:`fold_repeats`, by the one shuffle that
    brings a block together, and ``conflicting`` counts those whose copies differ; ``whole`` says that the block is its file,
    and has its ``digest``. No job runs before. Files whose marker is missing have their blocks, too, but no row in :func:`file_facts`.
    """
    keys = [*_keys(by), "block_index"]
    dealt = chunks.withColumn("file_name", base_name(F.col("file_name"))).withColumn(
        "block_index", block_of(F.col("chunk_index"), block_chunks)
    )
    blocks = _one_copy(keys, dealt.repartition(*keys)).groupBy(*keys).agg(*_parts())
    whole = F.coalesce(F.col("marker_index") < block_chunks, F.lit(False))
    return blocks.withColumn("whole", whole).withColumn("digest", F.when(F.col("whole"), F.sha2("content", 256)))


def file_facts(blocks: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """One row per finished file of :func:`file_blocks`, of any size: counts, expected and actual size and digest, no bytes.

    A file of one block is digested where the block is, and only its facts go on; the bytes of the others are read in order.
    """
    bytes_left = F.when(~F.col("whole"), F.col("content"))
    return file_digests(blocks.withColumns({"size": F.octet_length("content"), "content": bytes_left}), by=by)


def assemble_files(chunks: DataFrame, block_chunks: int = BLOCK_CHUNKS, *, by: Sequence[str] = ()) -> DataFrame:
    """Finished files (those whose marker arrived) of any size, with expected and actual size and digest; their bytes are in
    :func:`file_blocks`. ``by`` names columns that tell files with equal ids and names apart."""
    return file_facts(file_blocks(chunks, block_chunks, by=by), by=by)


def joined_blocks(blocks: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """The ``content`` of files as one value each, for files that a row can hold."""
    content = F.expr("listagg(content) WITHIN GROUP (ORDER BY block_index)")
    return blocks.groupBy(*_keys(by)).agg(content.alias("content"))


def verify_files(assembled: DataFrame) -> DataFrame:
    """Add ``checksum_status``, ``checksum_ok``, ``size_ok`` and ``error``; a digest problem is named before a size one."""
    status = checksum_status(F.col("file_checksum"), F.col("actual_checksum"))
    size_ok = F.coalesce(F.col("file_size") < 0, F.lit(True)) | (F.col("file_size") == F.col("actual_size"))
    return (
        assembled.withColumn("checksum_status", status)
        .withColumn("checksum_ok", F.col("checksum_status") != "FAIL")
        .withColumn("size_ok", size_ok)
        .withColumn(
            "error",
            F.when(~F.col("checksum_ok"), "CHECKSUM_MISMATCH").when(~F.col("size_ok"), "SIZE_MISMATCH"),
        )
    )


def chunk_counts(chunks: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Received, repeated, conflicting and missing chunks per file. Repeats are folded first, so no file is one big group.

    Copies of a chunk that differ are ``conflicting``: which of them is right only the file's digest can tell.
    """
    content = F.xxhash64("chunk_data", "file_checksum")
    per_chunk = (
        chunks.withColumn("file_name", base_name(F.col("file_name")))
        .groupBy(*_keys(by), "is_last_chunk", "chunk_index")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.max("total_chunks").alias("total_chunks"),
            F.coalesce(F.min(content) != F.max(content), F.lit(False)).alias("conflict"),
        )
    )
    data = ~F.col("is_last_chunk")
    counts = per_chunk.groupBy(*_keys(by)).agg(
        F.coalesce(F.sum(F.when(data, F.col("copies"))), F.lit(0)).alias("received"),
        F.count_if(data).alias("distinct_chunks"),
        F.max("total_chunks").alias("total_chunks"),
        F.coalesce(F.max(F.when(data, F.col("chunk_index"))) + 1, F.lit(0)).alias("seen_up_to"),
        F.bool_or("is_last_chunk").alias("finished"),
        F.count_if("conflict").alias("conflicting"),
    )
    return counts.select(
        *_keys(by),
        "received",
        (F.col("received") - F.col("distinct_chunks")).alias("repeated"),
        F.greatest(F.col("total_chunks") - F.col("distinct_chunks"), F.lit(0)).alias("missing"),
        (F.col("seen_up_to") != F.col("distinct_chunks")).alias("has_gaps"),
        "total_chunks",
        "finished",
        "conflicting",
    )


def file_progress(
    stored: DataFrame, rejects: DataFrame, keys: list[str] | None = None, *, pending: DataFrame | None = None
) -> DataFrame:
    """Next sequence id per key: past the highest stored or rejected file, but never past one of ``pending``, the files
    that failed or are not finished, which are to be read again. Nothing for keys without any file."""
    by = keys or ["topic"]
    here = [*by, F.col("file_sequence_id"), F.lit(False).alias("__open")]
    seen = stored.select(*here).unionByName(rejects.select(*here))
    if pending is not None:
        seen = seen.unionByName(pending.select(*by, "file_sequence_id", F.lit(True).alias("__open")))
    past = F.max(F.when(~F.col("__open"), F.col("file_sequence_id"))) + 1
    first_open = F.min(F.when(F.col("__open"), F.col("file_sequence_id")))
    return seen.groupBy(*by).agg(F.least(past, first_open).alias("next_sequence_id"))
