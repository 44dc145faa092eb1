"""Storing received files: staged first, published afterwards."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covenant.functions.text import is_blank
from covenant.operators.files import AZURE, GCP, S3
from covenant.sources.objects import open_filesystem

#: Files are told apart by these columns; sequence ids alone are unique within a partition of a topic only.
KEYS = ("file_sequence_id",)

# ``target`` is where a file should go, ``uri`` where it is: null after a failure.
_RESULT = [
    T.StructField("target", T.StringType()),
    T.StructField("uri", T.StringType()),
    T.StructField("ok", T.BooleanType()),
    T.StructField("error", T.StringType()),
]
_RESULT_ARROW = [("target", pa.string()), ("uri", pa.string()), ("ok", pa.bool_()), ("error", pa.string())]
_PROBLEMS = (OSError, ValueError, AttributeError, pa.ArrowException)
_READ_BYTES = 1 << 20


def _schema(files: DataFrame, keys: Sequence[str]) -> T.StructType:
    return T.StructType([files.schema[k] for k in keys] + _RESULT)


class _Results:
    """Result rows of the files of a task, by their keys."""

    def __init__(self, keys: Sequence[str]) -> None:
        self.keys = keys
        self.rows: list[dict] = []
        self.schema: pa.Schema | None = None

    def read(self, batch: pa.RecordBatch) -> list[tuple]:
        """The keys of a batch's rows."""
        self.schema = pa.schema([batch.schema.field(k) for k in self.keys] + [pa.field(*f) for f in _RESULT_ARROW])
        return list(zip(*(batch.column(k).to_pylist() for k in self.keys), strict=True))

    def add(self, key: tuple, target: str, problem: Exception | None) -> None:
        row = {
            "target": target,
            "uri": None if problem else target,
            "ok": problem is None,
            "error": f"{type(problem).__name__}: {problem}" if problem else None,
        }
        self.rows.append(dict(zip(self.keys, key, strict=True)) | row)

    def taken(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, schema=self.schema)
            self.rows = []


def _create_folder(filesystem: pafs.FileSystem, path: str, folders: set[str]) -> None:
    """Create the folder of a file, unless it is one of ``folders``: those the task has created."""
    folder = path.rsplit("/", 1)[0]
    if folder not in folders:
        filesystem.create_dir(folder, recursive=True)
        folders.add(folder)


class _Landing:
    """One file being written. Local files appear under their name only when complete; stores publish on close."""

    def __init__(self, uri: str, folders: set[str]) -> None:
        self.filesystem, self.path = open_filesystem(uri)
        self.local = isinstance(self.filesystem, pafs.LocalFileSystem)
        if self.local:
            _create_folder(self.filesystem, self.path, folders)
        self.written = f"{self.path}.{uuid.uuid4().hex}.part" if self.local else self.path
        self.stream = self.filesystem.open_output_stream(self.written)

    def finish(self) -> None:
        self.stream.close()
        if self.local:
            self.filesystem.move(self.written, self.path)


def write_files(files: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Store ``content`` of each row at ``uri`` and report per file. Overwrites, so a repeated task does no harm.

    The result is lazy and writing is its side effect: write the result to a table before using it twice. A failure
    is a row with ``ok`` false, not an exception.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results, folders = _Results(keys), set()
        for batch in batches:
            uris, contents = batch.column("uri").to_pylist(), batch.column("content")
            for i, key in enumerate(results.read(batch)):
                problem = None
                try:
                    landing = _Landing(uris[i], folders)
                    landing.stream.write(contents[i].as_buffer() or b"")
                    landing.finish()
                except _PROBLEMS as found:
                    problem = found
                results.add(key, uris[i], problem)
            yield from results.taken()

    return files.select(*keys, "uri", "content").mapInArrow(write, _schema(files, keys))


def write_large_files(blocks: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Store files given as ordered blocks (``uri, block_index, content, file_checksum`` and the keys).

    Each file is streamed by one task with one block in memory, and published only when its digest is as promised. A
    repeated block is written once.
    """
    names = [*keys, "uri"]
    ordered = (
        blocks.select(*names, "block_index", "content", "file_checksum")
        .repartition(*names)
        .sortWithinPartitions(*names, "block_index")
    )
    return ordered.mapInArrow(_block_writer(keys), _schema(blocks, keys))


def _block_writer(keys: Sequence[str]):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results, folders = _Results(keys), set()
        current = landing = problem = None
        digest, expected, last_block = hashlib.sha256(), None, None

        def close() -> None:
            failure = problem
            if failure is None:
                try:
                    if expected and expected.lower() != digest.hexdigest():
                        raise ValueError("digest mismatch")
                    landing.finish()
                except _PROBLEMS as found:
                    failure = found
            results.add(current[0], current[1], failure)

        for batch in batches:
            uris, indexes = batch.column("uri").to_pylist(), batch.column("block_index").to_pylist()
            checksums, contents = batch.column("file_checksum").to_pylist(), batch.column("content")
            for i, key in enumerate(results.read(batch)):
                found_key = (key, uris[i])
                if found_key == current and indexes[i] == last_block:
                    continue
                last_block = indexes[i]
                if found_key != current:
                    if current is not None:
                        close()
                    current, problem, digest, expected = found_key, None, hashlib.sha256(), None
                    try:
                        landing = _Landing(uris[i], folders)
                    except _PROBLEMS as failure:
                        problem = failure
                expected = checksums[i] or expected
                if problem is None:
                    try:
                        content = contents[i].as_buffer() or b""
                        digest.update(content)
                        landing.stream.write(content)
                    except _PROBLEMS as failure:
                        problem = failure
            yield from results.taken()
        if current is not None:
            close()
            yield from results.taken()

    return write


def publish_files(staged: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Move ``staged_uri`` to ``uri`` for each row.

    A staged file that is gone was moved by an earlier attempt, if the target is there. Rows that state the digest of the file
    (``actual_checksum``) are believed only if the target has it: what else may lie there is not this file.
    """
    checks = "actual_checksum" in staged.columns

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results, folders = _Results(keys), set()
        for batch in batches:
            found = results.read(batch)
            sources, targets = batch.column("staged_uri").to_pylist(), batch.column("uri").to_pylist()
            digests = batch.column("actual_checksum").to_pylist() if checks else [None] * batch.num_rows
            for key, source, target, digest in zip(found, sources, targets, digests, strict=True):
                problem = None
                try:
                    _publish(source, target, digest, folders)
                except _PROBLEMS as failure:
                    problem = failure
                results.add(key, target, problem)
            yield from results.taken()

    columns = [*keys, "staged_uri", "uri", *(["actual_checksum"] if checks else [])]
    return staged.select(*columns).mapInArrow(publish, _schema(staged, keys))


def _publish(staged_uri: str, uri: str, digest: str | None, folders: set[str]) -> None:
    filesystem, source = open_filesystem(staged_uri)
    _, target = open_filesystem(uri)
    _create_folder(filesystem, target, folders)
    if filesystem.get_file_info(source).type == pafs.FileType.File:
        filesystem.move(source, target)
    elif filesystem.get_file_info(target).type != pafs.FileType.File:
        raise FileNotFoundError(staged_uri)
    elif digest is not None and _digest_of(filesystem, target) != digest:
        raise ValueError(f"another file is at {uri}")


def _digest_of(filesystem: pafs.FileSystem, path: str) -> str:
    digest = hashlib.sha256()
    with filesystem.open_input_stream(path) as stream:
        while piece := stream.read(_READ_BYTES):
            digest.update(piece)
    return digest.hexdigest()


def stored_uri(provider: Column, bucket: Column, key: Column) -> Column:
    """Reported location by storage kind; null for a store whose bucket is blank, which takes nothing."""
    remote = provider.isin(S3, AZURE, GCP)
    return F.when(remote & is_blank(bucket), F.lit(None).cast("string")).otherwise(
        F.when(provider == S3, F.concat(F.lit("s3://"), bucket, F.lit("/"), key))
        .when(provider == AZURE, F.concat(F.lit("azure://"), bucket, F.lit("/"), key))
        .when(provider == GCP, F.concat(F.lit("gs://"), bucket, F.lit("/"), key))
        .otherwise(key)
    )
