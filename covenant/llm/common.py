"""Helpers shared by the corpus operators: tables, row keys, and words of Arrow text columns as numpy arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Texts are handled in slices of about this many bytes, so that temporary arrays stay small.
SLICE_BYTES = 1 << 20

BATCH_ROWS = 1_000
BATCH_BYTES = 4 << 20

#: Words longer than this are hashed one by one.
LONG_WORD = 256

#: Bits of a filter of row keys. It is broadcast, and this bounds it; beyond it more rows pass than need to.
FILTER_BITS = 1 << 24

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32

#: The 8-byte loads of words that end within a block keep only the bytes of the word.
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*columns: str) -> Column:
    """64 bits naming a row by its content: equal rows share a key, and every operator gives them equal results."""
    return F.xxhash64(*[F.col(c) for c in columns])


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's text falls into the fold; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python workers in batches of at most BATCH_ROWS rows and BATCH_BYTES, for the session's queries from now on:
    a batch is held by the executor and the worker at once, and a row may be a whole text. Files are read in batches of as many
    rows."""
    settings = {"execution.arrow.maxRecordsPerBatch": BATCH_ROWS, "execution.arrow.maxBytesPerBatch": BATCH_BYTES, "parquet.columnarReaderBatchSize": BATCH_ROWS}
    for setting, most in settings.items():
        setting = f"spark.sql.{setting}"
        now = int(spark.conf.get(setting).rstrip("b"))
        if now <= 0 or now > most:
            spark.conf.set(setting, most)


#: What this worker keeps from task to task, by name, with the stage it was made in.
_KEPT: dict[str, tuple[int | None, Any]] = {}


def _stage() -> int | None:
    task = TaskContext.get()
    return task.stageId() if task else None


def kept_in_stage(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a worker for all its tasks of one stage."""
    stage = _stage()
    if name not in _KEPT or _KEPT[name][0] != stage:
        _KEPT[name] = stage, make()
    return _KEPT[name][1]


def release_memory() -> None:
    """Give memory that arrays of this worker no longer use back to the system, and what it kept in an earlier stage: workers
    live on between tasks and stages."""
    stage = _stage()
    for name in [name for name, (own, _) in _KEPT.items() if own != stage]:
        del _KEPT[name]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a text column: first row, end row, bytes, and offsets of the rows in them. Nulls are empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        end = min(end, n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end
    release_memory()


@dataclass
class Words:
    """Words of some rows: hash, first byte and end byte of each; ``bounds[i]:bounds[i + 1]`` are those of row i."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def split_words(data: np.ndarray, offsets: np.ndarray, fold: bool, inside: np.ndarray | None = None) -> Words:
    """Words separated by space, tab, line breaks, vertical tab or form feed, or made of the bytes that a table of 256 marks
    as ``inside``; ``fold`` lower-cases A-Z first."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64))
    if fold:
        data = _FOLD[data]
    inside = ~((data == 32) | ((data >= 9) & (data <= 13))) if inside is None else inside[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < n]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[edges > 0] - 1
    finishes[edges] = inside[edges]
    ends = np.flatnonzero(finishes) + 1
    return Words(_hash_spans(data, starts, ends), starts, ends, np.searchsorted(starts, offsets))


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes a step for all spans at once."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray(shape=(len(data),), dtype="<u8", buffer=padded.data, strides=(1,))
    lengths = ends - starts
    hashes = mix(lengths.astype(np.uint64) * _GOLDEN)
    active, at = np.arange(len(starts)), starts
    long_ones = np.flatnonzero(lengths > LONG_WORD)
    if len(long_ones):
        active = np.flatnonzero(lengths <= LONG_WORD)
        at = starts[active]
        for i in long_ones:
            hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), seed=7)
    left = lengths[active]
    while len(active):
        block = blocks[at] & _KEEP[np.minimum(left, 8)]
        hashes[active] = mix(hashes[active] ^ (block * _M2 + _GOLDEN))
        more = left > 8
        active, at, left = active[more], at[more] + 8, left[more] - 8
    return hashes


def gram_hashes(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Hash of every run of ``size`` words (given by their hashes), whatever rows they belong to."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & ((1 << 64) - 1) | 1)
    own = mix(words + np.uint64(seed * 0xBF58476D1CE4E5B9 & (1 << 64) - 1))
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * factor + own[i : i + n]
    return mix(total)


def gram_starts(bounds: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the words at which a run of ``size`` words starts that stays in its row."""
    if not bounds[-1]:
        return np.zeros(0, np.int64)
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(bounds[-1])
    return np.flatnonzero(left >= size)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def row_filter(keys: DataFrame, name: str = "row") -> np.ndarray:
    """A bit set of fixed size that holds every key of a column: at most FILTER_BITS / 32 numbers are collected."""
    bit = f"pmod({name}, {FILTER_BITS})"
    words = keys.groupBy(F.expr(f"shiftright({bit}, 5)").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, int({bit} % 32)))").alias("bits")
    )
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    for batch in words.toArrow().to_batches():
        out[batch.column("word").to_numpy()] = batch.column("bits").to_numpy()
    return out


def in_filter(keys: pa.Array, bits: np.ndarray) -> np.ndarray:
    at = keys.to_numpy(zero_copy_only=False) % FILTER_BITS
    return (bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1 > 0


def split_rows(keyed: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``__row`` may be in ``keys`` (all that are, and a few more), and the rest, without a shuffle."""
    bits = keyed.sparkSession.sparkContext.broadcast(row_filter(keys, "__row"))

    def part(wanted: bool):
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(in_filter(batch.column("__row"), bits.value) == wanted))

        return keyed.mapInArrow(pick, keyed.schema)

    return part(True), part(False)


def drop_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose key (doc_id, text) is in ``gone`` (__row); only rows that may be are shuffled."""
    maybe, no = split_rows(docs.withColumn("__row", row_key("doc_id", "text")), gone)
    return maybe.join(gone, "__row", "left_anti").select(*no.columns).union(no).drop("__row")
