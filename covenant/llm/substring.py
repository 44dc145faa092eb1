"""Passages repeated across documents: a count-min prefilter, then exact grouping of the windows it cannot rule out.

Two passes read the texts. The first adds every window of ``width`` words to a count-min sketch: each partition fills its
own, block by block, and the blocks are merged by block number. Counters saturate at two, which is all that is asked
of them, so a merged block is one bit per cell. The second pass keeps the windows whose cells all reached two (a superset of
the repeated ones), settles within the partition what it can, sends at most one document per window and partition on,
and groups those exactly.

Windows travel under their anchor, the least hash of the short runs of words in them. Equal windows have equal anchors, and
neighbouring windows mostly the same one, so that a stretch of a document is one row wherever it goes, and what is
decided about it comes back as one row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covenant.llm.common import gram_hashes, gram_starts, release_memory, row_key, signed, small_batches, split_rows, split_words, text_slices
from covenant.session import scratch_path, written

#: Words of a window.
WIDTH = 13
#: Rows of the sketch.
DEPTH = 2
#: Cells per window and sketch row, and the bound of a sketch row, which bounds what is merged and broadcast: depth *
#: MAX_CELLS / 8 bytes. Beyond the bound more windows pass the filter; the result stays exact.
CELLS_PER_WINDOW = 3
MAX_CELLS = 1 << 29
BLOCK = 1 << 22
#: Windows a task gathers for a part of the sketch, and windows it gathers before it settles them.
SKETCHED = 1_000_000
GATHER = 200_000
#: Words of the runs whose least hash is a window's anchor, and windows that are decided at a time.
ANCHOR_WORDS = 4
DECIDED = 500_000

_LAST = np.int64(np.iinfo(np.int64).max)


def sketch_cells(windows: int, per_window: int = CELLS_PER_WINDOW, most: int = MAX_CELLS) -> int:
    """Cells of a sketch row for so many windows: whole blocks, between one block and the bound."""
    return max(1, min(math.ceil(windows * per_window / BLOCK), most // BLOCK)) * BLOCK


def _cell(hashes: np.ndarray, cells: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)


def write_gaps(cells: np.ndarray) -> bytes:
    """Ascending distinct integers as one byte per gap; 255 means that the gap goes on in the next byte."""
    gaps = np.diff(cells.astype(np.int64), prepend=0)
    ends = np.cumsum(gaps // 255 + 1) - 1
    out = np.full(ends[-1] + 1 if len(ends) else 0, 255, np.uint8)
    out[ends] = gaps % 255
    return out.tobytes()


def read_gaps(packed: bytes) -> np.ndarray:
    gaps = np.frombuffer(packed, np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[gaps < 255]


def _sketch(cells: int, width: int, depth: int):
    """Arrow map: texts to the non-empty blocks of the partition's sketch, as bits for 'one' and for 'two or more'."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = [[] for _ in range(depth)]
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column("text")):
                words = split_words(data, offsets, fold=False)
                at = gram_starts(words.bounds, width)
                if len(at):
                    for row in range(depth):
                        found = gram_hashes(words.hashes, width, row + 1)[at]
                        parts[row].append(_cell(found, cells).astype(np.uint32))
            if sum(map(len, parts[0])) > SKETCHED:
                yield from emit(parts)
                parts = [[] for _ in range(depth)]
        yield from emit(parts)
        release_memory()

    def emit(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for row in range(depth):
            if not parts[row]:
                continue
            every = np.concatenate(parts[row])
            parts[row] = []
            every.sort()
            new = np.r_[True, every[1:] != every[:-1]]
            again = every[~new]
            once, twice = every[new], again[np.r_[True, again[1:] != again[:-1]]] if len(again) else again
            del every, new
            edges = np.arange(0, cells + 1, BLOCK, dtype=np.uint64)
            one, two = np.searchsorted(once, edges), np.searchsorted(twice, edges)
            for block in np.flatnonzero(one[1:] > one[:-1]):
                lists = [
                    write_gaps(values[at[block] : at[block + 1]] - np.uint32(block * BLOCK))
                    for values, at in ((once, one), (twice, two))
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([row * (cells // BLOCK) + int(block)], pa.int64()),
                        "one": pa.array([lists[0]], pa.binary()),
                        "two": pa.array([lists[1]], pa.binary()),
                    }
                )

    return blocks


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order of their number to the bits of cells that reached two, one block in memory."""

    def done(block: int, counts: np.ndarray) -> pa.RecordBatch:
        bits = zstandard.ZstdCompressor(level=1).compress(np.packbits(counts > 1).tobytes())
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "two": pa.array([bits], pa.binary())})

    current, counts = None, np.zeros(0, np.uint8)
    for batch in batches:
        for i in range(batch.num_rows):
            block = batch.column("block")[i].as_py()
            if block != current:
                if current is not None:
                    yield done(current, counts)
                current, counts = block, np.zeros(BLOCK, np.uint8)
            seen = read_gaps(batch.column("one")[i].as_py())
            counts[seen] = np.minimum(counts[seen] + 1, 2)
            counts[read_gaps(batch.column("two")[i].as_py())] = 2
    if current is not None:
        yield done(current, counts)


def repeat_sketch(texts: DataFrame, cells: int, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """The merged sketch as rows (block, two): one bit per cell, set where the counter reached two."""
    return (
        texts.select("text")
        .mapInArrow(_sketch(cells, width, depth), "block bigint, one binary, two binary")
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_merge, "block bigint, two binary")
    )


#: A window as it travels: 96 bits of hashes.
_WINDOW = np.dtype([("hash", "<u8"), ("check", "<u4")])
_STRETCH = "anchor bigint, doc_id bigint, row bigint, place int, windows binary, flags binary"


def anchors(words: np.ndarray, width: int, seed: int) -> np.ndarray:
    """The least hash of the runs of ANCHOR_WORDS words within every run of ``width`` words, given by their hashes."""
    size = min(ANCHOR_WORDS, width)
    grams = gram_hashes(words, size, seed)
    n = max(len(words) - width + 1, 0)
    least = grams[:n].copy()
    for i in range(1, width - size + 1):
        np.minimum(least, grams[i : i + n], out=least)
    return least


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes of an array, cut before the items at ``starts``."""
    offsets = (np.r_[starts, len(values)] * values.dtype.itemsize).astype(np.int32)
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), data])


def _candidates(bits, cells: int, width: int, depth: int):
    """Arrow map: rows (row, doc_id, text) to the windows that may repeat, as stretches under their anchors.

    Per partition and window only the document with the smallest id is passed on; the words at which the others start that
    window are settled and travel as packed flags instead.
    """

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, amount = [], 0
        sketch = np.frombuffer(bits.value, np.uint8).reshape(depth, -1)
        for batch in batches:
            keys = batch.column("row").to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").fill_null(int(_LAST)).to_numpy(zero_copy_only=False)
            for first, end, data, offsets in text_slices(batch.column("text")):
                words = split_words(data, offsets, fold=False)
                at = gram_starts(words.bounds, width)
                if not len(at):
                    continue
                kept = np.ones(len(at), bool)
                window = None
                for row in range(depth):
                    found = gram_hashes(words.hashes, width, row + 1)[at]
                    cell = _cell(found, cells)
                    kept &= (sketch[row][cell >> np.uint64(3)] >> (np.uint8(7) - (cell & np.uint64(7)).astype(np.uint8)) & 1) > 0
                    window = found if window is None else window
                if not kept.any():
                    continue
                at = at[kept]
                number = words.rows[at]
                full = np.empty(len(at), _WINDOW)
                full["hash"] = window[kept]
                full["check"] = gram_hashes(words.hashes, width, depth + 1)[at] >> np.uint64(32)
                place = (at - words.bounds[number]).astype(np.int32)
                held.append((full, anchors(words.hashes, width, depth + 2)[at], place, ids[first:end][number], keys[first:end][number]))
                amount += len(place)
                if amount > GATHER:
                    yield from settle(held)
                    held, amount = [], 0
        if held:
            yield from settle(held)
        release_memory()

    def settle(held: list) -> Iterator[pa.RecordBatch]:
        window, anchor, place, ids, keys = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        over = _later(window, ids)
        if over.any():
            flagged, packs = pack_flags(keys[over], place[over])
            n = len(flagged)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(mix_keys(flagged))),
                    pa.array(np.full(n, _LAST)),
                    pa.array(flagged),
                    pa.array(np.zeros(n, np.int32)),
                    pa.nulls(n, pa.binary()),
                    pa.array(packs, pa.binary()),
                ],
                names=["anchor", "doc_id", "row", "place", "windows", "flags"],
            )
            window, anchor, place, ids, keys = (x[~over] for x in (window, anchor, place, ids, keys))
        by = np.lexsort((place, keys))
        window, anchor, place, ids, keys = (x[by] for x in (window, anchor, place, ids, keys))
        # Equal rows have equal windows at equal places: once is enough.
        once = np.r_[True, (keys[1:] != keys[:-1]) | (place[1:] != place[:-1])]
        window, anchor, place, ids, keys = (x[once] for x in (window, anchor, place, ids, keys))
        starts = np.flatnonzero(
            np.r_[True, (keys[1:] != keys[:-1]) | (place[1:] != place[:-1] + 1) | (anchor[1:] != anchor[:-1])]
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(signed(anchor[starts])),
                pa.array(ids[starts]),
                pa.array(keys[starts]),
                pa.array(place[starts]),
                _binary(window, starts),
                pa.nulls(len(starts), pa.binary()),
            ],
            names=["anchor", "doc_id", "row", "place", "windows", "flags"],
        )

    return candidates


def _later(window: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which windows also stand under a smaller id."""
    if not len(window):
        return np.zeros(0, bool)
    order = np.lexsort((ids, window["check"], window["hash"]))
    h, c, d = window["hash"][order], window["check"][order], ids[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])]
    over = np.empty(len(order), bool)
    over[order] = d > d[np.flatnonzero(new)][np.cumsum(new) - 1]
    return over


def mix_keys(keys: np.ndarray) -> np.ndarray:
    return keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def pack_flags(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Per row key the word numbers flagged, as packed unsigned 32-bit integers."""
    order = np.lexsort((places, keys))
    keys, places = keys[order], places[order].astype("<u4")
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    ends = np.r_[edges[1:], len(keys)]
    return keys[edges], [places[a:b].tobytes() for a, b in zip(edges, ends, strict=True)]


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches in order of their anchors to flags: every start of a window in a document that is not its first.

    Whole anchors are decided at a time. Flags of a document come out as one row per anchor, however the anchors are dealt.
    Of an anchor with very many windows, only the windows themselves (12 bytes each) are held whole.
    """
    held: list[pa.RecordBatch] = []
    amount = 0

    def decide(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        packed = rows.column("windows").combine_chunks()
        offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
        window = np.frombuffer(packed.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(_WINDOW)
        bounds = (offsets - offsets[0]) // _WINDOW.itemsize
        anchor, ids, keys, places = (rows.column(c).to_numpy() for c in ("anchor", "doc_id", "row", "place"))
        parts = 1 + len(window) // (4 * DECIDED)
        for part in range(parts):
            at = np.arange(len(window)) if parts == 1 else np.flatnonzero(window["check"] % np.uint32(parts) == part)
            of = np.searchsorted(bounds, at, "right") - 1
            over = _later(window[at], ids[of])
            at, of = at[over], of[over]
            if not len(at):
                continue
            place = (places[of] + at - bounds[of]).astype("<u4")
            by = np.lexsort((place, keys[of], anchor[of]))
            of, place = of[by], place[by]
            starts = np.flatnonzero(np.r_[True, (keys[of][1:] != keys[of][:-1]) | (anchor[of][1:] != anchor[of][:-1])])
            yield pa.RecordBatch.from_arrays([pa.array(keys[of[starts]]), _binary(place, starts)], names=["row", "flags"])

    def chunk(last: bool) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        anchor = rows.column("anchor").to_numpy()
        end = len(anchor) if last else int(np.searchsorted(anchor, anchor[-1]))
        if end:
            yield from decide(rows.slice(0, end).combine_chunks())
        held[:] = rows.slice(end).to_batches()

    for batch in batches:
        flags = batch.column("flags")
        ready = flags.is_valid()
        done, rest = batch.filter(ready), batch.filter(flags.is_null())
        if done.num_rows:
            yield done.select(["row", "flags"])
        if rest.num_rows:
            held.append(rest)
            amount += rest.column("windows").nbytes // _WINDOW.itemsize
        if amount > DECIDED:
            yield from chunk(False)
            amount = sum(b.column("windows").nbytes // _WINDOW.itemsize for b in held)
    if held:
        yield from chunk(True)
        held.clear()
    release_memory()


def _merge_flags(width: int):
    """Arrow map: all flags of a row to the word ranges they cover, as packed pairs (first, end)."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for packs in batch.column("flags").to_pylist():
                at = np.unique(np.concatenate([np.frombuffer(p, "<u4") for p in packs])).astype(np.int64)
                breaks = np.flatnonzero(at[1:] > at[:-1] + width)
                ranges = np.stack([at[np.r_[0, breaks + 1]], at[np.r_[breaks, len(at) - 1]] + width], axis=1)
                out.append(ranges.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.binary())], names=["__row", "__ranges"])

    return merge


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a text and the word ranges to remove, to the kept text, the counts, and the digest of kept words."""
    for batch in batches:
        ranges = batch.column("__ranges")
        for first, end, data, offsets in text_slices(batch.column("text")):
            words = split_words(data, offsets, fold=False)
            texts, counts, removed, digests = [], [], [], []
            for i in range(end - first):
                a, b = words.bounds[i], words.bounds[i + 1]
                starts, ends = words.starts[a:b] - offsets[i], words.ends[a:b] - offsets[i]
                whole = data[offsets[i] : offsets[i + 1]].tobytes()
                kept, text = np.ones(b - a, bool), whole
                for x, y in np.frombuffer(ranges[first + i].as_py() or b"", "<u4").reshape(-1, 2):
                    kept[x:y] = False
                if not kept.all():
                    # Spaces stay with the word before them, so what is left reads as it did.
                    nexts = np.r_[starts[1:], len(whole)]
                    text = whole[: starts[0]] + b"".join(whole[s:e] for s, e in zip(starts[kept], nexts[kept], strict=True))
                joined = b" ".join(whole[s:e] for s, e in zip(starts[kept], ends[kept], strict=True))
                texts.append(text.decode())
                counts.append(int(b - a))
                removed.append(int(b - a - kept.sum()))
                digests.append(hashlib.sha256(joined).hexdigest())
            part = batch.slice(first, end - first)
            names = [c for c in part.schema.names if c not in ("__row", "__ranges")]
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in names], pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                names=[*names, "kept_text", "n_words", "n_removed", "kept_sha256"],
            )


def remove_repeats(docs: DataFrame, width: int = WIDTH, depth: int = DEPTH, max_cells: int = MAX_CELLS) -> DataFrame:
    """Remove every word covered by a ``width``-word window that also starts in a document with a smaller doc_id.

    Returns the columns of ``docs`` (doc_id, text and any others; of the names added here, its own are replaced) and
    ``kept_text`` (the text where nothing went; null texts are empty), n_words, n_removed, kept_sha256 (of the kept words
    joined by one space). Windows are judged on the input. Rows that share a doc_id do not remove one another, a null doc_id
    counts as larger than any other, equal rows get equal results, texts of fewer than ``width`` words lose nothing.

    Window hashes have 96 bits. The sketch is bounded by ``depth * max_cells / 8`` bytes on the driver and in each
    worker.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("kept_text", "n_words", "n_removed", "kept_sha256")
    keyed = docs.withColumn("__row", row_key("doc_id", "text"))
    rows = keyed.select(F.col("__row").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # A window starts about every seven bytes. Only the width of the sketch depends on this: where words are shorter,
    # more windows pass the filter.
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = sketch_cells(total // 7 + 1, most=max_cells)
    bits = np.zeros((depth, cells // 8), np.uint8)
    unpack = zstandard.ZstdDecompressor().decompress
    per_row = cells // BLOCK
    for found in repeat_sketch(docs, cells, width, depth).toLocalIterator():
        row, block = divmod(found["block"], per_row)
        bits[row, block * (BLOCK // 8) : (block + 1) * (BLOCK // 8)] = np.frombuffer(unpack(bytes(found["two"])), np.uint8)
    sketch = spark.sparkContext.broadcast(bits.tobytes())
    del bits
    ranges = written(
        rows.mapInArrow(
            _candidates(sketch, cells, width, depth),
            _STRETCH,
        )
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_decide, "row bigint, flags binary")
        .groupBy("row")
        .agg(F.collect_list("flags").alias("flags"))
        .mapInArrow(_merge_flags(width), "__row bigint, __ranges binary"),
        scratch_path(spark, "ranges"),
    )
    # The ranges are written, so no task reads the sketch again; workers would hold it for as long as they live.
    sketch.destroy()
    # Only texts that may lose words are shuffled to meet their ranges.
    maybe, no = split_rows(keyed, ranges)
    none = no.withColumn("__ranges", F.lit(None).cast("binary"))
    schema = docs.withColumns(
        {"kept_text": F.lit(""), "n_words": F.lit(0).cast("bigint"), "n_removed": F.lit(0).cast("bigint"), "kept_sha256": F.lit("")}
    ).schema
    return maybe.join(ranges, "__row", "left").select(*none.columns).union(none).mapInArrow(_cut, schema)
