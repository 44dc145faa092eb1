"""Byte passages that occur more than once, by interval expansion on Burrows-Wheeler transforms.

A window is ``length`` bytes of one text. Its anchor is the smallest of its gram hashes, the last of equals, so equal windows
have equal anchors, and the windows of a text fall into runs that share one; the bytes of a run are a segment. Only segments
whose anchor occurs more than once can hold repeated windows. Equal segments are one variant, and all windows of a variant
that occurs twice are repeated. Variants of one anchor that differ are compared in a Burrows-Wheeler transform of many
anchors' variants at a time. All windows of a variant hold its anchor, so only the suffixes that begin at the anchor or before
it are sorted: once at the anchor, and from there by breadth-first backward extension, one symbol of every variant a step, as
transforms of many short texts are made. An interval is open as long as its variants agree to the left, and neighbours in it
whose common prefix has reached the length are repeated. An anchor with more bytes of variants than a task should hold is
settled by the hashes of its windows instead, which are grouped across tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covenant.llm.common import SLICE_BYTES, mix, release_memory, row_key, signed, small_batches, split_rows, text_slices
from covenant.session import scratch_path, written

LENGTH = 400
GRAM = 200
#: Bytes of variants in one transform, the most that variants of one anchor may have to be in one, and the most that one
#: task holds of an anchor.
TRANSFORM_BYTES = 2 << 20
ANCHOR_BYTES = 8 << 20
TASK_BYTES = 8 << 20
#: Anchors a task gathers before it sorts out those it has seen twice.
GATHER = 300_000

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_SINGLE, _MARK, _READY = 0, 1, 2


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        for i, base in enumerate((_BASE, _INVERSE)):
            _POWERS[i] = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)])
    return [p[:n] for p in _POWERS]


def span_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` bytes."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data))
    sums = np.r_[np.uint64(0), np.cumsum(_BYTES[data] * up)]
    return mix((sums[size:] - sums[:-size]) * down[:n])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    n = len(values) - width + 1
    padded = np.concatenate([values, np.full(-len(values) % width, ~np.uint64(0), np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that share an anchor: row, anchor hash, first window, and number of further windows."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none.view(np.uint64), none, none
    hashes = span_hashes(data, gram)
    # The place makes the last of equal hashes the smallest; 31 bits hold any place in a text.
    low = np.uint64((1 << 31) - 1)
    keys = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    place = (low - (_sliding_least(keys, length - gram + 1) & low)).astype(np.int64)
    rooms = np.maximum(np.diff(offsets) - length + 1, 0)
    rows = np.repeat(np.arange(len(rooms)), rooms)
    windows = np.arange(len(rows)) - np.repeat(np.cumsum(rooms) - rooms, rooms) + np.repeat(offsets[:-1], rooms)
    if not len(windows):
        return none, none.view(np.uint64), none, none
    at = place[windows]
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (rows[1:] != rows[:-1])])
    more = np.diff(np.r_[first, len(at)]) - 1
    return rows[first], hashes[at[first]], windows[first] - offsets[rows[first]], more


def _list_anchors(length: int, gram: int):
    """Arrow map: rows (row, text) to anchors. Those a task has seen twice are ready, and one mark stands for them."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, amount = [], 0
        for batch in batches:
            keys = batch.column("row").to_numpy(zero_copy_only=False)
            for first, _, data, offsets in text_slices(batch.column("text")):
                row, found, start, more = anchors(data, offsets, length, gram)
                held.append((found, keys[first + row], (start << 12) | more))
                amount += len(row)
                if amount > GATHER:
                    yield sorted_out(held)
                    held, amount = [], 0
        if held:
            yield sorted_out(held)

    def sorted_out(held: list) -> pa.RecordBatch:
        found, rows, at = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(found, kind="stable")
        found, rows, at = found[order], rows[order], at[order]
        starts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.zeros(0, int)
        counts = np.diff(np.r_[starts, len(found)])
        kind = np.where(np.repeat(counts, counts) > 1, _READY, _SINGLE)
        marks = found[starts[counts > 1]]
        key = np.where(kind == _READY, mix(rows.view(np.uint64)), found)
        none = np.zeros(len(marks), np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(signed(np.r_[key, marks])),
                pa.array(np.r_[kind, none + _MARK].astype(np.int8)),
                pa.array(signed(np.r_[found, marks])),
                pa.array(np.r_[rows, none]),
                pa.array(np.r_[at, none]),
            ],
            names=["key", "kind", "anchor", "row", "at"],
        )

    return listed


def _keep_repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors in order of key, marks before singles: passes on ready ones, and singles that are not alone."""
    held: tuple[np.ndarray, ...] | None = None

    def chosen(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        key, kind, anchor, row, at = columns
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
        weight = np.where(kind == _MARK, 2, np.where(kind == _SINGLE, 1, 0))
        total = np.add.reduceat(weight, starts) if len(starts) else weight
        enough = np.repeat(total, np.diff(np.r_[starts, len(key)])) > 1
        keep = (kind == _READY) | ((kind == _SINGLE) & enough)
        return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (row, anchor, at)], names=["row", "anchor", "at"])

    for batch in batches:
        now = tuple(batch.column(c).to_numpy() for c in ("key", "kind", "anchor", "row", "at"))
        if held is not None:
            now = tuple(np.r_[a, b] for a, b in zip(held, now, strict=True))
        # The last key may go on in the next batch; it has a row per task at most.
        cut = int(np.searchsorted(now[0], now[0][-1])) if len(now[0]) else 0
        yield chosen(tuple(x[:cut] for x in now))
        held = tuple(x[cut:] for x in now)
    if held is not None:
        yield chosen(held)


def _segments(length: int):
    """Arrow map: texts with their anchors to the variant each segment is an occurrence of."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("anchors")
            for i in range(batch.num_rows):
                text = memoryview((batch.column("text")[i].as_py() or "").encode())
                values = lists[i].values
                found, at = values.field("anchor").to_numpy(), values.field("at").to_numpy()
                start, more = at >> 12, at & 4095
                hashed = [xxhash.xxh3_128_digest(text[s : s + m + length]) for s, m in zip(start.tolist(), more.tolist(), strict=True)]
                variant = np.frombuffer(b"".join(hashed), "<i8").reshape(-1, 2)
                row = np.full(len(at), batch.column("row")[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (found, np.ascontiguousarray(variant[:, 0]), np.ascontiguousarray(variant[:, 1]), row, start, more)],
                    names=["anchor", "v1", "v2", "row", "start", "more"],
                )

    return segments


def _fetch(length: int):
    """Arrow map: texts with the variants to take from them, to the variants' bytes."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted")
            for i in range(batch.num_rows):
                text = (batch.column("text")[i].as_py() or "").encode()
                values = wanted[i].values
                start, more = values.field("start").to_pylist(), values.field("more").to_pylist()
                parts = [text[s : s + m + length] for s, m in zip(start, more, strict=True)]
                names = ["anchor", "v1", "v2", "n"]
                yield pa.RecordBatch.from_arrays(
                    [*[values.field(c) for c in names], pa.array(parts, pa.binary())], names=[*names, "bytes"]
                )

    return fetch


def suffix_order(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling. ``symbols`` are bytes plus one, and 0 at the end of each text; ``ends[i]`` is the
    end of i's text. Ends sort by their place, so suffixes of different texts always differ."""
    n = len(symbols)
    # Seven symbols in one number to begin with; nothing is read past an end.
    key, inside, reach = np.zeros(n, np.int64), np.ones(n, bool), 7
    padded = np.r_[symbols, np.zeros(reach, symbols.dtype)]
    for i in range(reach):
        inside &= padded[i : i + n] > 0
        key <<= 9
        key |= np.where(inside, padded[i : i + n], 0)
    order = np.argsort(key)
    rank = np.empty(n, np.int32)
    rank[order] = _first_of_equals(key[order])
    del key, inside, padded, order
    finish = np.flatnonzero(symbols == 0)
    rank[finish] = np.arange(len(finish))
    open_ = np.flatnonzero(symbols > 0).astype(np.int32)
    while True:
        sizes = np.bincount(rank, minlength=n)
        open_ = open_[sizes[rank[open_]] > 1]
        del sizes
        if not len(open_):
            out = np.empty(n, np.int32)
            out[rank] = np.arange(n, dtype=np.int32)
            return out
        own = rank[open_]
        pair = own.astype(np.int64) * n + rank[np.minimum(open_ + reach, ends[open_])]
        by = np.argsort(pair)
        own, pair, places = own[by], pair[by], open_[by]
        del by
        # Ranks are the first place of the group, so groups that are settled keep theirs.
        rank[places] = own + _first_of_equals(pair) - _first_of_equals(own)
        reach *= 2


def _first_of_equals(values: np.ndarray) -> np.ndarray:
    """For each of some sorted values the first place of its equals."""
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return np.repeat(first.astype(np.int32), np.diff(np.r_[first, len(values)]))


def repeated_starts(texts: list[bytes], length: int, wide_levels: int = 6) -> list[np.ndarray]:
    """For each text, the places at which a string of ``length`` bytes starts that also starts anywhere else in the texts.

    ``known[p]`` becomes true when the common prefix of the suffixes p - 1 and p (in suffix order) has been found to be
    shorter than the level reached. Two neighbouring occurrences of a symbol in the transform with a boundary between them
    lead to a boundary one level up; so each level follows from the boundaries found in the one before.
    """
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(t + b"\0" for t in texts), np.uint8)
    finish = np.cumsum(sizes + 1) - 1
    symbols = data.astype(np.int16) + np.int16(1)
    symbols[finish] = 0
    n = len(symbols)
    order = suffix_order(symbols, np.repeat(finish.astype(np.int32), sizes + 1))
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    before = (order - 1) % n
    last = symbols[before].astype(np.uint16)
    step = place[before]
    del place, before
    # The occurrence of the same symbol before each place of the transform; ends of texts have none.
    by = np.argsort(last, kind="stable")
    previous = np.full(n, -1, np.int32)
    last = last[by]
    same = (last[1:] == last[:-1]) & (last[1:] > 0)
    previous[by[1:][same]] = by[:-1][same]
    del by, last, same

    heads = symbols[order]
    known = np.r_[True, (heads[1:] != heads[:-1]) | (heads[1:] == 0)]
    fresh = np.flatnonzero(known)
    usable = previous >= 0
    following = None
    for level in range(length - 1):
        if level < wide_levels:
            count = np.cumsum(known, dtype=np.int32)
            hit = usable & ~known[step]
            hit[hit] = count[hit.nonzero()[0]] > count[previous[hit]]
            fresh = step[hit]
        else:
            if not len(fresh):
                break
            if following is None or level & (level - 1) == 0 or level % 48 == 0:
                marks = np.where(known, np.arange(n, dtype=np.int32), np.int32(n))
                following = np.r_[np.minimum.accumulate(marks[::-1])[::-1][1:], np.int32(n)]
                del marks
            runs = following[fresh] - fresh
            spots = np.repeat(fresh - np.r_[0, np.cumsum(runs)[:-1]], runs) + np.arange(runs.sum())
            begin = np.repeat(fresh, runs)
            good = usable[spots] & (previous[spots] < begin)
            target = step[spots[good]]
            fresh = np.unique(target[~known[target]])
        known[fresh] = True
    open_ = ~known
    repeated = open_ | np.r_[open_[1:], False]
    starts = np.sort(order[repeated])
    bounds = np.r_[0, finish + 1]
    cuts = np.searchsorted(starts, bounds)
    return [starts[cuts[i] : cuts[i + 1]] - bounds[i] for i in range(len(texts))]


def anchor_places(texts: list[bytes], anchor: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For each variant, where the gram of its anchor begins: the last such place within its first window."""
    out = np.full(len(texts), -1)
    sizes = np.array([len(t) for t in texts])
    parts = (np.cumsum(sizes) // SLICE_BYTES).searchsorted(np.arange(1 + sizes.sum() // SLICE_BYTES))
    for first, last in zip(parts, [*parts[1:], len(texts)], strict=True):
        if last > first:
            own = sizes[first:last]
            hashes = span_hashes(np.frombuffer(b"".join(texts[first:last]), np.uint8), gram)
            owner = np.repeat(np.arange(last - first), own)[: len(hashes)]
            places = np.arange(len(hashes)) - (np.cumsum(own) - own)[owner]
            hit = np.flatnonzero((hashes == anchor[first:last][owner]) & (places <= length - gram))
            out[first + owner[hit]] = places[hit]  # ascending, so the last one stays
    return out


def common_prefixes(texts: list[bytes], most: int) -> np.ndarray:
    """For some sorted texts, the length of the prefix each shares with the one before it, up to ``most``."""
    out = np.zeros(len(texts), np.int32)
    for at in range(1, len(texts), 4096):
        part = texts[at - 1 : at + 4096]
        sizes = np.minimum([len(t) for t in part], most)
        bytes_ = np.zeros((len(part), int(sizes.max())), np.uint8)
        bytes_[np.arange(bytes_.shape[1]) < sizes[:, None]] = np.frombuffer(b"".join(t[:most] for t in part), np.uint8)
        other = bytes_[1:] != bytes_[:-1]
        shared = np.where(other.any(axis=1), other.argmax(axis=1), most)
        out[at : at + len(shared)] = np.minimum(shared, np.minimum(sizes[1:], sizes[:-1]))
    return out


def anchored_ranges(texts: list[bytes], groups: list[int], anchor: np.ndarray, length: int, gram: int) -> list[bytes]:
    """For each variant, packed ranges of the windows that also occur in another variant of its group.

    Variants of a group have the same anchor, and equal windows hold it at the same place. ``rows`` are the variants in the
    order of their suffixes that begin ``level`` bytes before the anchor, ``shared`` what each has in common with the one
    before it from the anchor on, and ``head`` tells where an interval begins, all of whose suffixes agree up to the anchor.
    """
    places = anchor_places(texts, anchor, length, gram)
    order = sorted(range(len(texts)), key=lambda i: (groups[i], texts[i][places[i] :]))
    rows = np.array(order)
    shared = common_prefixes([texts[i][places[i] :] for i in order], length)
    group = np.array(groups)[rows]
    head = np.r_[True, group[1:] != group[:-1]]
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    ahead = np.cumsum(sizes) - sizes + places  # where the anchor begins
    on = np.zeros(len(texts), bool)
    changes: list[tuple[np.ndarray, int]] = []
    level = 0
    while len(rows):
        # A neighbour that shares ``length`` bytes from here on repeats the window that begins here.
        enough = ~head & (shared + level >= length)
        now = enough | np.r_[enough[1:], False]
        turned = rows[now != on[rows]]
        if len(turned):
            changes.append((turned, level))
            on[turned] ^= True
        level += 1
        # One symbol to the left. Intervals whose symbols differ fall apart; what is alone or has no symbol left goes.
        usable = places[rows] >= level
        symbol = np.where(usable, data[ahead[rows] - level], 0)
        number = np.cumsum(head)
        if not usable.all() or (~head[1:] & (symbol[1:] != symbol[:-1])).any():
            at = np.flatnonzero(usable)
            at = at[np.argsort(number[at] << 8 | symbol[at], kind="stable")]
            head = np.r_[True, (number[at[1:]] != number[at[:-1]]) | (symbol[at[1:]] != symbol[at[:-1]])][: len(at)]
            shared = _least_between(shared, at, head)
            alone = head & np.r_[head[1:], True][: len(at)]
            gone = np.ones(len(rows), bool)
            gone[at[~alone]] = False
            ended = rows[gone]
            ended = ended[on[ended]]
            if len(ended):
                changes.append((ended, level))
                on[ended] = False
            rows, shared, head = rows[at[~alone]], shared[~alone], head[~alone]
    if not changes:
        return [b""] * len(texts)
    who = np.concatenate([c[0] for c in changes])
    when = np.repeat([c[1] for c in changes], [len(c[0]) for c in changes])
    by = np.lexsort((when, who))
    who, when = who[by], when[by]
    # Every range has a level at which it begins and one at which it has ended; the later the level, the earlier the window.
    first, end = places[who[::2]] - when[1::2] + 1, places[who[::2]] - when[::2] + 1
    by = np.lexsort((first, who[::2]))
    packed = np.stack([first[by], end[by]], axis=1).astype("<u4")
    cuts = np.searchsorted(who[::2], np.arange(len(texts) + 1))
    return [packed[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _least_between(shared: np.ndarray, at: np.ndarray, head: np.ndarray) -> np.ndarray:
    """What each of the places ``at`` shares with the one before it, in order of the places within an interval: the least of
    what neighbours between the two share. At the head of an interval it is nothing."""
    out = np.zeros(len(at), shared.dtype)
    inner = np.flatnonzero(~head)
    if len(inner):
        start, end = at[inner - 1] + 1, at[inner] + 1
        near = end - start == 1
        out[inner[near]] = shared[start[near]]
        far = inner[~near]
        if len(far):
            edges = np.stack([start[~near], end[~near]], axis=1).reshape(-1)
            out[far] = np.minimum.reduceat(np.r_[shared, 0], edges)[::2]
    return out


def as_ranges(places: np.ndarray, reach: int = 1) -> bytes:
    """Ascending places as packed ranges (first, end), where ranges of ``reach`` that touch are one."""
    if not len(places):
        return b""
    breaks = np.flatnonzero(places[1:] > places[:-1] + reach)
    return np.stack([places[np.r_[0, breaks + 1]], places[np.r_[breaks, len(places) - 1]] + reach], axis=1).astype("<u4").tobytes()


def repeated_windows(variants: list[tuple], length: int) -> list[np.ndarray]:
    """As :func:`repeated_starts`, by the hashes (128 bits) of all windows; 16 bytes a window are held."""
    rooms = np.array([len(v[3]) - length + 1 for v in variants])
    hashed = b"".join(
        b"".join(xxhash.xxh3_128_digest(data[i : i + length]) for i in range(room))
        for (*_, data), room in zip(variants, rooms, strict=True)
    )
    one, two = np.frombuffer(hashed, "<i8").reshape(-1, 2).T
    order = np.lexsort((two, one))
    same = (one[order[1:]] == one[order[:-1]]) & (two[order[1:]] == two[order[:-1]])
    again = np.zeros(len(one), bool)
    again[order[1:]] = same
    again[order[:-1]] |= same
    edges = np.cumsum(rooms)
    return [np.flatnonzero(part) for part in np.split(again, edges[:-1])]


def _transform(length: int, gram: int, anchor_bytes: int):
    """Arrow map: variants in order of anchor to the ranges of their repeated windows, some anchors at a time."""

    def settle(held: list[tuple], ranges: list[bytes]) -> pa.RecordBatch:
        keep = [i for i, found in enumerate(ranges) if found]
        return pa.RecordBatch.from_arrays(
            [pa.array([held[i][1] for i in keep], pa.int64()), pa.array([held[i][2] for i in keep], pa.int64()), pa.array([ranges[i] for i in keep], pa.binary())],
            names=["v1", "v2", "ranges"],
        )

    def expand(held: list[tuple]) -> pa.RecordBatch:
        groups = [v[0] for v in held]
        return settle(held, anchored_ranges([v[3] for v in held], groups, np.array(groups, np.int64).view(np.uint64), length, gram))

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple] = []
        now: list[tuple] = []
        size = amount = 0  # bytes of ``ready`` and of ``now``

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "v1", "v2", "bytes")]
            for variant in zip(*columns, strict=True):
                if now and now[-1][0] != variant[0]:
                    # The variants of one anchor are complete.
                    if amount > anchor_bytes:
                        yield settle(now, [as_ranges(places) for places in repeated_windows(now, length)])
                    else:
                        ready.extend(now)
                        size += amount
                    now, amount = [], 0
                    if size > TRANSFORM_BYTES:
                        yield expand(ready)
                        ready, size = [], 0
                        release_memory()
                if not now or now[-1][:3] != variant[:3]:  # equal rows bring the same variant
                    now.append(variant)
                    amount += len(variant[3])
        if amount > anchor_bytes:
            yield settle(now, [as_ranges(places) for places in repeated_windows(now, length)])
        else:
            ready.extend(now)
        if ready:
            yield expand(ready)
        ready, now = [], []
        release_memory()

    return transform


def _windows(length: int):
    """Arrow map: variants to the hashes (128 bits) of their windows."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for v1, v2, n, data in zip(*(batch.column(c).to_pylist() for c in ("v1", "v2", "n", "bytes")), strict=True):
                hashed = b"".join(xxhash.xxh3_128_digest(data[i : i + length]) for i in range(len(data) - length + 1))
                pair = np.frombuffer(hashed, "<i8").reshape(-1, 2)
                size = len(pair)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, v1)), pa.array(np.full(size, v2)), pa.array(np.full(size, n)), pa.array(np.arange(size)), pa.array(np.ascontiguousarray(pair[:, 0])), pa.array(np.ascontiguousarray(pair[:, 1]))],
                    names=["v1", "v2", "n", "at", "h1", "h2"],
                )

    return windows


def _places_to_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ranges = [as_ranges(np.sort(np.array(p))) for p in batch.column("places").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("v1"), batch.column("v2"), pa.array(ranges, pa.binary())], names=["v1", "v2", "ranges"])


def _merge_spans(length: int):
    """Arrow map: all ranges of a row to the byte spans they cover, as packed pairs."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parts in batch.column("parts").to_pylist():
                pairs = [
                    np.array([[0, p["more"] + 1]]) + p["start"]
                    if p["more"] is not None
                    else np.frombuffer(p["ranges"], "<u4").reshape(-1, 2).astype(np.int64) + p["start"]
                    for p in parts
                ]
                spans = np.unique(np.concatenate(pairs), axis=0)
                first, end = spans[:, 0], np.maximum.accumulate(spans[:, 1] - 1 + length)
                breaks = np.flatnonzero(first[1:] > end[:-1])
                merged = np.stack([first[np.r_[0, breaks + 1]], end[np.r_[breaks, len(end) - 1]]], axis=1)
                out.append(merged.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.binary())], names=["__row", "__spans"])

    return merge


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, counts = [], []
        for i in range(batch.num_rows):
            data = (batch.column("text")[i].as_py() or "").encode()
            spans = np.frombuffer(batch.column("__spans")[i].as_py() or b"", "<u4").reshape(-1, 2).tolist()
            edges = [0, *[x for span in spans for x in span], len(data)]
            rest = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            kept.append(rest)
            counts.append((len(data), len(data) - len(rest), len(spans), hashlib.sha256(rest).hexdigest()))
        names = [c for c in batch.schema.names if c not in ("__row", "__spans")]
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = zip(*counts, strict=True) if counts else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in names], pa.array(kept, pa.binary()), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
            names=[*names, "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, anchor_bytes: int = ANCHOR_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts anywhere else, in the same text or another.

    Returns the columns of ``docs`` (doc_id, text and any others; of the names added here, its own are replaced) and
    ``kept`` (the bytes that are left, which may cut a character), n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256. Texts are UTF-8, null is empty, shorter texts keep everything. Matches stay within one text each and are
    judged on the input. Repeated rows are each other's repetition. ``gram`` must not exceed ``length``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("kept", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    keyed = docs.withColumn("__row", row_key("doc_id", "text"))
    texts = keyed.select(F.col("__row").alias("row"), "text")
    lists = written(
        texts.mapInArrow(_list_anchors(length, gram), "key bigint, kind tinyint, anchor bigint, row bigint, at bigint")
        .repartition("key")
        .sortWithinPartitions("key", F.desc("kind"))
        .mapInArrow(_keep_repeated, "row bigint, anchor bigint, at bigint")
        .groupBy("row")
        # Equal rows list their anchors twice.
        .agg(F.collect_set(F.struct("anchor", "at")).alias("anchors"))
        .withColumnRenamed("row", "__row"),
        scratch_path(spark, "anchors"),
    )
    maybe, _ = split_rows(texts.withColumnRenamed("row", "__row"), lists)
    candidates = written(
        maybe.join(lists, "__row").select(F.col("__row").alias("row"), "text", "anchors"), scratch_path(spark, "candidates")
    )
    occurrences = written(
        candidates.mapInArrow(_segments(length), "anchor bigint, v1 bigint, v2 bigint, row bigint, start bigint, more bigint"),
        scratch_path(spark, "occurrences"),
    )
    variants = written(
        occurrences.groupBy("anchor", "v1", "v2").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "start")).alias("at"), F.max("more").alias("more")
        ),
        scratch_path(spark, "variants"),
    )
    varied = variants.groupBy("anchor").agg(F.count(F.lit(1)).alias("m"), F.sum(F.col("more") + length).alias("size")).where("m > 1")
    wanted = (
        variants.join(varied, "anchor")
        .groupBy(F.col("at.row").alias("row"))
        .agg(F.collect_list(F.struct("anchor", "v1", "v2", "n", F.col("at.start").alias("start"), "more", "size")).alias("all"))
    )
    shape = "anchor bigint, v1 bigint, v2 bigint, n bigint, bytes binary"

    def fetched(wide: bool) -> DataFrame:
        chosen = wanted.withColumn("wanted", F.filter("all", lambda v: (v["size"] > task_bytes) == F.lit(wide))).where("size(wanted) > 0")
        return candidates.select("row", "text").join(chosen.select("row", "wanted"), "row").mapInArrow(_fetch(length), shape)

    narrow = (
        fetched(False).repartition("anchor").sortWithinPartitions("anchor", "v1", "v2").mapInArrow(_transform(length, gram, anchor_bytes), "v1 bigint, v2 bigint, ranges binary")
    )
    found = narrow
    if varied.where(F.col("size") > task_bytes).limit(1).count():
        windows = written(
            fetched(True).dropDuplicates(["anchor", "v1", "v2"]).mapInArrow(_windows(length), "v1 bigint, v2 bigint, n bigint, at bigint, h1 bigint, h2 bigint"),
            scratch_path(spark, "windows"),
        )
        again = written(windows.groupBy("h1", "h2").agg(F.sum("n").alias("total")).where("total > 1").select("h1", "h2"), scratch_path(spark, "repeated"))
        found = found.union(
            windows.join(again, ["h1", "h2"]).groupBy("v1", "v2").agg(F.collect_set("at").alias("places")).mapInArrow(_places_to_ranges, "v1 bigint, v2 bigint, ranges binary")
        )
    # A variant that occurs twice is repeated as a whole.
    results = written(
        found.withColumn("more", F.lit(None).cast("bigint"))
        .union(variants.where("n > 1").select("v1", "v2", F.lit(None).cast("binary"), "more"))
        .groupBy("v1", "v2")
        .agg(F.max("ranges").alias("ranges"), F.max("more").alias("more")),
        scratch_path(spark, "results"),
    )
    spans = (
        occurrences.select("v1", "v2", "row", "start")
        .join(results, ["v1", "v2"])
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "ranges", "more")).alias("parts"))
    )
    spans = written(spans.mapInArrow(_merge_spans(length), "__row bigint, __spans binary"), scratch_path(spark, "spans"))
    touched, rest = split_rows(keyed, spans)
    joined = touched.join(spans, "__row", "left")
    rest = rest.withColumn("__spans", F.lit(None).cast("binary"))
    schema = docs.withColumns(
        {"kept": F.lit(None).cast("binary"), "n_bytes": F.lit(0).cast("bigint"), "n_removed": F.lit(0).cast("bigint"), "n_spans": F.lit(0).cast("bigint"), "kept_sha256": F.lit("")}
    ).schema
    return joined.select(*rest.columns).union(rest).mapInArrow(_cut, schema)
