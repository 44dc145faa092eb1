"""Class-based bigram language model: exchange clustering, class transitions, word emissions.

Every word of at least ``MIN_COUNT`` training tokens is clustered; the rarer ones go by the unit of their last two bytes. In
each sweep every word moves to the class that gains the most likelihood, given how often each class precedes and follows it.
Words of at least one part in ``KNOWN_SHARE`` of the tokens (so at most that many) and the units of two bytes go first:
their classes are held in memory, what stands around them is a table that Spark adds up by class in each sweep. Then go the
other words: their classes are a table, joined in each sweep with their neighbours among themselves. The number of classes
grows with the vocabulary. A token's probability is that of its class after the previous one (Witten-Bell smoothed) times
that of the word in its class, where one count is set aside for words never seen.

Counts cover all training rows. What is held in memory is bounded by the share and by the square of the number of classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covenant.llm.common import Words, held_out, row_key, signed, small_batches, split_words, text_slices
from covenant.session import scratch_path, written

#: Words that occur less often stay with the other words of the same last two bytes.
MIN_COUNT = 3
#: Words of at least one part in so many start out dealt over the classes in turn, the others known in memory by their hash.
UNIT_SHARE = 4_000
#: Words of at least one part in so many have their class looked up in memory, those of the others are joined.
KNOWN_SHARE = 1_000_000
#: Classes at least, and the power of the number of clustered words that they grow with.
CLASSES = 48
GROWTH = 0.4
#: Sweeps over the words known in memory and the tails, then over the other words.
SWEEPS = 6
RARE_SWEEPS = 2
#: Classes a word's exact gain is computed for, besides its own: the best by the gain's first order.
CANDIDATES = 4
#: A word's neighbours of one chunk are one row up to so many, then a row for each range of so many units.
PIECE = 1 << 14
#: Words whose gains are computed at a time.
BLOCK = 1_000
#: Tokens a task gathers before it adds them up.
GATHER = 4_000_000

#: The low byte of a word's number tells its last two bytes, the rest is its hash.
_TAIL = np.uint64(255)
#: The end of a text, a token of its own.
END = np.int64(0x456E6420)


def word_ids(data: np.ndarray, words: Words) -> np.ndarray:
    """Numbers of words: 56 bits of hash, 8 bits for the last two bytes."""
    folded = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64)
    last = folded[words.ends - 1]
    before = folded[np.maximum(words.ends - 2, words.starts)]
    tail = (last * np.uint64(37) + before * np.uint64(11)) & _TAIL
    return signed((words.hashes & ~_TAIL) | tail)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the rows with the numbers of their words and the bounds of each row."""
    for batch in batches:
        for first, end, data, offsets in text_slices(batch.column("text")):
            words = split_words(data, offsets, fold=True)
            yield batch.slice(first, end - first), word_ids(data, words), words.bounds


def _with_ends(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.insert(ids, bounds[1:], END)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, amount = [], 0

    def total() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], names=["id", "n"])

    for _, ids, bounds in _texts(batches):
        held.append(_with_ends(ids, bounds))
        amount += len(held[-1])
        if amount > GATHER:
            yield total()
            held, amount = [], 0
    if held:
        yield total()


@dataclass
class Units:
    """Numbers of the words known in memory, sorted; then come the end and the 256 tails. ``low`` marks the words that are
    too rare to be clustered."""

    ids: np.ndarray
    low: np.ndarray

    @property
    def size(self) -> int:
        return len(self.ids) + 257

    @property
    def end(self) -> int:
        return len(self.ids)

    def of(self, ids: np.ndarray) -> np.ndarray:
        at, found = _look_up(self.ids, ids)
        return np.where(ids == END, self.end, np.where(found, at, self.tail(ids)))

    def tail(self, ids: np.ndarray) -> np.ndarray:
        return self.end + 1 + (ids & 255)

    def clustered(self, ids: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Units that words (of units ``own``) go by in the clustering: their own or, of rare ones, their tail."""
        return np.where(np.r_[self.low, np.zeros(257, bool)][own], self.tail(ids), own)


_CONTEXTS = "rare boolean, key bigint, piece int, codes array<int>, ns array<int>, links array<bigint>, link_ns array<int>"


def _lists(groups: np.ndarray, number: int, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Values with the (sorted) group of each as one list per group."""
    offsets = np.searchsorted(groups, np.arange(number + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))


def _summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    return codes[starts], np.add.reduceat(n, starts) if len(codes) else n


def _unit_rows(units: Units, before: np.ndarray, after: np.ndarray) -> pa.RecordBatch:
    """Units with their neighbours: codes are twice the neighbour, plus one if it comes before."""
    wide = 2 * units.size
    pairs, times = np.unique(before * units.size + after, return_counts=True)
    before, after = pairs // units.size, pairs % units.size
    codes, n = _summed(np.r_[before * wide + 2 * after, after * wide + 2 * before + 1], np.r_[times, times])
    key, code = codes // wide, codes % wide
    much = np.bincount(key, minlength=units.size)[key] > PIECE
    piece = np.where(much, code // (2 * PIECE), -1)
    starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (piece[1:] != piece[:-1])])
    group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(key)]))
    none = _lists(np.zeros(0, np.int64), len(starts), np.zeros(0, np.int64), pa.int64())
    return _context_batch(False, key[starts], piece[starts], _lists(group, len(starts), code, pa.int32()),
                          _lists(group, len(starts), n, pa.int32()), none, none.cast(pa.list_(pa.int32())))


def _rare_rows(units: Units, ids: np.ndarray, before: np.ndarray, after: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
    """Words not known in memory with their neighbours that are, as codes, and those that are not, as links: numbers, with
    the count below zero if they come before."""
    was_known = np.r_[True, known[:-1]]
    words = np.unique(ids[~known])
    row = np.zeros(len(ids), np.int64)
    row[~known] = np.searchsorted(words, ids[~known])
    row_before = np.r_[0, row[:-1]]
    wide = 2 * units.size
    first, second = ~known & was_known, known & ~was_known
    codes, n = np.unique(
        np.r_[row[first] * wide + 2 * before[first] + 1, row_before[second] * wide + 2 * after[second]], return_counts=True
    )
    both = ~known & ~was_known
    size = max(len(words), 1)
    pairs, times = np.unique(row_before[both] * size + row[both], return_counts=True)
    left, right = pairs // size, pairs % size
    group, link, sign = np.r_[left, right], words[np.r_[right, left]], np.r_[times, -times]
    order = np.argsort(group, kind="stable")
    return _context_batch(True, words, np.full(len(words), -1), _lists(codes // wide, len(words), codes % wide, pa.int32()),
                          _lists(codes // wide, len(words), n, pa.int32()), _lists(group[order], len(words), link[order], pa.int64()),
                          _lists(group[order], len(words), sign[order], pa.int32()))


def _context_batch(rare: bool, key: np.ndarray, piece: np.ndarray, *lists: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(key), rare)), pa.array(key), pa.array(piece.astype(np.int32)), *lists],
        names=["rare", "key", "piece", "codes", "ns", "links", "link_ns"],
    )


def _count_contexts(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units: Units = shared.value
        held, amount = [], 0

        def total() -> Iterator[pa.RecordBatch]:
            # Every text follows an end, as if the texts stood in a row.
            ids = np.concatenate(held)
            own = units.of(ids)
            after = units.clustered(ids, own)
            before = np.r_[units.end, after[:-1]]
            yield from _sliced(_unit_rows(units, before, after))
            known = own <= units.end
            if not known.all():
                yield from _sliced(_rare_rows(units, ids, before, after, known))

        for _, ids, bounds in _texts(batches):
            held.append(_with_ends(ids, bounds))
            amount += len(held[-1])
            if amount > GATHER:
                yield from total()
                held, amount = [], 0
        if held:
            yield from total()

    return count


def _sliced(batch: pa.RecordBatch, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    lengths = np.diff(column.offsets.to_numpy())
    return np.repeat(np.arange(len(column)), lengths), column.flatten().to_numpy(zero_copy_only=False)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their keys to one row per key; of words known in memory there may be several."""
    held, amount = [], 0

    def merged(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, amount
        batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        rare, key, piece = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rare", "key", "piece"))
        starts = np.flatnonzero(np.r_[True, (rare[1:] != rare[:-1]) | (key[1:] != key[:-1]) | (piece[1:] != piece[:-1])])
        held, amount = [], 0
        if not last and rare[-1]:
            held, batch = [batch.slice(starts[-1])], batch.slice(0, starts[-1])
            starts = starts[:-1]
        if not batch.num_rows:
            return
        group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, batch.num_rows]))
        lists = []
        row, code = _flat(batch.column("codes"))
        n = _flat(batch.column("ns"))[1]
        codes, n = _summed(group[row] << 32 | code, n.astype(np.int64))
        lists += [_lists(codes >> 32, len(starts), codes & 0xFFFFFFFF, pa.int32()), _lists(codes >> 32, len(starts), n, pa.int32())]
        row, link = _flat(batch.column("links"))
        n = _flat(batch.column("link_ns"))[1]
        lists += [_lists(group[row], len(starts), link, pa.int64()), _lists(group[row], len(starts), n, pa.int32())]
        yield from _sliced(
            pa.RecordBatch.from_arrays(
                [pa.array(rare[starts]), pa.array(key[starts]), pa.array(piece[starts]), *lists], names=batch.schema.names
            )
        )

    for batch in batches:
        held.append(batch)
        amount += len(batch.column("codes").flatten()) + len(batch.column("links").flatten())
        if amount > GATHER // 2:
            yield from merged(False)
    if held:
        yield from merged(True)


def _class_sums(shared):
    """Arrow map: neighbours of units to one row per unit with the classes around it: ``side * classes + class``."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, number = shared.value
        held, amount = [], 0

        def total() -> pa.RecordBatch:
            codes, n = _summed(np.concatenate([c for c, _ in held]), np.concatenate([n for _, n in held]))
            key, code = codes // (2 * number), codes % (2 * number)
            found = np.unique(key)
            group = np.searchsorted(found, key)
            return pa.RecordBatch.from_arrays(
                [pa.array(found), _lists(group, len(found), code, pa.int32()), _lists(group, len(found), n, pa.int64())],
                names=["unit", "codes", "ns"],
            )

        for batch in batches:
            row, code = _flat(batch.column("codes"))
            key = batch.column("key").to_numpy()[row]
            n = _flat(batch.column("ns"))[1].astype(np.int64)
            held.append(_summed((key * 2 + (code & 1)) * number + classes[code >> 1], n))
            amount += len(held[-1][0])
            if amount > GATHER // 2:
                yield from _sliced(total())
                held, amount = [], 0
        if held:
            yield from _sliced(total())

    return add_up


def _transitions(shared):
    """Arrow map: neighbours of units to how often each class follows each."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, number = shared.value
        table = np.zeros(number * number)
        for batch in batches:
            row, code = _flat(batch.column("codes"))
            n = _flat(batch.column("ns"))[1]
            after = (code & 1) == 0
            own = classes[batch.column("key").to_numpy()[row[after]]]
            table += np.bincount(own * number + classes[code[after] >> 1], n[after], number * number)
        yield _cells(table)

    return add_up


def _cells(table: np.ndarray) -> pa.RecordBatch:
    cells = np.flatnonzero(table)
    return pa.RecordBatch.from_arrays([pa.array(cells), pa.array(table[cells].astype(np.int64))], names=["cell", "n"])


def _collected(cells: DataFrame, number: int) -> np.ndarray:
    table = np.zeros(number * number)
    for batch in cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow().to_batches():
        table[batch.column("cell").to_numpy()] = batch.column("n").to_numpy()
    return table.reshape(number, number)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def _likelihood(table: np.ndarray) -> float:
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=0)).sum() - _xlogx(table.sum(axis=1)).sum())


def _moves(around: np.ndarray, own: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class that gains most likelihood for each word: rows of ``around`` count the classes after it, then those before.
    The last class is the end's own."""
    number = len(table)
    after, ahead = around[:, :number], around[:, number:]
    logs = np.log(table + 0.5).astype(np.float32)
    rows, cols = table.sum(axis=1), table.sum(axis=0)
    size, mass = after.sum(axis=1), ahead.sum(axis=1)
    first = after.astype(np.float32) @ logs.T + ahead.astype(np.float32) @ logs
    first -= size[:, None] * np.log(rows + 0.5) + mass[:, None] * np.log(cols + 0.5)
    first = first[:, : number - 1]
    most = min(CANDIDATES, number - 1)
    found = np.c_[own, np.argpartition(-first, most - 1, axis=1)[:, :most]]
    gains = np.empty(found.shape)
    for k in range(found.shape[1]):
        cls = found[:, k]
        stays = cls == own
        gain = np.zeros(len(own))
        for counts, way in ((after, table), (ahead, table.T)):
            row, other = np.nonzero(counts)
            n = counts[row, other]
            base = np.maximum(way[cls[row], other] - np.where(stays[row], n, 0), 0)
            gain += np.bincount(row, _xlogx(base + n) - _xlogx(base), len(own))
        for total, n in ((rows, size), (cols, mass)):
            base = np.maximum(total[cls] - np.where(stays, n, 0), 0)
            gain -= _xlogx(base + n) - _xlogx(base)
        gains[:, k] = gain
    return found[np.arange(len(own)), gains.argmax(axis=1)]


def _exchange(shared):
    """Arrow map: rows in the order of their units to the classes the units move to."""

    def exchange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, number, table = shared.value
        units, around = np.zeros(0, np.int64), np.zeros((0, 2 * number))

        def moved(units: np.ndarray, around: np.ndarray) -> pa.RecordBatch:
            best = _moves(around, classes[units], table)
            return pa.RecordBatch.from_arrays([pa.array(units), pa.array(best.astype(np.int64))], names=["unit", "class"])

        for batch in (part for b in batches for part in _sliced(b, BLOCK)):
            keys = batch.column("unit").to_numpy()
            found = np.unique(np.r_[units, keys])
            wider = np.zeros((len(found), 2 * number))
            wider[np.searchsorted(found, units)] = around
            row, code = _flat(batch.column("codes"))
            np.add.at(wider, (np.searchsorted(found, keys[row]), code), _flat(batch.column("ns"))[1])
            # The last unit may go on.
            yield moved(found[:-1], wider[:-1])
            units, around = found[-1:], wider[-1:]
        if len(units):
            yield moved(units, around)

    return exchange


def cluster(contexts: DataFrame, units: Units, classes: np.ndarray, number: int, sweeps: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit, and the number of times each class follows each. Units move at the same time, on the counts
    before the sweep; so after the first sweep half of them rest, and the sweep with the best likelihood is kept."""
    spark = contexts.sparkSession
    pairs = contexts.where(~F.col("rare")).select("key", "codes", "ns")
    follow = np.arange(units.end)[units.low]
    best = None
    for sweep in range(sweeps + 1):
        shared = spark.sparkContext.broadcast((classes, number))
        table = _collected(pairs.mapInArrow(_transitions(shared), "cell bigint, n bigint"), number)
        now = _likelihood(table)
        if best is None or now > best[0]:
            best = now, classes, table
        if sweep < sweeps:
            sums = pairs.mapInArrow(_class_sums(shared), "unit bigint, codes array<int>, ns array<bigint>")
            moving = F.col("unit") != units.end
            sums = sums.where(moving & ((F.col("unit") + sweep) % 2 == 0) if sweep else moving)
            to = spark.sparkContext.broadcast((classes, number, table))
            moved = sums.repartition("unit").sortWithinPartitions("unit").mapInArrow(_exchange(to), "unit bigint, class bigint")
            classes = classes.copy()
            for batch in moved.toArrow().to_batches():
                classes[batch.column("unit").to_numpy()] = batch.column("class").to_numpy()
            classes[follow] = classes[units.tail(units.ids[follow])]
    return best[1], best[2]


def _linked(rare: DataFrame, words: DataFrame | None) -> DataFrame:
    """Words not known in memory with their class and the classes of such neighbours, null and none where it is the tail's."""
    if words is None:
        return rare.withColumns({"class": F.lit(None).cast("bigint"), "moved": F.lit(None).cast(_MOVED)})
    links = rare.select("key", F.inline(F.arrays_zip("links", "link_ns")))
    moved = (
        links.join(words.select(F.col("id").alias("links"), "class"), "links")
        .groupBy("key")
        .agg(F.collect_list(F.struct(F.col("links").bitwiseAND(255).alias("tail"), "class", F.col("link_ns").cast("bigint").alias("n"))).alias("moved"))
    )
    return rare.join(words.select(F.col("id").alias("key"), "class"), "key", "left").join(moved, "key", "left")


_MOVED = "array<struct<tail:bigint,class:bigint,n:bigint>>"


def _around(batch: pa.RecordBatch, units: Units, classes: np.ndarray, number: int):
    """Class of each row's word, of its tail, and (row, side * classes + class, count) of neighbours known in memory, of
    other neighbours by their tails, and of other neighbours by their classes."""
    tails = classes[units.end + 1 :]
    key = batch.column("key").to_numpy()
    old = tails[key & 255]
    given = batch.column("class")
    own = np.where(given.is_null().to_numpy(zero_copy_only=False), old, given.fill_null(0).to_numpy())
    row, code = _flat(batch.column("codes"))
    near = row, (code & 1) * number + classes[code >> 1], _flat(batch.column("ns"))[1].astype(np.int64)
    row, link = _flat(batch.column("links"))
    n = _flat(batch.column("link_ns"))[1].astype(np.int64)
    far = row, (n < 0) * number + tails[link & 255], np.abs(n)
    lists = batch.column("moved")
    row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy())
    tail, cls, n = (lists.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(3))
    side = (n < 0) * number
    new = tuple(np.concatenate(x) for x in zip(far, (row, side + tails[tail], -np.abs(n)), (row, side + cls, np.abs(n))))
    return own, old, near, far, new


def _rare_transitions(shared):
    """Arrow map: what changes in the table of transitions as words leave the classes of their tails."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, classes, number = shared.value
        table = np.zeros(number * number)
        for batch in batches:
            own, old, near, far, new = _around(batch, units, classes, number)
            for (row, code, n), word, sign in ((near, own, 1), (near, old, -1), (new, own, 1), (far, old, -1)):
                cls, ahead = code % number, code >= number
                if row is not near[0]:
                    # Pairs of two such words stand in both rows.
                    row, cls, n, ahead = row[~ahead], cls[~ahead], n[~ahead], ahead[~ahead]
                cell = np.where(ahead, cls * number + word[row], word[row] * number + cls)
                table += sign * np.bincount(cell, n, number * number)
        yield _cells(table)

    return add_up


def _rare_exchange(shared):
    """Arrow map: words not known in memory, of at least MIN_COUNT, to the classes they move to."""

    def exchange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, classes, number, table, least, sweep = shared.value
        for batch in (part for b in batches for part in _sliced(b, BLOCK)):
            own, _, near, _, new = _around(batch, units, classes, number)
            around = np.zeros((batch.num_rows, 2 * number))
            for row, code, n in (near, new):
                np.add.at(around, (row, code), n)
            key = batch.column("key").to_numpy()
            # Every word is followed by another one or an end, so this is how often it occurs.
            picked = around[:, :number].sum(axis=1) >= least
            moving = picked if not sweep else picked & (((key >> 8) + sweep) % 2 == 0)
            if moving.any():
                own[moving] = _moves(around[moving], own[moving], table)
            yield pa.RecordBatch.from_arrays([pa.array(key[picked]), pa.array(own[picked].astype(np.int64))], names=["id", "class"])

    return exchange


def cluster_rare(
    contexts: DataFrame, units: Units, classes: np.ndarray, table: np.ndarray, sweeps: int = RARE_SWEEPS
) -> tuple[DataFrame | None, np.ndarray]:
    """Classes of the words not known in memory, as a table (id, class), and the transitions with them."""
    spark, number = contexts.sparkSession, len(table)
    rare = contexts.where("rare").select("key", "codes", "ns", "links", "link_ns")
    if rare.isEmpty():
        return None, table
    words, now, best = None, table, None
    for sweep in range(sweeps + 1):
        linked = _linked(rare, words)
        if words is not None:
            shared = spark.sparkContext.broadcast((units, classes, number))
            now = table + _collected(linked.mapInArrow(_rare_transitions(shared), "cell bigint, n bigint"), number)
        likelihood = _likelihood(now)
        if best is None or likelihood > best[0]:
            best = likelihood, words, now
        if sweep < sweeps:
            shared = spark.sparkContext.broadcast((units, classes, number, now, MIN_COUNT, sweep))
            words = written(linked.mapInArrow(_rare_exchange(shared), "id bigint, class bigint"), scratch_path(spark, "classes"))
    return best[1], best[2]


@dataclass
class Model:
    """What scoring needs in memory, and the table of all words: their counts and, of those not known, their classes."""

    counts: DataFrame
    tokens: int
    distinct: int
    units: Units
    classes: np.ndarray
    transitions: np.ndarray
    #: log10 of the total of each class, which divides its words' counts plus one.
    emission: np.ndarray
    known: np.ndarray
    known_counts: np.ndarray


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of each query when it ends, instead of when the driver happens to collect garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def classes_for(words: int) -> int:
    return max(CLASSES, int(np.ceil(words**GROWTH)))


def train(docs: DataFrame, number: int | None = None, sweeps: int = SWEEPS) -> Model:
    """Fit on all rows of ``docs`` (text); ``number`` classes, or as many as the vocabulary asks for."""
    small_batches(docs.sparkSession)
    with shuffles_dropped(docs.sparkSession):
        return _train(docs, number, sweeps)


def _train(docs: DataFrame, number: int | None, sweeps: int) -> Model:
    spark = docs.sparkSession
    counts = written(
        docs.select("text").mapInArrow(_count_words, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")),
        scratch_path(spark, "words"),
    )
    tokens, distinct, clustered = (
        x or 0 for x in counts.agg(F.sum("n"), F.count(F.lit(1)), F.count_if(F.col("n") >= MIN_COUNT)).first()
    )
    number = number or classes_for(clustered)
    # At most KNOWN_SHARE rows and the end, since each holds that share of the tokens.
    frequent = counts.where((F.col("n") * KNOWN_SHARE >= tokens) | (F.col("id") == int(END))).toArrow() if tokens else None
    ids = frequent.column("id").to_numpy() if tokens else np.zeros(0, np.int64)
    n = frequent.column("n").to_numpy() if tokens else np.zeros(0, np.int64)
    order = np.argsort(ids)
    ids, n = ids[order], n[order]
    word = ids != END
    units = Units(ids[word], n[word] < MIN_COUNT)
    classes = np.r_[(units.ids >> 8) & 0xFFFFFF, 0, np.arange(256)] % (number - 1)
    classes[:units.end][units.low] = classes[units.tail(units.ids[units.low])]
    often = np.flatnonzero((n[word] * UNIT_SHARE >= tokens) & ~units.low)
    classes[often[np.argsort(-n[word][often], kind="stable")]] = np.arange(len(often)) % (number - 1)
    classes[units.end] = number - 1
    contexts = written(
        docs.select("text")
        .mapInArrow(_count_contexts(spark.sparkContext.broadcast(units)), _CONTEXTS)
        .repartition("rare", "key", "piece")
        .sortWithinPartitions("rare", "key", "piece")
        .mapInArrow(_fold, _CONTEXTS),
        scratch_path(spark, "contexts"),
    )
    classes, table = cluster(contexts, units, classes, number, sweeps)
    words, table = cluster_rare(contexts, units, classes, table)

    totals = table.sum(axis=0)
    plain = (totals + 1) / (totals.sum() + number)
    kinds = np.maximum((table > 0).sum(axis=1), 1)
    transitions = (table + kinds[:, None] * plain) / (table.sum(axis=1) + kinds)[:, None]
    distinct_of = np.zeros(number)
    np.add.at(distinct_of, classes[: units.end + 1], 1)
    none = F.lit(None).cast("bigint").alias("class")
    counts = counts.select("id", "n", none) if words is None else written(
        counts.join(words, "id", "left").select("id", "n", "class"), scratch_path(spark, "classed")
    )
    rare = counts.where((F.col("n") * KNOWN_SHARE < tokens) & (F.col("id") != int(END)))
    tail = F.when(F.col("class").isNull(), F.col("id").bitwiseAND(255)).alias("tail")
    for row in rare.groupBy("class", tail).agg(F.count(F.lit(1)).alias("n")).collect():
        cls = classes[units.end + 1 + row["tail"]] if row["class"] is None else row["class"]
        distinct_of[cls] += row["n"]
    return Model(counts, tokens, distinct, units, classes, np.log10(transitions), np.log10(totals + distinct_of + 1), ids, n)


def _score(shared):
    """Arrow map: rows (row, doc_id, text) to what the words known in memory and their classes add to the sums."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_logs, units, classes, transitions, emission = shared.value
        for part, ids, bounds in _texts(batches):
            ids = _with_ends(ids, bounds)
            bounds = bounds + np.arange(len(bounds))
            own = classes[units.of(ids)]
            before = np.r_[classes[units.end], own[:-1]]
            places, found = _look_up(known, ids)
            sure = found | (ids == END)
            counted = np.where(found, known_logs[places], 0.0) if len(known) else np.zeros(len(ids))
            classed = np.where(sure & np.r_[True, sure[:-1]], transitions[before, own], 0.0) - np.where(sure, emission[own], 0.0)
            sums = [np.add.reduceat(x, bounds[:-1]) for x in (counted, classed, found.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("doc_id"), pa.array(np.diff(bounds)), *map(pa.array, sums)],
                names=["row", "doc_id", "n_tokens", "counted", "classed", "found"],
            )

    return score


def _look_up(known: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
    places = np.minimum(np.searchsorted(known, ids), len(known) - 1)
    return places, known[places] == ids


def _rare(shared):
    """Arrow map: rows to their words that are not known in memory: where each stands, and the classes of its neighbours,
    -1 of those that are not known either."""

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, _, units, classes, *_ = shared.value
        for part, ids, bounds in _texts(batches):
            ids = _with_ends(ids, bounds)
            bounds = bounds + np.arange(len(bounds))
            sure = _look_up(known, ids)[1] | (ids == END)
            own = np.where(sure, classes[units.of(ids)], -1)
            at = np.flatnonzero(~sure)
            rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[at]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part.column("row").to_numpy(zero_copy_only=False)[rows]),
                    pa.array(ids[at]),
                    pa.array((at - bounds[rows]).astype(np.int32)),
                    pa.array(np.r_[classes[units.end], own[:-1]][at].astype(np.int32)),
                    pa.array(own[at + 1].astype(np.int32)),
                ],
                names=["row", "id", "at", "before", "after"],
            )

    return rare


def _rare_sums(shared):
    """Arrow map: a text's words that are not known in memory, with their classes, to what they add to the sums."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, units, classes, transitions, emission = shared.value
        for batch in batches:
            row, _ = _flat(batch.column("at"))
            at, tail, cls, n, before, after = (
                _flat(batch.column(c))[1] for c in ("at", "tail", "class", "n", "before", "after")
            )
            # Equal rows bring their words in more than once.
            order = np.lexsort((at, row))
            row, at = row[order], at[order]
            first = np.r_[True, (row[1:] != row[:-1]) | (at[1:] != at[:-1])] if len(row) else np.zeros(0, bool)
            order, row = order[first], row[first]
            tail, cls, n, before, after = (x[order] for x in (tail, cls, n, before, after))
            own = np.where(cls < 0, classes[units.end + 1 + tail], cls)
            # A neighbour that is not known is the word of the line before.
            before = np.where(before < 0, np.r_[0, own[:-1]], before) if len(own) else before
            classed = transitions[before, own] - emission[own] + np.where(after < 0, 0.0, transitions[own, after])
            sums = [np.bincount(row, x, batch.num_rows) for x in (n > 0, np.log10(n + 1.0), classed)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])],
                names=["row", "rare_found", "rare_counted", "rare_classed"],
            )

    return add_up


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_tokens, n_known (tokens seen in training), train_tokens, base_score (unigrams
    with one added to every count) and score (this model), both log10. A null text is empty: its only token is the end.
    Equal rows get equal results."""
    spark = docs.sparkSession
    small_batches(spark)
    keyed = docs.select(row_key("doc_id", "text").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    memory = (model.known, np.log10(model.known_counts + 1.0), model.units, model.classes, model.transitions, model.emission)
    shared = spark.sparkContext.broadcast(memory)
    sums = keyed.mapInArrow(
        _score(shared), "row bigint, doc_id bigint, n_tokens bigint, counted double, classed double, found bigint"
    )
    lists = {"at": F.col("at"), "tail": F.col("id").bitwiseAND(255), "class": F.coalesce("class", F.lit(-1)).cast("int"),
             "n": F.coalesce("n", F.lit(0)), "before": F.col("before"), "after": F.col("after")}
    rare = (
        keyed.mapInArrow(_rare(shared), "row bigint, id bigint, at int, before int, after int")
        .join(model.counts, "id", "left")
        .groupBy("row")
        .agg(F.collect_list(F.struct(*[x.alias(c) for c, x in lists.items()])).alias("words"))
        .select("row", *[F.col(f"words.{c}").alias(c) for c in lists])
        .mapInArrow(_rare_sums(shared), "row bigint, rare_found bigint, rare_counted double, rare_classed double")
    )
    counted = F.col("counted") + F.coalesce("rare_counted", F.lit(0.0))
    return sums.join(rare, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("found") + F.coalesce("rare_found", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (counted - F.col("n_tokens") * F.lit(float(np.log10(model.tokens + model.distinct + 1)))).alias("base_score"),
        (counted + F.col("classed") + F.coalesce("rare_classed", F.lit(0.0))).alias("score"),
    )


def training_rows(docs: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    return docs.where(~held_out(F.col("doc_id"), folds, fold))
