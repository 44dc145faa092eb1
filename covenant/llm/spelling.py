"""Grouping of spelling variants: words one edit apart, found by dynamic programming along sorted lists.

Two words one edit apart share the first or the second half of their common length, so words meet in groups that have a
half in common; what remains of them, the zone, is searched. A group is a sorted list, and the words it is searched for
walk along it together: rows of the edit matrix, three cells wide, are computed once for a prefix that neighbours in the
list share, and a range of the list is skipped as soon as its shared prefix is more than one edit away. Groups that grew
too large are split by the halves of their zone, again and again, so that every pair meets in exactly one group.

Only the counts of partners and the best partner of a word leave a group, never its pairs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covenant.llm.common import LONG_WORD, release_memory, small_batches, text_slices
from covenant.session import scratch_path, written

MIN_LENGTH = 5
MIN_COUNT = 3
MIN_RATIO = 2

#: Groups of more words are split by the halves of what they do not share.
GROUP_WORDS = 20_000

#: Distinct words a task holds before it sends their counts on.
HELD_WORDS = 400_000

#: Words that walk along the lists at the same time, and list entries that are searched together.
QUERIES = 4_096
CHUNK_ROWS = 30_000

#: No bound on the shared part of a zone.
NO_SKIP = 1 << 30

_LEAD = 0xC3
_FAR = 2

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[_LEAD] = True

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end byte and row of the runs of letters; those from U+00C0 to U+00FF are two bytes, the first C3."""
    inside = _LETTER[data]
    inside[1:] |= data[:-1] == _LEAD
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[edges < len(data)]
    begins[edges] = inside[edges]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[edges > 0] - 1
    finishes[edges] = inside[edges]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """CRC-32 of byte spans, each following on a prefix whose CRC-32 is given; all spans go on by a byte a step."""
    out = seeds.copy()
    lengths = ends - starts
    for i in np.flatnonzero(lengths > LONG_WORD):
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(seeds[i]))
    active = np.flatnonzero(lengths <= LONG_WORD)
    at, end, state = starts[active], ends[active], ~out[active]
    while len(active):
        state = _CRC[(state ^ data[at]) & 255] ^ (state >> np.uint32(8))
        at = at + 1
        more = at < end
        out[active[~more]] = ~state[~more]
        active, at, end, state = active[more], at[more], end[more], state[more]
    return out


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    lengths = ends - starts
    offsets = np.r_[0, np.cumsum(lengths)]
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])]
    )


def _count(drop_every: int, min_length: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        amount = 0

        def total() -> Iterator[pa.RecordBatch]:
            summed = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
            summed = pa.table({"word": summed.column("word"), "n": summed.column("n_sum")})
            yield from summed.to_batches(max_chunksize=20_000)

        for batch in batches:
            prefixes = [f"{'' if i is None else i}:".encode() for i in batch.column("doc_id").to_pylist()]
            for first, _, data, offsets in text_slices(batch.column("text")):
                starts, ends, rows = _runs(data, offsets)
                leads = np.r_[0, np.cumsum(data == _LEAD)]
                points = ends - starts - (leads[ends] - leads[starts])
                enough = points >= min_length
                starts, ends, rows, points = starts[enough], ends[enough], rows[enough], points[enough]
                if not len(starts):
                    continue
                data = _FOLD[data]
                keep, extra = np.ones(len(starts), bool), []
                if drop_every:
                    seeds = np.array([zlib.crc32(p) for p in prefixes[first : first + len(offsets) - 1]], np.uint32)
                    sums = _checksums(data, starts, ends, seeds[rows])
                    keep = sums % drop_every != 0
                    for i in np.flatnonzero(~keep):
                        word = data[starts[i] : ends[i]].tobytes().decode()
                        gone = int(sums[i]) % len(word)
                        if len(word) > min_length:
                            extra.append(word[:gone] + word[gone + 1 :])
                words = _strings(data, starts[keep], ends[keep])
                counts = pc.value_counts(pa.concat_arrays([words, pa.array(extra, pa.large_string())]))
                held.append(pa.table({"word": counts.field("values"), "n": counts.field("counts")}))
                amount += len(counts)
                if amount > HELD_WORDS:
                    merged = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
                    held = [pa.table({"word": merged.column("word"), "n": merged.column("n_sum")})]
                    amount = len(held[0])
                    if amount > HELD_WORDS // 2:
                        yield from total()
                        held, amount = [], 0
        if held:
            yield from total()
        held.clear()
        release_memory()

    return count


def vocabulary(docs: DataFrame, *, drop_every: int = 0, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """Words of ``docs`` (doc_id, text) and how often they occur: (word, n).

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case, of at least ``min_length`` code points,
    that occur at least ``min_count`` times. With ``drop_every``, a run whose CRC-32 (of id, colon and run) it divides loses
    the code point that the checksum names, which plants misspellings. Null texts have no words and a null id is the empty
    text there; rows count as often as they are repeated; of an empty table there is nothing. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    counted = docs.select("doc_id", "text").mapInArrow(_count(drop_every, min_length), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


_ITEM = "least int, pre string, suf string, zone string, skip int, n bigint"


def _halves(words: DataFrame) -> DataFrame:
    """Every word in the groups of its halves, as the shorter and as the longer one of a pair.

    ``least`` is the length of a pair's shorter word; its words share ``pre`` and ``suf`` and differ in their ``zone``.
    Pairs whose zones share their first ``skip`` code points meet in another group.
    """
    size = F.char_length("word")
    least = F.explode(F.array(size, size - 1)).alias("least")
    half, rest = "int((least + 1) div 2)", "int(least div 2)"
    sides = F.expr(
        f"""inline(array(
        struct(left(word, {half}) AS pre, '' AS suf, substr(word, {half} + 1) AS zone, {NO_SKIP} AS skip),
        struct('' AS pre, right(word, {rest}) AS suf, left(word, char_length(word) - {rest}) AS zone, {half} AS skip)))"""
    )
    return words.select("word", "n", least).where("least > 0").select("least", sides, "n").select("least", "pre", "suf", "zone", "skip", "n")


def _split(items: DataFrame) -> DataFrame:
    """The items of groups that are too large, in the groups of the halves of their zones."""
    wide = items.withColumn("r", F.expr("least - char_length(pre) - char_length(suf)"))
    half, rest = "int((r + 1) div 2)", "int(r div 2)"
    sides = F.expr(
        f"""inline(array(
        struct(concat(pre, left(zone, {half})) AS pre, suf, substr(zone, {half} + 1) AS zone,
            if(skip = {NO_SKIP}, skip, skip - {half}) AS skip),
        struct(pre, concat(right(zone, {rest}), suf) AS suf, left(zone, char_length(zone) - {rest}) AS zone, {half} AS skip)))"""
    )
    return wide.select("least", "n", sides).where("skip > 0").select("least", "pre", "suf", "zone", "skip", "n")


def _grouped(words: DataFrame, group_words: int) -> DataFrame:
    """Items of all groups, none of which is larger than ``group_words`` unless its words differ in one place only."""
    spark = words.sparkSession
    group = F.xxhash64("least", "pre", "suf")
    level = _halves(words).withColumn("group", group)
    done = None
    while True:
        splittable = F.expr("least - char_length(pre) - char_length(suf) > 1")
        large = level.where(splittable).groupBy("group").count().where(F.col("count") > group_words).select("group")
        large = written(large, scratch_path(spark, "large"))
        if large.isEmpty():
            return level if done is None else done.unionByName(level)
        # Rows are split by their own place: one that shares a hash with a large group by chance is split as well, whole
        # groups at a time, and pairs still meet once.
        hot = level.join(large, "group", "left_semi").where(splittable)
        cold = level.join(large, "group", "left_anti").unionByName(level.join(large, "group", "left_semi").where(~splittable))
        done = cold if done is None else done.unionByName(cold)
        level = written(_split(hot.drop("group")).withColumn("group", group), scratch_path(spark, "split"))


class _Lists:
    """Sorted lists of zones, one per group: ``chars`` of entry i are ``chars[offsets[i]:offsets[i + 1]]``."""

    def __init__(self, zones: pa.Array, heads: np.ndarray):
        zones = zones.cast(pa.large_string())
        raw = np.frombuffer(zones.buffers()[1], np.int64)[zones.offset : zones.offset + len(zones) + 1]
        data = zones.buffers()[2]
        data = np.frombuffer(data, np.uint8)[raw[0] : raw[-1]] if data is not None else np.zeros(0, np.uint8)
        raw = raw - raw[0]
        lead = data == _LEAD
        # One byte per code point: the byte after C3 stands for the code point that is 64 above it.
        wide = data + np.where(np.r_[False, lead[:-1]], np.uint8(64), np.uint8(0)) if len(data) else data
        self.offsets = raw - np.r_[0, np.cumsum(lead)][raw]
        self.chars = np.r_[wide[~lead], np.zeros(1, np.uint8)]
        self.lengths = np.diff(self.offsets)
        self.heads = heads
        self.shared = self._shared()
        self._nodes = [np.flatnonzero(heads)]
        self._children: list[tuple[np.ndarray, np.ndarray]] = []

    def at(self, entries: np.ndarray, place: int) -> np.ndarray:
        """Code points at a place of entries; 0 beyond their ends."""
        if place < 0:
            return np.zeros(len(entries), np.uint8)
        inside = place < self.lengths[entries]
        return self.chars[np.where(inside, self.offsets[entries] + place, len(self.chars) - 1)]

    def _shared(self) -> np.ndarray:
        """Length of the prefix that an entry shares with the one before it; -1 at the head of a list."""
        shared = np.where(self.heads, -1, 0)
        active, depth = np.flatnonzero(~self.heads), 0
        while len(active):
            one, other = self.at(active, depth), self.at(active - 1, depth)
            active = active[(one == other) & (one > 0)]
            depth += 1
            shared[active] = depth
        return shared

    def nodes(self, depth: int) -> np.ndarray:
        """First entries of the ranges that share their first ``depth`` code points."""
        while len(self._nodes) <= depth:
            d = len(self._nodes)
            self._nodes.append(np.flatnonzero((self.shared < d) & (self.lengths >= d)))
        return self._nodes[depth]

    def children(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For every range at ``depth``: the first range within it one code point on, and how many there are."""
        while len(self._children) <= depth:
            d = len(self._children)
            edges = np.searchsorted(self.nodes(d + 1), np.r_[self.nodes(d), len(self.heads)])
            self._children.append((edges[:-1], np.diff(edges)))
        return self._children[depth]

    def ranges(self, depths: np.ndarray) -> np.ndarray:
        """Number of the range of an entry whose entries share as many first code points as ``depths`` says."""
        return np.cumsum((self.shared < depths) | self.heads)


def _near(lists: _Lists, queries: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and an entry of its list that are exactly one edit apart.

    ``low, mid, high`` are the cells of a row of the edit matrix beside and on its diagonal, for a query and the shared
    prefix of a range. Cells above one are as good as infinite.
    """
    query = queries
    node = group[queries]
    low = np.full(len(query), _FAR, np.int8)
    mid, high = np.zeros(len(query), np.int8), np.ones(len(query), np.int8)
    found = []
    depth = 0
    while len(query):
        first, number = lists.children(depth)
        times = number[node]
        total = int(times.sum())
        if not total:
            break
        again = np.repeat(np.arange(len(query)), times)
        step = np.arange(total) - np.repeat(np.cumsum(times) - times, times)
        node = first[node][again] + step
        entry = lists.nodes(depth + 1)[node]
        char = lists.at(entry, depth)
        before, here, after = (lists.at(query, depth + k)[again] != char for k in (-1, 0, 1))
        query, low, mid, high = query[again], low[again], mid[again], high[again]
        new_low = np.minimum(low + before, mid + 1)
        new_mid = np.minimum(np.minimum(mid + here, high + 1), new_low + 1)
        new_high = np.minimum(high + after, new_mid + 1)
        alive = (new_low <= 1) | (new_mid <= 1) | (new_high <= 1)
        query, node, entry = query[alive], node[alive], entry[alive]
        low, mid, high = (np.minimum(x[alive], _FAR).astype(np.int8) for x in (new_low, new_mid, new_high))
        depth += 1
        ended = np.flatnonzero(lists.lengths[entry] == depth)
        over = lists.lengths[query[ended]] - depth
        distance = np.select([over == -1, over == 0, over == 1], [low[ended], mid[ended], high[ended]], _FAR)
        hit = ended[distance == 1]
        if len(hit):
            found.append((query[hit], entry[hit]))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none
    return np.concatenate([q for q, _ in found]), np.concatenate([e for _, e in found])


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows in chunks of whole groups, with the first rows of the groups marked."""
    held: list[pa.RecordBatch] = []

    def heads(rows: pa.Table) -> np.ndarray:
        marks = np.ones(rows.num_rows, bool)
        same = None
        for name in ("least", "pre", "suf"):
            column = rows.column(name).combine_chunks()
            equal = pc.equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            same = equal if same is None else same & equal
        marks[1:] = ~same
        return marks

    def chunk(last: bool) -> Iterator[tuple[pa.Table, np.ndarray]]:
        rows = pa.Table.from_batches(held).combine_chunks()
        marks = heads(rows)
        end = rows.num_rows if last else int(np.flatnonzero(marks)[-1])
        if end:
            yield rows.slice(0, end), marks[:end]
        held[:] = rows.slice(end).to_batches()

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= CHUNK_ROWS:
            yield from chunk(False)
    if held:
        yield from chunk(True)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, heads in _whole_groups(batches):
        words = pc.binary_join_element_wise(rows.column("pre"), rows.column("zone"), rows.column("suf"), "").combine_chunks()
        number = rows.column("n").to_numpy()
        least = rows.column("least").to_numpy()
        lists = _Lists(rows.column("zone").combine_chunks(), heads)
        group = np.cumsum(heads) - 1
        size = pc.add(pc.utf8_length(rows.column("pre")), pc.utf8_length(rows.column("suf"))).to_numpy() + lists.lengths
        order = pc.array_sort_indices(words).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ranges = lists.ranges(rows.column("skip").to_numpy())
        shorter = np.flatnonzero(size == least)
        for at in range(0, len(shorter), QUERIES):
            query, entry = _near(lists, shorter[at : at + QUERIES], group)
            here = ranges[query] != ranges[entry]
            query, entry = query[here], entry[here]
            longer = size[entry] > least[entry]
            target, other = np.r_[query, entry[longer]], np.r_[entry, query[longer]]
            if not len(target):
                continue
            by = np.lexsort((rank[other], -number[other], target))
            target, other = target[by], other[by]
            first = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
            times = np.diff(np.r_[first, len(target)])
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(target[first])), pa.array(times), pa.array(number[other[first]]), words.take(pa.array(other[first]))],
                names=["word", "near", "most", "other"],
            )
    release_memory()


def near_words(words: DataFrame, *, min_ratio: int = MIN_RATIO, group_words: int = GROUP_WORDS) -> DataFrame:
    """``words`` (word, n) with ``n_near``, the number of words exactly one inserted, deleted or replaced code point away,
    and ``form, form_n``: the one of these that is most frequent (ties: smallest in code-point order), if it is at least
    ``min_ratio`` times as frequent as the word, else null.

    Words are distinct, not null, and of code points below U+0100. ``words`` is read several times: give a table.
    """
    items = _grouped(words, group_words)
    dealt = items.select("group", "least", "pre", "suf", "zone", "skip", "n").repartition("group").sortWithinPartitions(
        "least", "pre", "suf", "zone"
    )
    found = dealt.drop("group").mapInArrow(_search, "word string, near bigint, most bigint, other string")
    parts = found.select("word", F.lit(None).cast("bigint").alias("n"), "near", F.struct((-F.col("most")).alias("less"), "other").alias("best"))
    own = words.select("word", "n", F.lit(0).cast("bigint").alias("near"), F.lit(None).cast(parts.schema["best"].dataType).alias("best"))
    folded = own.union(parts).groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))
    enough = -F.col("best.less") >= min_ratio * F.col("n")
    return folded.select(
        "word",
        "n",
        "n_near",
        F.when(enough, F.col("best.other")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form: the end of its chain of forms.

    Counts grow along a chain, so that there are no circles. All words go twice as far in every round; rounds are as many as
    the logarithm of the longest chain. ``forms`` (word, form) is read in each of them.
    """
    spark = forms.sparkSession
    now = written(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), scratch_path(spark, "roots"))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = written(
            now.join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            scratch_path(spark, "roots"),
        )
        moved = not now.where("moved").isEmpty()
        now = now.drop("moved")
        if not moved:
            return now


def variants(
    docs: DataFrame,
    *,
    drop_every: int = 0,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    min_ratio: int = MIN_RATIO,
    group_words: int = GROUP_WORDS,
) -> DataFrame:
    """Words of ``docs`` (doc_id, text) grouped as variants: word, n, n_near, form, form_n, root.

    ``vocabulary`` says what is a word, ``near_words`` what its form is; ``root`` is the last word on the way from form to
    form, the word itself if it has none. An empty table gives no rows, and so do null and empty texts.
    """
    spark = docs.sparkSession
    words = vocabulary(docs, drop_every=drop_every, min_length=min_length, min_count=min_count)
    words = written(words, scratch_path(spark, "words"))
    near = written(near_words(words, min_ratio=min_ratio, group_words=group_words), scratch_path(spark, "near"))
    return near.join(roots(near), "word", "left").withColumn("root", F.coalesce("root", "word"))
